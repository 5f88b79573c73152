"""Vocabulary, padded encodings and pre-training examples."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomwork.functions import text as tx
from loomwork.functions.arrays import let
from loomwork.functions.hashing import below, coin, digest, share_of
from loomwork.operators import counts, scan
from loomwork.session import materialize

PAD, UNK, SEP, MASK = 0, 1, 2, 3
RESERVED = 4
HEAD = 1 << 20       # most frequent words that every task holds, some 15 MB; rarer ones are joined
IGNORED = -100       # fixed value: label a loss leaves out
SEPARATOR = "[sep]"
TEXTS_PER_BLOCK = 1_000  # texts whose sentences are ranked in one task


def build_vocab(df: DataFrame, column: str, size: int | None = None) -> DataFrame:
    """(word, token_id): all words by falling frequency, ids after the reserved ones.

    With ``size`` only so many entries are kept, the reserved ones included.
    """
    counted = materialize(counts.word_count_lower(df, column), "words")
    indexed, _ = scan.dense_index(counted.select("word", (-F.col("count")).alias("_rare")), ["_rare", "word"])
    vocab = indexed.select("word", (F.col("idx") + RESERVED).cast("int").alias("token_id"))
    return vocab if size is None else vocab.where(F.col("token_id") < size)


def _lists(flat: pa.Array, counts_: np.ndarray) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(counts_)]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(ends), flat)


def _shared_words(spark: SparkSession, words: DataFrame):
    """The words of a bounded frame as a broadcast that every task reads in place: a column in Arrow's format."""
    table = words.toArrow().combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return spark.sparkContext.broadcast(sink.getvalue().to_pybytes())


def _places(shared, flat: pa.Array) -> pa.Array:
    """The place of each word: 0 for the separator, i for the i-th shared word, null for any other."""
    words = pa.ipc.open_stream(shared.value).read_all().column(0).combine_chunks().cast(pa.string())
    known = pa.concat_arrays([pa.array([SEPARATOR], pa.string()), words])
    return pc.index_in(flat, value_set=known)


def _ids(place: pa.Array, unknown: int) -> np.ndarray:
    """Place 0 is the separator, place i the i-th word after the reserved ids."""
    numbers = pc.fill_null(place, -1).to_numpy(zero_copy_only=False).astype("int32")
    return np.where(numbers > 0, numbers + np.int32(RESERVED - 1), np.where(numbers == 0, SEP, unknown)).astype("int32")


def _look_up_all(shared):
    """ARRAY<STRING> to ids, UNK for a word that is not shared."""
    @F.arrow_udf("array<int>")
    def look_up(batch: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
        return _lists(pa.array(_ids(_places(shared, batch.flatten()), UNK), pa.int32()), sizes)
    return look_up


def _look_up(shared):
    """ARRAY<STRING> to (ids, rare): -1 stands for a word that is not shared, which goes to ``rare`` in order."""
    @F.arrow_udf("struct<ids:array<int>,rare:array<string>>")
    def look_up(batch: pa.Array) -> pa.Array:
        flat = batch.flatten()
        place = _places(shared, flat)
        missing = pc.is_null(place)
        sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
        gone = np.concatenate([[0], np.cumsum(missing.to_numpy(zero_copy_only=False))])
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
        return pa.StructArray.from_arrays(
            [_lists(pa.array(_ids(place, -1), pa.int32()), sizes),
             _lists(flat.filter(missing), gone[ends[1:]] - gone[ends[:-1]])], ["ids", "rare"])
    return look_up


def _filled(ids: Column, found: Column) -> Column:
    """The ids with each -1 replaced by the next id found for its row."""
    @F.arrow_udf("array<int>")
    def fill(ids: pa.Array, found: pa.Array) -> pa.Array:
        flat = ids.flatten().to_numpy(zero_copy_only=False).copy()
        flat[flat == -1] = found.flatten().to_numpy(zero_copy_only=False)
        sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        return _lists(pa.array(flat, pa.int32()), sizes)
    return fill(ids, found)


def encode(df: DataFrame, keys: list[str], words: Column, vocab: DataFrame, max_length: int | None = None,
           name: str = "ids", head: int | None = None) -> DataFrame:
    """Add ``name``, the ids of a word array (at most ``max_length``); a word outside the vocabulary is UNK.

    The ``head`` most frequent words go to every task, where Arrow looks up whole
    batches.  A vocabulary that has no more is looked up in one pass, without a shuffle.
    The rest of a larger one is joined by word: none of them is frequent enough to be
    a hot key.  ``keys`` identify a row.
    """
    limit = HEAD if head is None else head
    first = RESERVED + limit
    shared = _shared_words(df.sparkSession, vocab.where(F.col("token_id") < first).orderBy("token_id").select("word"))
    cut = words if max_length is None else F.slice(words, 1, max_length)
    columns = [c for c in df.columns if c != name]
    if vocab.where(F.col("token_id") >= first).isEmpty():
        return df.select(*columns, _look_up_all(shared)(cut).alias(name))
    marked = materialize(df.withColumn("_found", _look_up(shared)(cut)).select(
        *columns, F.col("_found.ids").alias("_ids"), F.col("_found.rare").alias("_rare")), "marked")
    spelled = marked.where(F.size("_rare") > 0).select(*keys, F.posexplode("_rare").alias("_pos", "word"))
    tail = vocab.where(F.col("token_id") >= first)
    item = F.struct("_pos", F.coalesce("token_id", F.lit(UNK)).alias("id"))
    found = spelled.join(tail, "word", "left").groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(item)), lambda e: e["id"]).alias("_more"))
    joined = scan.looked_up(marked, found, keys)
    more = F.coalesce("_more", F.array().cast("array<int>"))
    return joined.withColumn(name, _filled(F.col("_ids"), more)).drop("_ids", "_rare", "_more")


def pad(ids: Column, length) -> Column:
    """Ids filled up with PAD on the right."""
    return F.concat(ids, F.array_repeat(F.lit(PAD), F.greatest(F.lit(0), length - F.size(ids))))


def attention_mask(ids: Column, length) -> Column:
    """1 for a token, 0 for a pad."""
    return F.concat(F.array_repeat(F.lit(1), F.size(ids)),
                    F.array_repeat(F.lit(0), F.greatest(F.lit(0), length - F.size(ids))))


def encode_pad(df: DataFrame, keys: list[str], column: str, vocab: DataFrame, max_length: int) -> DataFrame:
    """Add input_ids and mask, both ``max_length`` long."""
    length = F.lit(max_length)
    return (encode(df, keys, tx.lower_words(F.col(column)), vocab, max_length, "_own")
            .withColumn("input_ids", pad(F.col("_own"), length))
            .withColumn("mask", attention_mask(F.col("_own"), length)).drop("_own"))


def pad_to_longest(encoded: DataFrame, batch: str, multiple: int = 8) -> DataFrame:
    """Pad ``ids`` to the longest row of its batch, rounded up to ``multiple``."""
    longest = F.max(F.size("ids")).over(Window.partitionBy(batch))  # a batch has a fixed size
    width = (F.ceil(longest / multiple) * multiple).cast("int")
    return (encoded.withColumn("width", width)
            .withColumn("input_ids", pad(F.col("ids"), F.col("width")))
            .withColumn("mask", attention_mask(F.col("ids"), F.col("width"))))


def copy_labels(df: DataFrame, ids: str = "input_ids") -> DataFrame:
    return df.withColumn("labels", F.col(ids))


def sentence_rows(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, pos, sentence) of the cleaned text."""
    return df.select(key, F.posexplode(tx.sentences(tx.clean_special_chars(F.col(column))))
                     .alias("pos", "sentence"))


def next_sentence_pairs(df: DataFrame, key: str, column: str,
                        rows_per_block: int | None = None) -> DataFrame:
    """(key, pos, idx, pair): each sentence of all texts with the next one; the last with the first."""
    paired = scan.index_with_next(sentence_rows(df, key, column), [key, "pos"], "sentence",
                                  sized_by=df, next_name="_next",
                                  rows_per_block=rows_per_block or TEXTS_PER_BLOCK)
    return paired.select(key, "pos", "idx", F.concat_ws(" [SEP] ", "sentence", "_next").alias("pair"))


def encoded_pairs(df: DataFrame, key: str, column: str, vocab: DataFrame, max_length: int,
                  rows_per_block: int | None = None) -> DataFrame:
    """(key, pos, idx, ids): the ids of each sentence, the separator, and those of the next sentence.

    Every sentence is encoded once; ids are shuffled, not texts.
    """
    rows = sentence_rows(df, key, column)
    own = encode(rows, [key, "pos"], tx.lower_words(F.col("sentence")), vocab, max_length, "_own").drop("sentence")
    paired = scan.index_with_next(own, [key, "pos"], "_own", sized_by=df, next_name="_next",
                                  rows_per_block=rows_per_block or TEXTS_PER_BLOCK)
    both = F.concat("_own", F.array(F.lit(SEP)), "_next")
    return paired.select(key, "pos", "idx", F.slice(both, 1, max_length).alias("ids"))


def _first_separator(ids: Column) -> Column:
    """0-based place of the first separator; -1 without one."""
    return F.array_position(ids, SEP).cast("int") - 1


def nsp_examples(pairs: DataFrame, key: str, seed: int, share: float = 0.5) -> DataFrame:
    """With probability ``share`` shuffle the tokens after the first separator (label 0), else label 1."""
    def shuffled(ids, cut):
        tail = F.slice(ids, cut + 2, F.size(ids))
        mixed = F.array_sort(F.transform(tail, lambda t, i: F.struct(
            digest(F.col(key), i, seed).alias("h"), i.alias("i"), t.alias("t"))))
        return F.concat(F.slice(ids, F.lit(1), cut + 1), F.transform(mixed, lambda e: e["t"]))
    swap = coin(F.col(key), "nsp", seed) < F.lit(float(share))
    changed = let(_first_separator(F.col("ids")), lambda cut: shuffled(F.col("ids"), cut))
    has = F.array_contains("ids", SEP)
    return (pairs.withColumn("nsp_label", F.when(swap, 0).otherwise(1))
            .withColumn("input_ids", F.when(swap & has, changed).otherwise(F.col("ids"))))


def first_segment_labels(df: DataFrame, ids: str = "input_ids") -> DataFrame:
    """Labels: the ids before the first separator, IGNORED from it on."""
    return df.withColumn("labels", let(_first_separator(F.col(ids)), lambda cut: F.transform(
        F.col(ids), lambda t, i: F.when(i < cut, t).otherwise(F.lit(IGNORED)))))


def mlm_mask(df: DataFrame, key: str, ids: str, seed: int, vocab_size: int, share: float = 0.15,
             masked: float = 0.8, random: float = 0.1) -> DataFrame:
    """Pick ``share`` of the ordinary tokens as labels; of those ``masked`` become MASK,
    ``random`` a random one of the ``vocab_size`` words, and the rest stay."""
    # One digest serves four tokens: each compares its own eight digits.
    def digests(size):
        return F.transform(F.sequence(F.lit(0), F.floor(size / 4).cast("int")),
                           lambda block: digest(F.col(key), block, seed))

    def draws(hashed):
        return F.transform(F.col(ids), lambda t, i: F.struct(t.alias("t"), (
            ((t >= RESERVED) | (t == UNK))
            & below(F.get(hashed, F.floor(i / 4).cast("int")), i % 4, share)).alias("on")))

    def new_id(e, i):
        def changed(h):
            other = (F.floor(share_of(h, 1) * vocab_size) + RESERVED).cast("int")
            return (F.when(share_of(h) < F.lit(masked), F.lit(MASK))
                    .when(share_of(h) < F.lit(masked + random), other).otherwise(e["t"]))
        return F.when(e["on"], let(digest(F.col(key), i, "kind", seed), changed)).otherwise(e["t"])
    return (df.withColumn("_marked", let(digests(F.size(ids)), draws))
            .withColumn("masked_ids", F.transform("_marked", new_id))
            .withColumn("mlm_labels", F.transform("_marked", lambda e: F.when(
                e["on"], e["t"]).otherwise(F.lit(IGNORED)))).drop("_marked"))

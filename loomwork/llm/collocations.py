"""Operator 11, collocations of words, by Misra-Gries summaries and an exact second pass.

Texts fall into pieces at punctuation and line ends, pieces into words.  Sequences of
one to ``longest`` words within a piece are counted per language.

*First pass.*  Every slice of a few megabytes of text counts the hashes of its
sequences and deals them, already combined, into hash partitions (one per
``PART_BYTES`` of text).  A partition merges the slices into one Misra-Gries summary whose
capacity exceeds the partition's mass divided by the threshold, so what a counter
can lose stays below the threshold and no sequence that is frequent enough falls
out.  The partition also knows the loss exactly, and lets go what cannot reach
the threshold even with it.  Survivors are marked in a bit field of bounded size.

*Second pass.*  Sequences whose marks are set are counted by their words, not by hash:
combined per slice, then summed by Spark.  Sequences that the bits let through by
chance fall to the exact threshold, so neither hashes nor bits decide a result.

Scores need the parts of each phrase; phrases are joined with the counts of their parts
(a part that very many phrases share is split by the skew join), and the best of each
language are taken in two steps, first per salted share of a language.

A null or empty text has no words; a null language counts as ``und``, together with a
language of that name.  Repeated rows count each time, the id is not used.  Equal scores
are ordered by count, then by phrase in byte order.  An empty table gives an empty
result.  Only the text and language columns are read, so further columns cannot clash.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.llm import vectorwords as vw
from loomwork.session import materialize

LONGEST, LEAST, SHARE, BEST = 3, 10, 50, 2000
UNKNOWN = "und"
PART_BYTES = 8_000_000           # text bytes of a hash partition: some 4 million sequences
MERGED = 1 << 19                 # keys gathered before they enter a summary
SLICE_BYTES = 2_000_000          # text bytes that a task counts at once
BITS_PER_KEY = 16
FIELD_BITS = 1 << 29             # all marks together take 64 MB at most, then chance hits grow and the result stays
SALT = 64
BLOCK, ROWS = 1 << 18, 1 << 15   # sequences looked up, and phrases written out, at once

# Where a text falls into pieces, and what stands between the words of a piece.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
BLANKS = " \t"
_IS_END = np.zeros(256, dtype=bool)
_IS_END[[ord(c) for c in PIECE_ENDS]] = True
_IS_GAP = _IS_END.copy()
_IS_GAP[[ord(c) for c in BLANKS]] = True


class Sequences:
    """The word sequences of a slice of texts: hashes in, words out."""

    def __init__(self, texts: pa.Array, langs: pa.Array, longest: int):
        data, offsets = vw.column_bytes(texts)
        words = vw.find_words(data, offsets, _IS_GAP)
        self.data, self.start, self.end = data, words.start, words.end
        n = len(words.start)
        names = langs.dictionary_encode()
        self.langs = names.dictionary.to_pylist()
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(words.first))
        lang = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.lang = lang[row]
        ends = np.concatenate([[0], np.cumsum(_IS_END[data], dtype=np.int64)])
        piece = np.zeros(n, dtype=np.int64)
        if n:
            breaks = np.ones(n, dtype=bool)
            breaks[1:] = (ends[words.start[1:]] != ends[words.end[:-1]]) | (row[1:] != row[:-1])
            piece = np.cumsum(breaks)
        hashes = vw.hash_spans(data, words.start, words.end, vw.LOWER)
        self.words = hashes
        self.salt = vw.hash_spans(*_spans([s.encode() for s in self.langs]))[self.lang] if n else hashes
        factors = vw.mix(np.arange(1, longest + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        #: first word and number of words of every sequence, and a hash of language and words
        self.at, self.size, self.hash = [], [], []
        total = self.salt.copy()
        for k in range(longest):
            wide = max(0, n - k)
            total = total[:wide] + hashes[k:] * factors[k]
            inside = np.flatnonzero(piece[:wide] == piece[k:])
            self.at.append(inside)
            self.size.append(np.full(len(inside), k + 1, dtype=np.int8))
            self.hash.append(vw.mix(total[inside] ^ np.uint64(k)))
        self.at, self.size, self.hash = map(np.concatenate, (self.at, self.size, self.hash))

    def phrases(self, chosen: np.ndarray) -> pa.Array:
        """The words of sequences, lower-cased, with one space between."""
        at, size = self.at[chosen], self.size[chosen].astype(np.int64)
        first = np.cumsum(size) - size
        word = np.repeat(at - first, size) + np.arange(int(size.sum()))
        length = self.end[word] - self.start[word] + 1            # each word with the space behind it
        begin = np.cumsum(length) - length
        raw = np.repeat(self.start[word] - begin, length) + np.arange(int(length.sum()))
        joined = vw.LOWER[self.data[np.minimum(raw, len(self.data) - 1)]]
        joined[begin + length - 1] = 0x20
        stops = (begin + length)[first + size - 1]
        # the last space of each phrase is cut off by leaving it out of the bytes
        keep = np.ones(len(joined), dtype=bool)
        keep[stops - 1] = False
        offsets = np.concatenate([[0], stops - np.arange(1, len(stops) + 1)]).astype(np.int32)
        return pa.StringArray.from_buffers(len(chosen), pa.py_buffer(offsets), pa.py_buffer(joined[keep]))


def _spans(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    ends = np.cumsum([len(p) for p in parts], dtype=np.int64) if parts else np.zeros(0, dtype=np.int64)
    return data, ends - np.array([len(p) for p in parts], dtype=np.int64), ends


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins in a sorted array."""
    first = np.ones(len(ordered), dtype=bool)
    first[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(first)


def _counted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ordered = np.sort(hashes)
    begin = _runs(ordered)
    return ordered[begin], np.diff(np.append(begin, len(ordered)))


class Summary:
    """A Misra-Gries summary in arrays: at most ``capacity`` counters, each at most ``lost`` below the true count."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Merge counters: sum equal keys, then take the largest count beyond the capacity off every counter."""
        keys, counts = np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        begin = _runs(keys)
        keys, counts = keys[begin], np.add.reduceat(counts, begin) if len(begin) else counts
        if len(keys) > self.capacity:
            cut = len(keys) - self.capacity - 1
            off = int(np.partition(counts, cut)[cut])
            self.lost += off
            counts = counts - off
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts = keys, counts

    def reaching(self, least: int) -> np.ndarray:
        """Keys whose true count may be ``least`` or more."""
        return self.keys[self.counts + self.lost >= least]


def _marks(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit places of each key in a field of ``bits`` (a power of two)."""
    mask = np.uint64(bits - 1)
    mixed = vw.mix(keys.astype(np.uint64))
    return mixed & mask, (mixed >> np.uint64(32)) & mask


def _field(keys: np.ndarray, most: int) -> bytes:
    """A bit field in which both places of every key are set; a power of two of bits, ``most`` at most."""
    bits = 64
    while bits < min(BITS_PER_KEY * len(keys), most):
        bits *= 2
    field = np.zeros(bits, dtype=bool)
    for place in _marks(keys, bits):
        field[place] = True
    return np.packbits(field, bitorder="little").tobytes()


class Fields:
    """The bit fields of all partitions in one array."""

    def __init__(self, found: dict[int, bytes], parts: int):
        sizes = np.array([len(found.get(p, b"")) for p in range(parts)], dtype=np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.mask = (np.maximum(sizes * 8, 1) - 1).astype(np.uint64)
        self.some = sizes > 0
        self.bytes = np.frombuffer(b"".join(found.get(p, b"") for p in range(parts)) or b"\0", dtype=np.uint8)

    def hold(self, part: np.ndarray, keys: np.ndarray) -> np.ndarray:
        mixed, mask, first = vw.mix(keys.astype(np.uint64)), self.mask[part], self.first[part]
        out = self.some[part]
        for place in (mixed & mask, (mixed >> np.uint64(32)) & mask):
            here = np.minimum(first + (place >> np.uint64(3)).astype(np.int64), len(self.bytes) - 1)
            out &= (self.bytes[here] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out


def _dealt(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(partition, 32-bit key) of each hash: the high bits choose the partition in order."""
    part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return part.astype(np.int64), (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"),
                       F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"))


def summaries(rows: DataFrame, parts: int, longest: int, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(part, keys, counts, mass) of every slice: sorted 32-bit keys, the counts above 1 behind those of count 1."""
    def count(batches):
        for piece in vw.slices(batches, limit=slice_bytes):
            found = Sequences(piece.column(0), piece.column(1), longest)
            hashes, counts = _counted(found.hash)
            part, keys = _dealt(hashes, parts)
            begin = _runs(part)
            ends = np.append(begin[1:], len(part))
            out = []
            for a, b in zip(begin.tolist(), ends.tolist()):
                many = counts[a:b] > 1
                ordered = np.concatenate([keys[a:b][~many], keys[a:b][many]])
                out.append((int(part[a]), ordered.tobytes(), counts[a:b][many].astype(np.uint32).tobytes(),
                            int(counts[a:b].sum())))
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()),
                     pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.int64())],
                    ["part", "keys", "counts", "mass"])

    return rows.mapInArrow(count, "part int, keys binary, counts binary, mass long")


def survivors(found: DataFrame, parts: int, least: int) -> dict[int, bytes]:
    """The bit field of each partition's survivors; together at most ``FIELD_BITS`` and a word per partition."""
    most = max(64, FIELD_BITS // parts)
    mass = found.groupBy("part").agg(F.sum("mass").alias("whole"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, keys, counts, part = None, [], [], None
        gathered = 0
        for batch in batches:
            if summary is None and batch.num_rows:
                part, summary = batch.column(0)[0].as_py(), Summary(batch.column(3)[0].as_py() // least + 1)
            for key, count in zip(batch.column(1), batch.column(2)):      # one by one: no second copy of the batch
                many = np.frombuffer(count.as_py(), dtype=np.uint32).astype(np.int64)
                keys.append(np.frombuffer(key.as_py(), dtype=np.uint32))
                counts.append(np.concatenate([np.ones(len(keys[-1]) - len(many), dtype=np.int64), many]))
                gathered += len(keys[-1])
                if gathered >= MERGED:
                    summary.add(np.concatenate(keys), np.concatenate(counts))
                    keys, counts, gathered = [], [], 0
        if summary is not None:
            if keys:
                summary.add(np.concatenate(keys), np.concatenate(counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([_field(summary.reaching(least), most)], pa.binary())],
                ["part", "field"])

    fields = (found.join(mass, "part").select("part", "keys", "counts", "whole")
              .groupBy("part").applyInArrow(merge, "part int, field binary"))
    return {r["part"]: bytes(r["field"]) for r in fields.collect()}


def exact_counts(rows: DataFrame, fields: dict[int, bytes], parts: int, longest: int, least: int,
                 slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(lang, phrase, f) of every sequence with f >= least; the empty phrase counts the words of the language."""
    shared = rows.sparkSession.sparkContext.broadcast((fields, parts))

    def count(batches):
        marked = Fields(*shared.value)
        for piece in vw.slices(batches, limit=slice_bytes):
            found = Sequences(piece.column(0), piece.column(1), longest)
            chosen = np.concatenate([a + np.flatnonzero(marked.hold(*_dealt(found.hash[a:a + BLOCK], parts)))
                                     for a in range(0, len(found.hash), BLOCK)] or [np.zeros(0, dtype=np.int64)])
            chosen = chosen[np.argsort(found.hash[chosen], kind="stable")]
            begin = _runs(found.hash[chosen])
            begin = _told_apart(found, chosen, begin)
            counts = np.diff(np.append(begin, len(chosen)))
            first = chosen[begin]
            names = pa.array(found.langs, pa.string())
            for a in range(0, len(first), ROWS):
                some = first[a:a + ROWS]
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(found.lang[found.at[some]])), found.phrases(some),
                     pa.array(counts[a:a + ROWS].astype(np.int64))], ["lang", "phrase", "f"])
            held = np.bincount(found.lang, minlength=len(found.langs)).astype(np.int64)
            here = pa.array(np.flatnonzero(held))
            yield pa.RecordBatch.from_arrays(
                [names.take(here), pa.array([""] * len(here), pa.string()), pa.array(held[held > 0])],
                ["lang", "phrase", "f"])

    counted = rows.mapInArrow(count, "lang string, phrase string, f long")
    summed = counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return summed.where((F.col("f") >= least) | (F.col("phrase") == ""))


def _told_apart(found: Sequences, chosen: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Run starts, with a run cut wherever neighbours of equal hash differ in size, language or a word's hash."""
    at, size = found.at[chosen], found.size[chosen]
    differs = np.zeros(len(chosen), dtype=bool)
    if len(chosen) > 1:
        differs[1:] = (size[1:] != size[:-1]) | (found.lang[at[1:]] != found.lang[at[:-1]])
        last = len(found.words) - 1
        for k in range(int(found.size.max(initial=1))):
            word = found.words[np.minimum(at + k, last)]
            differs[1:] |= (word[1:] != word[:-1]) & (size[1:] > k)
    return np.union1d(begin, np.flatnonzero(differs))


def _parts_of(words: Column, size: Column) -> Column:
    """(part, cut, left) of both sides of every cut of a phrase."""
    def side(cut: Column, left: bool) -> Column:
        part = F.slice(words, 1, cut) if left else F.slice(words, cut + 1, size - cut)
        return F.struct(F.array_join(part, " ").alias("part"), cut.cast("int").alias("cut"), F.lit(left).alias("left"))

    cuts = F.sequence(F.lit(1), size - 1)
    return F.concat(F.transform(cuts, lambda c: side(c, True)), F.transform(cuts, lambda c: side(c, False)))


def scored(counts: DataFrame, longest: int, least: int, share: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases that no longer one makes superfluous."""
    words = F.split("phrase", " ", -1)
    phrases = (counts.where((F.col("phrase") != "") & F.col("phrase").contains(" ") & (F.col("f") >= least))
               .select("lang", "phrase", F.col("f").alias("a"), words.alias("w"), F.size(words).alias("size")))
    parts = phrases.select("lang", "phrase", "a", F.explode(_parts_of(F.col("w"), F.col("size"))).alias("p")).select(
        "lang", "phrase", "a", "p.part", "p.cut", "p.left")
    known = counts.where(F.col("phrase") != "").select("lang", F.col("phrase").alias("part"), "f")
    cuts = (parts.join(known, ["lang", "part"])
            .groupBy("lang", "phrase", "a", "cut")
            .agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r")))
    exact = "(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)))" \
            " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    lowest = (cuts.withColumn("score", F.expr(exact))
              .groupBy("lang", "phrase", "a")
              .agg(F.min(F.struct("score", "cut", "l", "r")).alias("least"))
              .select("lang", "phrase", "a", "least.l", "least.r", "least.score"))
    if longest < 3:
        return lowest
    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("size") - 1),
        lambda k: F.transform(F.sequence(F.lit(1), F.col("size") - k + 1),
                              lambda i: F.array_join(F.slice("w", i, k), " "))))
    covered = (phrases.where("size > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a")
               .groupBy("lang", "phrase").agg(F.max("a").alias("outer")))
    return (lowest.join(covered, ["lang", "phrase"], "left")
            .where(F.col("outer").isNull()
                   | (F.col("outer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * share))
            .drop("outer"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST,
                 share: int = SHARE, best: int = BEST, part_bytes: int | None = None,
                 slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The ``best`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    The first pass writes a row per slice and hash partition.  Executors with more
    memory take larger slices and partitions (``slice_bytes``, ``part_bytes``: some 12 bytes of
    memory per byte of slice, 4 per byte of partition), which keeps those rows few on
    corpora of many terabytes.
    """
    rows = _texts(docs, text, lang)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, math.ceil(size / (part_bytes or PART_BYTES)), min(cores, size // 1_000_000))
    found = materialize(summaries(rows, parts, longest, slice_bytes), "summaries")
    fields = survivors(found, parts, least)
    counts = materialize(exact_counts(rows, fields, parts, longest, least, slice_bytes), "phrases")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALT))).orderBy(*order)
    top = (scored(counts, longest, least, share)
           .withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= best)
           .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
           .where(F.col("rank") <= best))
    totals = counts.where(F.col("phrase") == "").select("lang", F.col("f").alias("n"))
    return top.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

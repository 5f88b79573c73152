"""User functions over rows and batches, and batch inference."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.functions import text as tx
from loomwork.session import materialize


def map_rows(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A user function over Arrow batches; for what no built-in expresses."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)
    return df.mapInPandas(run, schema)


def flat_map_rows(df: DataFrame, function: Callable[[tuple], Iterator[tuple]], schema: str,
                  rows_per_batch: int = 10_000) -> DataFrame:
    """A user function that yields any number of rows per row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for batch in batches:
            for row in batch.itertuples(index=False):
                for result in function(row):
                    out.append(result)
                    if len(out) >= rows_per_batch:
                        yield pd.DataFrame(out)
                        out = []
        if out:
            yield pd.DataFrame(out)

    names = T.StructType.fromDDL(schema).fieldNames()

    def named(batches):
        for pdf in run(batches):
            pdf.columns = names
            yield pdf
    return df.mapInPandas(named, schema)


def lateral_rows(df: DataFrame, function: Callable[..., Iterator[tuple]], arguments: list[str | Column],
                 schema: str) -> DataFrame:
    """All columns of ``df`` beside the rows (of ``schema``) that a user function gives for its arguments.

    A table function joined laterally: only the arguments travel to Python, in Arrow
    batches, and a row for which nothing comes has no row.
    """
    class Rows:
        def eval(self, *values):
            yield from function(*values)

    table = F.udtf(Rows, returnType=schema, useArrow=True)
    return df.lateralJoin(table(*[(F.col(a) if isinstance(a, str) else a).outer() for a in arguments]))


MODELS = "_loomwork_models"     # where a worker process keeps what it has loaded
KEPT_MODELS = 2


def _loaded(token: str, load: Callable[[], Callable]) -> Callable:
    """The model of a job, loaded once per worker process; the last few stay.

    Functions reach a worker by value, with globals of their own in every task, so the
    models are kept in a module that the process makes for them.
    """
    models = sys.modules.setdefault(MODELS, ModuleType(MODELS)).__dict__.setdefault("by_token", {})
    if token not in models:
        while len(models) >= KEPT_MODELS:
            del models[next(iter(models))]
        models[token] = load()
    return models[token]


def batch_score(df: DataFrame, key: str, features: str,
                load: Callable[[], Callable[[np.ndarray], np.ndarray]],
                keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, keep..., pred, confidence): ``load`` builds the model once per worker process, which then scores batches.

    The model maps an (n, d) matrix to (n, classes) logits.
    """
    token = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _loaded(token, load)
        for batch in batches:
            if batch.empty:
                continue
            logits = model(np.stack(batch[features].to_numpy()))
            logits = logits - logits.max(axis=1, keepdims=True)
            odds = np.exp(logits)
            best = odds.argmax(axis=1)
            yield batch[[key, *keep]].assign(pred=best.astype("int32"),
                                             confidence=odds.max(axis=1) / odds.sum(axis=1))
    kinds = dict(df.dtypes)
    kept = ", ".join(f"{c} {kinds[c]}" for c in (key, *keep))
    return df.select(key, *keep, features).mapInPandas(run, f"{kept}, pred int, confidence double")


def linear_model(weights: list[list[float]], bias: list[float]) -> Callable:
    """Loader of a linear scorer; weights are (classes, d)."""
    def load():
        w, b = np.asarray(weights), np.asarray(bias)
        return lambda x: x @ w.T + b
    return load


def _most_frequent(lists: pa.Array, most: int) -> pa.Array:
    """The ``most`` most frequent entries of each list, in the order they first appear; ties by that order."""
    flat = lists.flatten()
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    tagged = np.repeat(np.arange(len(size)), size) * max(1, len(coded.dictionary)) + codes
    _, first, n = np.unique(tagged, return_index=True, return_counts=True)
    row = np.searchsorted(np.cumsum(size), first, side="right")
    order = np.lexsort((first, -n, row))
    place = np.arange(len(row)) - np.searchsorted(row[order], row[order])
    kept = np.sort(first[order[place < most]])
    ends = np.searchsorted(kept, np.cumsum(size))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), flat.take(pa.array(kept)))


def _summarize_rows(df: DataFrame, key: str, column: str, most: int) -> DataFrame:
    """(key, words) of every row for itself, where it lies."""
    def work(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _most_frequent(batch.column(1), most)], [key, "words"])

    words = F.coalesce(tx.lower_words(F.col(column)), F.array().cast("array<string>"))
    return df.select(key, words.alias("words")).mapInArrow(work, f"`{key}` {dict(df.dtypes)[key]}, words array<string>")


def _summarize_keys(df: DataFrame, key: str, column: str, most: int) -> DataFrame:
    """(key, words) of all rows of a key together; words are counted per key before the shuffle."""
    words = df.select(key, F.posexplode_outer(tx.lower_words(F.col(column))).alias("pos", "word"))
    counted = words.groupBy(key, "word").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "first"))
    kept = counted.withColumn("_place", place).where(F.col("_place") <= most)
    entry = F.when(F.col("word").isNotNull(), F.struct("first", "word"))
    return kept.groupBy(key).agg(F.transform(
        F.array_sort(F.collect_list(entry)), lambda e: e["word"]).alias("words"))


def summarize(df: DataFrame, key: str, column: str, most: int = 15) -> DataFrame:
    """(key, words): the document's most frequent words, in the order they first appear.

    The whole text counts.  A document in one row is summarised where it lies; only
    those whose key repeats are shuffled, as words and counts.  A document without
    words has an empty list.
    """
    several = materialize(df.groupBy(key).agg(F.count("*").alias("_rows")).where("_rows > 1").select(
        F.col(key).alias("_several")), "several")
    rows = _summarize_rows(df, key, column, most)
    if several.isEmpty():
        return rows
    same = F.col(key).eqNullSafe(F.col("_several"))
    return rows.join(several, same, "left_anti").unionByName(
        _summarize_keys(df.join(several, same, "left_semi"), key, column, most))


def two_stage_inference(df: DataFrame, key: str, column: str, table: dict[str, str], most: int = 15) -> DataFrame:
    """(key, summary, translation): summarise, then translate the summary word by word.

    Every document gets an answer; that of a document without words is empty.
    """
    short = summarize(df, key, column, most)
    return short.select(key, F.array_join("words", " ").alias("summary"),
                        F.array_join(tx.replace_words(F.col("words"), table), " ").alias("translation"))

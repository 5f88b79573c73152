"""Reproducible splits, shards, batches and draws."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions.hashing import digest, draw_int
from loomwork.operators import scan
from loomwork.session import materialize

_H = "_digest"


def _cuts(df: DataFrame, key: str, seed, ranks: Callable[[int], list[int]],
          rows_per_block: int | None) -> list[Column]:
    """Conditions "is before rank r in the seeded order"; ``ranks`` gives them from n.

    Only keys and digests are ordered to find the rows at the ranks; the data is
    then split where it lies, by comparing each row's own digest.
    """
    hashed = df.select(key, digest(F.col(key), seed).alias(_H))
    indexed, rows = scan.dense_index(hashed, [_H, key], "idx", rows_per_block)
    wanted = ranks(rows)
    found = scan.rows_at(indexed, wanted)
    own = F.struct(digest(F.col(key), seed).alias("h"), F.col(key).alias("k"))
    return [own < F.struct(F.lit(found[r][_H]).alias("h"), F.lit(found[r][key]).alias("k"))
            if r in found else F.lit(True) for r in wanted]


def split_three_way(df: DataFrame, key: str, seed: int, share: float = 0.1,
                    rows_per_block: int | None = None) -> DataFrame:
    """Add ``split``: exactly int(share*n) test rows, as many val rows, the rest train."""
    test, val = _cuts(df, key, seed, lambda n: [int(share * n), 2 * int(share * n)], rows_per_block)
    return df.withColumn("split", F.when(test, "test").when(val, "val").otherwise("train"))


def split_fraction(df: DataFrame, key: str, seed: int, test_share: float = 0.2,
                   rows_per_block: int | None = None) -> DataFrame:
    """Add ``split``: ceil(test_share*n) test rows, the rest train."""
    test, = _cuts(df, key, seed, lambda n: [math.ceil(round(test_share * n, 9))], rows_per_block)
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def shuffled_batches(df: DataFrame, key: str, epoch: int, seed: int, size: int,
                     rows_per_block: int | None = None) -> DataFrame:
    """Add batch_id and place for one epoch's shuffle; the last batch may be short."""
    hashed = df.withColumn(_H, digest(F.col(key), f"{epoch}:{seed}"))
    indexed, _ = scan.dense_index(hashed, [_H, key], "idx", rows_per_block)
    return (indexed.drop(_H).withColumn("batch_id", F.floor(F.col("idx") / size).cast("long"))
            .withColumn("place", (F.col("idx") % size).cast("int")).drop("idx"))


def ordered_batches(df: DataFrame, key: str, size: int,
                    rows_per_block: int | None = None) -> DataFrame:
    """Add batch_id by key order."""
    indexed, _ = scan.dense_index(df, [key], rows_per_block=rows_per_block)
    return indexed.withColumn("batch_id", F.floor(F.col("idx") / size).cast("long")).drop("idx")


def _pieces(df: DataFrame, key: str, pieces: int, bounds: range, rows_per_block: int | None) -> Column:
    """How many of the ``bounds`` (multiples of n div pieces) a row's rank has reached.

    The keys at the bounds are found once; the rows stay where they are.  Keys are
    compared as structs, so a null key comes first.
    """
    indexed, rows = scan.dense_index(df.select(key), [key], rows_per_block=rows_per_block)
    size = rows // pieces
    if size == 0:
        return F.lit(len(bounds))
    found = scan.rows_at(indexed, [i * size for i in bounds])
    kind = df.schema[key].dataType
    keys = [F.struct(F.lit(row[key]).cast(kind).alias("k")) for row in found.values()]
    own = F.struct(F.col(key).alias("k"))
    return F.size(F.filter(F.array(*keys), lambda bound: bound <= own)) if keys else F.lit(0)


def contiguous_shards(df: DataFrame, key: str, shards: int,
                      rows_per_block: int | None = None) -> DataFrame:
    """Add ``shard``: n div shards rows each, the last takes the remainder (all rows if n < shards)."""
    return df.withColumn("shard", _pieces(df, key, shards, range(1, shards), rows_per_block))


def chunk_partitions(df: DataFrame, key: str, chunks: int,
                     rows_per_block: int | None = None) -> DataFrame:
    """Add ``chunk``: n div chunks rows each; the rows left over are dropped (all rows if n < chunks)."""
    chunked = df.withColumn("chunk", _pieces(df, key, chunks, range(1, chunks + 1), rows_per_block))
    return chunked.where(F.col("chunk") < chunks)


def sample_with_replacement(df: DataFrame, key: str, draws: int, seed: int,
                            rows_per_block: int | None = None) -> DataFrame:
    """``draws`` rows chosen by repeatable draws; a row may come up more than once.

    Only keys are ranked.  Rows with a drawn key are then fetched and ranked among
    themselves, which tells the rows of a repeated key apart.
    """
    keys, rows = scan.dense_index(df.select(key), [key], "_idx", rows_per_block)
    picks = df.sparkSession.range(draws if rows else 0).select(
        F.col("id").alias("draw"), draw_int(rows - 1, F.col("id"), seed).alias("_idx"))
    drawn = materialize(keys.join(picks, "_idx"), "drawn")
    wanted = drawn.select(key).distinct().withColumn("_drawn", F.lit(True))

    def fetched(rows: DataFrame) -> DataFrame:
        return scan.looked_up(rows, wanted, [key]).where("_drawn").drop("_drawn")
    found, _ = scan.dense_index(fetched(df), [key], "_at", rows_per_block)
    first = fetched(keys).groupBy(key).agg(F.min("_idx").alias("_first"))
    low = found.groupBy(key).agg(F.min("_at").alias("_low"))
    places = scan.looked_up(scan.looked_up(drawn, first, [key]), low, [key]).select(
        "draw", (F.col("_low") + F.col("_idx") - F.col("_first")).alias("_at"))
    return found.join(places, "_at").drop("_at")


def sort_top_k(df: DataFrame, value: str, key: str, k: int) -> DataFrame:
    return df.orderBy(F.desc(value), F.asc(key)).limit(k)


def best_per_group(df: DataFrame, group: str, value: str, tie: str) -> DataFrame:
    """One row per group: the largest value, the lowest ``tie`` among equals."""
    return df.groupBy(group).agg(F.min_by(tie, F.struct(-F.col(value), F.col(tie))).alias(tie),
                                 F.max(value).alias(value))

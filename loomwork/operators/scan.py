"""Ordered operators that never put a whole table, or a whole hot key, in one task.

A dense index or a running value needs every row's rank.  Rows are cut into
blocks that follow the order: each block is ranked on its own, and the totals of
the earlier blocks are added.  Spark's range exchange cuts the blocks on the whole
order key in its own type, so strings, dates, nulls (first) and NaN (last) take
their places and a value that fills a block is cut along the next column.  The cut
rows are written once: every later step, and a retried task, sees the same blocks.

Order columns are ascending; a descending order is given by a key that ascends.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from loomwork.session import materialize

ROWS_PER_BLOCK = 100_000  # rows ranked in one task
HOT_ROWS = 1_000_000      # a key with more rows is cut into pieces

_BLK = "_blk"
_ROW = "_row"
_IN_BLOCK = (1 << 33) - 1  # places of a block in monotonically_increasing_id

Order = Sequence[str | Column]


def _columns(order: Order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def block_count(rows: int, rows_per_block: int) -> int:
    return max(1, math.ceil(rows / rows_per_block))


def cut(df: DataFrame, order: Order, blocks: int, name: str) -> DataFrame:
    """``df`` written in ``blocks`` blocks that follow the order, sorted inside, with the
    block (``_blk``, from 0) and the place in it (``_row``, from 0) of each row."""
    columns = _columns(order)
    number = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(blocks, *columns) if blocks > 1 else df.repartition(1)
    placed = ranged.sortWithinPartitions(*columns).withColumn(_ROW, number)
    return (materialize(placed, name)
            .withColumn(_BLK, F.shiftright(_ROW, 33).cast("int"))
            .withColumn(_ROW, F.col(_ROW).bitwiseAND(F.lit(_IN_BLOCK))))


def rows_at(indexed: DataFrame, ranks: list[int], index: str = "idx") -> dict[int, Row]:
    """The rows of an indexed frame at these ranks (those that exist); one row per rank."""
    return {row[index]: row for row in indexed.where(F.col(index).isin(ranks)).collect()}


def _starts(blocked: DataFrame, *more: Column) -> DataFrame:
    """One row per block: its number of rows before (``_start``), and more aggregates."""
    earlier = Window.orderBy(_BLK).rowsBetween(Window.unboundedPreceding, -1)
    counted = blocked.groupBy(_BLK).agg(F.count("*").alias("_n"), *more)
    return counted.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")


def dense_index(df: DataFrame, order: Order, name: str = "idx",
                rows_per_block: int | None = None) -> tuple[DataFrame, int]:
    """Add 0..n-1 in ``order``; returns the frame and n.  Of equal rows any may come first."""
    rows = df.count()
    blocked = cut(df, order, block_count(rows, rows_per_block or ROWS_PER_BLOCK), "index")
    return (blocked.join(_starts(blocked), _BLK)  # a row per block
            .withColumn(name, F.col("_start") + F.col(_ROW)).drop(_BLK, _ROW, "_start"), rows)


def index_with_next(df: DataFrame, order: Order, value: str, sized_by: DataFrame,
                    name: str = "idx", next_name: str = "next",
                    rows_per_block: int | None = None) -> DataFrame:
    """Add 0..n-1 in ``order`` and the next row's ``value``; the last row gets the first one's.

    As many blocks are cut as the rows of ``sized_by``, a frame that is cheap to count, ask for.
    """
    blocked = cut(df, order, block_count(sized_by.count(), rows_per_block or ROWS_PER_BLOCK), "next")
    along = Window.orderBy(_BLK)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # A struct, so that a null value of the next block is told from a block without a next one.
    heads = _starts(blocked, F.min_by(F.struct(F.col(value).alias("v")), _ROW).alias("_head"))
    heads = heads.withColumn("_after", F.coalesce(F.lead("_head").over(along), F.first("_head").over(whole)))
    inside = Window.partitionBy(_BLK).orderBy(_ROW)
    return (blocked.withColumn("_later", F.lead(F.struct(F.col(value).alias("v"))).over(inside))
            .join(heads.drop("_head"), _BLK)
            .withColumn(name, F.col("_start") + F.col(_ROW))
            .withColumn(next_name, F.coalesce("_later", "_after")["v"])
            .drop(_BLK, _ROW, "_later", "_start", "_after"))


def _same(keys: list[str], left: str, right: str) -> Column:
    """Null-safe equality of the keys of two aliased frames."""
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return same


def looked_up(df: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """The other columns of ``found`` added to the rows with the same keys; a null key matches a null key."""
    new = [c for c in found.columns if c not in keys]
    return (df.alias("l").join(found.alias("r"), _same(keys, "l", "r"), "left")
            .select(*[F.col(f"l.{c}") for c in df.columns], *[F.col(f"r.{c}") for c in new]))


def split_hot_keys(df: DataFrame, keys: list[str], order: Order,
                   limit: int | None = None) -> tuple[DataFrame, bool]:
    """Block 0 for ordinary keys; keys with more than ``limit`` rows get blocks 1, 2, ... along the order.

    Returns the frame and whether any key was split.  Null is a key like any other.
    The counting pass is a partial aggregate; at most rows/limit keys are hot.
    """
    limit = limit or HOT_ROWS
    if not keys:
        rows = df.count()
        if rows <= limit:
            return df.withColumn(_BLK, F.lit(0)), False
        pieces = cut(df, order, block_count(rows, limit), "pieces")
        return pieces.withColumn(_BLK, F.col(_BLK) + 1).drop(_ROW), True
    hot = materialize(df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > limit), "hot")
    found, rows = hot.agg(F.count("*"), F.sum("_n")).first()
    if found == 0:
        return df.withColumn(_BLK, F.lit(0)), False
    marked = looked_up(df, hot.select(*keys, F.lit(True).alias("_hot")), keys)
    pieces = cut(marked.where("_hot"), [*keys, *order], block_count(rows, limit) + found, "pieces")
    rest = marked.where(F.col("_hot").isNull()).withColumn(_BLK, F.lit(0))
    return rest.unionByName(pieces.withColumn(_BLK, F.col(_BLK) + 1).drop(_ROW)).drop("_hot"), True


def running(df: DataFrame, keys: list[str], order: Order, values: dict[str, Column],
            limit: int | None = None, largest: bool = False, before: bool = False) -> DataFrame:
    """Per-key running sums (or the ``largest`` so far), exact for hot keys too.

    The current row counts unless ``before``; a sum of nothing is 0, a largest of
    nothing null.  A hot key is cut along the order; each piece is done on its own
    and the earlier pieces carried.
    """
    combine = F.max if largest else F.sum

    def filled(column):
        return column if largest else F.coalesce(column, F.lit(0))

    def joined(a, b):
        return F.greatest(a, b) if largest else a + b
    blocked, split = split_hot_keys(df, keys, order, limit)
    for i, value in enumerate(values.values()):
        blocked = blocked.withColumn(f"_v{i}", value)
    local = (Window.partitionBy(*keys, _BLK).orderBy(*_columns(order))
             .rowsBetween(Window.unboundedPreceding, -1 if before else Window.currentRow))
    out = blocked
    for i, name in enumerate(values):
        out = out.withColumn(name, filled(combine(f"_v{i}").over(local)))
    if split:
        earlier = (Window.partitionBy(*keys).orderBy(_BLK)
                   .rowsBetween(Window.unboundedPreceding, -1))
        # Only pieces of hot keys carry anything: a short table.
        totals = blocked.where(F.col(_BLK) > 0).groupBy(*keys, _BLK).agg(
            *[combine(f"_v{i}").alias(f"_t{i}") for i in range(len(values))])
        carried = totals.select(*keys, _BLK, *[
            combine(f"_t{i}").over(earlier).alias(f"_c{i}") for i in range(len(values))])
        out = looked_up(out, carried, [*keys, _BLK])
        for i, name in enumerate(values):
            out = out.withColumn(name, joined(F.col(name), filled(F.col(f"_c{i}"))))
        out = out.drop(*[f"_c{i}" for i in range(len(values))])
    return out.drop(_BLK, *[f"_v{i}" for i in range(len(values))])


def following(df: DataFrame, keys: list[str], order: Order, value: str, name: str,
              limit: int | None = None) -> DataFrame:
    """The next row's ``value`` within the key (null on the last row)."""
    blocked, split = split_hot_keys(df, keys, order, limit)
    columns = _columns(order)
    inside = Window.partitionBy(*keys, _BLK).orderBy(*columns)
    if not split:
        return blocked.withColumn(name, F.lead(value).over(inside)).drop(_BLK)
    out = blocked.withColumn("_later", F.lead(F.struct(F.col(value).alias("v"))).over(inside))
    heads = blocked.where(F.col(_BLK) > 0).groupBy(*keys, _BLK).agg(
        F.min_by(F.struct(F.col(value).alias("v")), F.struct(*columns)).alias("_head"))
    heads = heads.select(*keys, _BLK, F.lead("_head").over(
        Window.partitionBy(*keys).orderBy(_BLK)).alias("_after"))
    return (looked_up(out, heads, [*keys, _BLK])
            .withColumn(name, F.coalesce("_later", "_after")["v"]).drop(_BLK, "_later", "_after"))

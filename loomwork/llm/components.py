"""Connected components of a table of links, by alternating large and small stars.

Every step is a grouped minimum (combined before the shuffle) and an equi-join
against it.  The minima are written before the join, so both join sides are
plain shuffles and a node with very many links is split by the skew join.  Each
round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.session import materialize

MAX_ROUNDS = 60


def _smallest(links: DataFrame) -> DataFrame:
    """(u, m): the smallest neighbour of u, or u itself."""
    low = links.groupBy("u").agg(F.min("v").alias("m"))
    return materialize(low.select("u", F.least("u", "m").alias("m")), "stars")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.where("v > u").join(_smallest(both), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    low = _smallest(links)
    moved = links.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
    return moved.union(low.where("u > m").select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id that a link names; component is the smallest id reachable.

    Repeated links, loops and either direction are allowed; rows with a null end
    are no links.  An empty table gives an empty table.
    """
    whole = links.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    ids = whole.select(F.explode(F.array(a, b)).alias("id")).distinct()
    now = materialize(whole.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    before = _state(now)
    for _ in range(MAX_ROUNDS):
        now = materialize(_small_star(materialize(_large_star(now), "links")), "links")
        after = _state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
    return (ids.join(now.withColumnRenamed("u", "id"), "id", "left")
            .select("id", F.coalesce("v", "id").alias("component")))

"""Step and epoch series: counters, blocks, best so far, early stop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.operators import scan


def running_counter(df: DataFrame, key: str, order: list[str], limit: int | None = None) -> DataFrame:
    """Add ``calls``, the number of the key's rows so far, and the greeting it returns."""
    counted = scan.running(df, [key], order, {"calls": F.lit(1)}, limit)
    return counted.withColumn("calls", F.col("calls").cast("long")).withColumn(
        "greeting", F.concat(F.lit("Hi user #"), F.col("calls").cast("string")))


def running_loss_blocks(steps: DataFrame, epoch: str, step: str, loss: str, size: int) -> DataFrame:
    """Mean loss of each full block of ``size`` steps (step from 1); a short tail is not reported."""
    block = F.floor((F.col(step) - 1) / size).cast("long")
    return (steps.groupBy(epoch, block.alias("block"))
            .agg(F.avg(loss).alias("mean_loss"), F.count("*").alias("_n"))
            .where(F.col("_n") == size).drop("_n"))


def epoch_average_loss(df: DataFrame, epoch: Column, loss: str) -> DataFrame:
    return df.groupBy(epoch.alias("epoch")).agg(F.avg(loss).alias("mean_loss")).orderBy("epoch")


def best_so_far(log: DataFrame, epoch: str, metric: str, start: float,
                limit: int | None = None) -> DataFrame:
    """Add ``best`` (before the row) and ``is_new_best`` (metric above it; the first wins a tie)."""
    seen = scan.running(log, [], [epoch], {"best": F.col(metric)}, limit or scan.ROWS_PER_BLOCK,
                        largest=True, before=True)
    first = F.lit(float(start))
    return (seen.withColumn("best", F.greatest(first, F.coalesce("best", first)))
            .withColumn("is_new_best", F.col(metric) > F.col("best")))


def early_stop(log: DataFrame, epoch: str, reward: str, threshold: float, at_most: int) -> DataFrame:
    """Epochs up to and with the first whose reward reaches the threshold, ``at_most`` in all."""
    # at_most rows are left before the window.
    first = log.orderBy(epoch).limit(at_most)
    before = Window.orderBy(epoch).rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max((F.col(reward) >= threshold).cast("int")).over(before)
    return (first.withColumn("_hit", F.coalesce(reached, F.lit(0)))
            .where(F.col("_hit") == 0).drop("_hit"))


def mean_steps(df: DataFrame, episode: str) -> DataFrame:
    """Steps per episode on average."""
    per = df.groupBy(episode).agg(F.count("*").alias("steps"))
    return per.agg(F.sum("steps").alias("steps"), F.count("*").alias("episodes"),
                   F.avg("steps").alias("mean_steps"))


def elapsed_min_sec(df: DataFrame, key: str, micros: Column) -> DataFrame:
    """Whole minutes and remaining whole seconds between a key's first and last row."""
    seconds = F.floor((F.max(micros) - F.min(micros)) / F.lit(1_000_000)).cast("long")
    return df.groupBy(key).agg(seconds.alias("s")).select(
        key, F.floor(F.col("s") / 60).cast("long").alias("minutes"),
        (F.col("s") % 60).alias("seconds"))

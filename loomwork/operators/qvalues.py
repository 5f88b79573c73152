"""Action values from an experience table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.operators.splits import best_per_group
from loomwork.session import materialize

def q_value_iteration(rows: DataFrame, sweeps: int, weight: float = 0.1,
                      discount: float = 0.9) -> DataFrame:
    """(state, action, q) after synchronous sweeps over (state, action, reward, next_state).

    q <- (1-weight) q + weight * mean(reward + discount * max q(next)), from 0.
    The experience is summed once per (state, action, next_state); the sweeps
    work on those sums, whose number does not grow with the rows.
    """
    moves = materialize(rows.groupBy("state", "action", "next_state").agg(
        F.count("*").alias("n"), F.sum("reward").alias("r")), "moves")
    q = moves.select("state", "action").distinct().withColumn("q", F.lit(0.0))
    for _ in range(sweeps):
        best = q.groupBy(F.col("state").alias("next_state")).agg(F.max("q").alias("best"))
        gain = F.col("r") + F.lit(discount) * F.col("n") * F.coalesce(F.col("best"), F.lit(0.0))
        target = (moves.join(best, "next_state", "left").groupBy("state", "action")
                  .agg((F.sum(gain) / F.sum("n")).alias("target")))
        q = q.join(target, ["state", "action"]).select(
            "state", "action", (F.lit(1 - weight) * F.col("q") + F.lit(weight) * F.col("target")).alias("q"))
        q = materialize(q, "sweep")  # each sweep uses the one before twice
    return q


def greedy_action(q: DataFrame) -> DataFrame:
    """(state, action, q): the best action of each state, the lowest one on ties."""
    return best_per_group(q, "state", "q", "action")

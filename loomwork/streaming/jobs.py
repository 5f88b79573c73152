"""Streams of operations, calls, requests and metrics.

Each job reads what is available, keeps its progress and state in a checkpoint
folder, and can be started again there: a micro-batch that is repeated
replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions.chat import json_request_reply
from loomwork.operators.ledger import account_ledger
from loomwork.session import materialize, new_folder
from loomwork.sources import sinks

TRIGGER_BYTES = 256 * 1024 * 1024


def read_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A parquet folder (or file) as a stream; a trigger takes a bounded amount."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if not files_per_trigger:
        reader = reader.option("maxBytesPerTrigger", TRIGGER_BYTES)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # Written as a glob: the file source takes a single file only that way.
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def run_available(writer, checkpoint: str) -> None:
    """Process everything that is available, then stop."""
    query = (writer.option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def account_stream(ops: DataFrame, out: str, checkpoint: str, opening="100.00", minimal="20.00",
                   delay: int = 0) -> None:
    """Apply a stream of operations (account, ts, id, op, amount) to accounts in the order of (ts, id).

    Micro-batches only log their operations, so neither the order of the files nor
    the size of a trigger matters.  When all that is available is logged, the
    operations up to the greatest ts less ``delay`` are folded and ``out`` gets the
    changed states; younger ones wait for the next call.  An operation that arrives
    after its time was folded goes to ``late_operations``.  A call reads the new
    operations and the waiting ones only, and removes what it has folded from the log.
    """
    run_available(ops.writeStream.outputMode("append").foreachBatch(
        lambda batch, n: sinks.save_snapshot(batch, f"{out}/ops", n)), checkpoint)
    settle_accounts(ops.sparkSession, out, opening, minimal, delay)


def settle_accounts(spark: SparkSession, out: str, opening, minimal, delay: int) -> None:
    """Fold the logged operations that are due; called again without new ones it changes nothing."""
    mark, seen = -(1 << 62), -1
    if sinks.versions(spark, f"{out}/marks"):
        mark, seen = sinks.latest_records(spark, f"{out}/marks", "name").select("mark", "seen").first()
    new = [v for v in sinks.versions(spark, f"{out}/ops") if v > seen]
    if not new:
        return
    last = new[-1]
    logged = spark.read.parquet(*[f"{out}/ops/version={v}" for v in new])
    # an operation without a time comes first: due at once, late ever after
    at = F.coalesce("ts", F.lit(1 - (1 << 62)))
    sinks.save_snapshot(logged.where(at <= mark), f"{out}/late", last)
    in_time = logged.where(at > mark)
    if seen >= 0:
        in_time = in_time.unionByName(spark.read.schema(logged.schema).parquet(f"{out}/waiting/version={seen}"))
    newest = in_time.agg(F.max(at)).first()[0]
    due = mark if newest is None else max(mark, newest - delay)
    sinks.save_snapshot(in_time.where(at > due), f"{out}/waiting", last)
    ripe = materialize(in_time.where(at <= due), "ripe")
    before = ripe.select("account").distinct()
    if sinks.versions(spark, f"{out}/states"):
        before = sinks.restore_snapshot(spark, f"{out}/states", before, "account")
    else:
        before = before.select("account", F.lit(None).cast("decimal(18,2)").alias("balance"),
                               *[F.lit(0).cast("long").alias(c) for c in ("accepted", "rejected")])
    accounts = before.select("account", F.coalesce("balance", F.lit(opening).cast("decimal(18,2)")).alias("balance"),
                             F.lit(minimal).cast("decimal(18,2)").alias("minimal"))
    counts = before.select("account", *[F.coalesce(c, F.lit(0)).alias(f"_{c}") for c in ("accepted", "rejected")])
    folded = account_ledger(ripe, accounts).join(counts, "account").select(
        "account", "balance", *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in ("accepted", "rejected")])
    sinks.save_snapshot(folded, f"{out}/states", last)
    sinks.compact(spark, f"{out}/states", "account")
    sinks.save_snapshot(spark.createDataFrame([("accounts", due, last)], "name string, mark long, seen long"),
                        f"{out}/marks", last)
    sinks.drop_versions(spark, f"{out}/ops", last)
    sinks.drop_versions(spark, f"{out}/waiting", last - 1)


def account_states(spark: SparkSession, out: str) -> DataFrame:
    """(account, balance, accepted, rejected) after the operations folded so far."""
    return latest_states(spark, f"{out}/states", "account")


def late_operations(spark: SparkSession, out: str) -> DataFrame:
    """Operations that came after their time was folded."""
    return spark.read.parquet(f"{out}/late/version=*")


def latest_states(spark: SparkSession, out: str, key: str) -> DataFrame:
    """State of each key after the last batch that changed it."""
    return sinks.latest_records(spark, out, key).drop("version")


def counter_stream(rows: DataFrame, key: str, out: str, checkpoint: str) -> None:
    """Running count per key; ``out`` gets the changed counts of each batch."""
    counted = rows.groupBy(key).agg(F.count("*").alias("calls"))
    def save(batch, n):
        sinks.save_snapshot(batch, out, n)
        sinks.compact(batch.sparkSession, out, key)
    run_available(counted.writeStream.outputMode("update").foreachBatch(save), checkpoint)


def request_stream(requests: DataFrame, out: str, checkpoint: str, field: str = "name") -> None:
    """One reply per JSON request (id, body)."""
    replies = requests.select("id", json_request_reply(F.col("body"), field).alias("reply"))
    run_available(replies.writeStream.outputMode("append").format("parquet").option("path", out), checkpoint)


def metric_stream(scalars: DataFrame, out: str, checkpoint: str) -> None:
    """Append (tag, step, value) rows of a running job; each batch has its own folder."""
    run_available(scalars.writeStream.outputMode("append").foreachBatch(
        lambda batch, n: batch.write.mode("overwrite").partitionBy("tag").parquet(f"{out}/batch={n}")), checkpoint)


def stream_folders(spark: SparkSession, name: str) -> tuple[str, str]:
    """Output and checkpoint folder of a new stream."""
    root = new_folder(spark, name)
    return f"{root}/out", f"{root}/checkpoint"

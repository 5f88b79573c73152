"""Files out: chat JSON lines, text corpora, state snapshots, metric logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_chat_jsonl(records: DataFrame, path: str) -> None:
    """One record per line in UTF-8, nulls written."""
    records.write.option("ignoreNullFields", "false").json(path)


def write_text_corpus(texts: DataFrame, path: str) -> None:
    """Rendered conversations as {"text": ...} lines."""
    texts.select("text").write.json(path)


COMPACT_AFTER = 20  # versions that a reader merges before they are written as one


def versions(spark: SparkSession, path: str, kind: str = "version") -> list[int]:
    """The numbers of the complete versions saved under ``path``, ascending."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.globStatus(hadoop.Path(f"{path}/{kind}=*/_SUCCESS")) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


def save_snapshot(state: DataFrame, path: str, version: int) -> None:
    """State records of one version; saving a version again replaces it."""
    state.write.mode("overwrite").parquet(f"{path}/version={int(version)}")


def drop_versions(spark: SparkSession, path: str, last: int) -> None:
    """Remove the versions up to ``last``; whoever reads them must be done."""
    for version in versions(spark, path):
        if version <= last:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={version}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _since(spark: SparkSession, path: str) -> DataFrame:
    """The last full state and the versions after it."""
    full = versions(spark, path, "full")[-1:]
    later = [v for v in versions(spark, path) if not full or v > full[0]]
    parts = [spark.read.parquet(f"{path}/full={full[0]}")] if full else []
    if later:
        saved = spark.read.option("basePath", path).parquet(*[f"{path}/version={v}" for v in later])
        parts.append(saved.withColumn("version", F.col("version").cast("int")))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def latest_records(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The record of each saved key in the last version that has it."""
    saved = _since(spark, path)
    fields = [c for c in saved.columns if c not in (key, "version")]
    return (saved.groupBy(key)
            .agg(F.max_by(F.struct(*fields, "version"), "version").alias("_s"))
            .select(key, "_s.*"))


def compact(spark: SparkSession, path: str, key: str, after: int = COMPACT_AFTER) -> None:
    """Write the latest records as one full state once ``after`` versions follow the last one.

    Readers then merge at most that many versions; the older ones may be removed.
    """
    full, saved = versions(spark, path, "full")[-1:], versions(spark, path)
    if saved and len([v for v in saved if not full or v > full[0]]) >= after:
        latest_records(spark, path, key).write.mode("overwrite").parquet(f"{path}/full={saved[-1]}")


def restore_snapshot(spark: SparkSession, path: str, keys: DataFrame, key: str) -> DataFrame:
    """Latest saved record of each key asked for; nulls for a key never saved."""
    return keys.join(latest_records(spark, path, key), key, "left")


def verify_digest(content: Column, expected: Column) -> Column:
    """True where the MD5 of the content is the expected one; null if none is expected."""
    return F.md5(content) == expected


def global_step(epoch: Column, step: Column, epoch_len: int) -> Column:
    return epoch * F.lit(epoch_len) + step


def append_metrics(scalars: DataFrame, path: str) -> None:
    """Append (tag, step, value) rows; a tag is a partition."""
    scalars.select("step", "value", "tag").write.mode("append").partitionBy("tag").parquet(path)

"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  memory: str = "8g", app: str = "loomwork") -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", memory)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="loomwork-"))
    return (folder or context.getCheckpointDir()).rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/loomwork/{name}-{uuid.uuid4().hex}"


_written: list[str] = []  # intermediate tables of this process
_scopes: dict[int, list[str]] = {}  # by thread: those of its innermost ``only_kept``


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later steps then see one fixed set of rows, also after an executor is lost.  The
    table stays until ``release``, as a result may still read it.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    _written.append(path)
    if threading.get_ident() in _scopes:
        _scopes[threading.get_ident()].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, paths: list[str]) -> None:
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def only_kept(spark: SparkSession, *keep: str) -> Iterator[None]:
    """Tables that are materialized inside go at its end, but those named in ``keep``.

    What is read afterwards must come from those alone.
    """
    thread = threading.get_ident()
    outer, own = _scopes.get(thread), []
    _scopes[thread] = own
    try:
        yield
    finally:
        if outer is None:
            del _scopes[thread]
        else:
            _scopes[thread] = outer
    kept = [path for path in own if path.rsplit("/", 1)[1].rsplit("-", 1)[0] in keep]
    gone = [path for path in own if path not in kept]
    _remove(spark, gone)
    for path in gone:
        _written.remove(path)
    if outer is not None:
        outer.extend(kept)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a query that runs inside has shuffled goes as soon as it ends, not when the driver collects its garbage.

    A table that is materialized inside needs its shuffles no more once it is written.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def release(spark: SparkSession) -> None:
    """Remove the intermediate tables written so far; results that still read them end."""
    _remove(spark, _written)
    _written.clear()

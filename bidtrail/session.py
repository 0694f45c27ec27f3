"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Run-time SQL settings every job relies on.  AQE splits hot shuffle partitions of a join (also where
# that needs one more exchange) and merges tiny ones; sizes and partition counts stay the cluster's.  The JVM
# never compiles methods over 8000 bytes, so wide projections must not be fused beyond that.  The files of a query's
# shuffles go when it ends, not when the driver happens to collect its garbage; a second action on the same frame makes them anew.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

_local_scratch: str | None = None
# Paths of the tables stored so far inside the innermost passing() of this thread.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def configure(spark: SparkSession) -> SparkSession:
    """Apply SQL_SETTINGS to a running session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str, cores: int | str = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """One-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        # PySpark would record a stack trace for every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.streaming.metricsEnabled", "false")
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """A folder that all executors see: spark.checkpoint.dir, else the context's checkpoint folder, else the warehouse.

    A temporary folder of the driver is used only where the master is local and neither of the first two is set.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        folder = spark.sparkContext._jsc.sc().getCheckpointDir()
        configured = folder.get() if folder.isDefined() else None
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="bidtrail-")
        atexit.register(shutil.rmtree, _local_scratch, ignore_errors=True)
    return _local_scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared root."""
    return f"{shared_root(spark)}/bidtrail/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The frame written once as a table in the shared folder and read back.

    What was costly to compute is computed once, its size becomes known, and a lost executor costs a re-read.
    """
    path = scratch_path(df.sparkSession, "stored")
    if (paths := _passing.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, *paths: str) -> None:
    """Deletes tables that stored() wrote."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[list[str]]:
    """Tables stored inside go at the end, all but the last one, which is the result and counts as stored outside.

    So nothing made inside may be used outside but that table.  Yields the paths so far.
    """
    paths: list[str] = []
    outside = _passing.get()
    token, done = _passing.set(paths), False
    try:
        yield paths
        done = True
    finally:
        _passing.reset(token)
        result = paths[-1:] if done else []
        dropped(spark, *paths[: len(paths) - len(result)])
        if outside is not None:
            outside.extend(result)

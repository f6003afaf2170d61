"""Small helpers shared by the operators: reading tables, staged tables, column names."""

from __future__ import annotations

import atexit
import math
import os
import tempfile
import time
import zipfile

import panelforge
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.session import scratch_path
from panelforge.sources.hadoop_fs import delete

_staged: list[tuple[SparkSession, str]] = []


#: Rows and bytes of an Arrow batch, at most: they bound the memory of a Python worker.
ARROW_LIMITS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 2000,
    "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20,
}


def as_number(spark: SparkSession, setting: str) -> int:
    """A count or size as Spark reads it: ``2000``, ``16MB``, ``4194304b``."""
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting)


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once for each context, for their Python workers.

    Operators call it before they make a Python function (which notes the shipped files).
    """
    sc = spark.sparkContext
    for name, most in ARROW_LIMITS.items():  # workers hold a few batches at once, beside the JVM
        if as_number(spark, spark.conf.get(name)) not in range(1, most + 1):
            spark.conf.set(name, str(most))
    if getattr(sc, "_panelforge_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(panelforge.__file__))
    if os.path.isdir(root):  # else it already runs from a shipped archive
        folder = tempfile.mkdtemp(prefix="panelforge-code-")
        with zipfile.ZipFile(archive := f"{folder}/panelforge_code.zip", "w") as z:
            for at, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(at, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(archive)
    sc._panelforge_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder under the shared checkpoint folder, removed when the driver's process ends."""
    path = scratch_path(spark, label)
    _staged.append((spark, path))
    return path


#: Seconds between two times that the driver gives memory back, at least, and when it did so last.
RELEASE_SECONDS = 8
_released = [0.0]


def release(spark: SparkSession) -> None:
    """Have the driver's JVM collect what many finished jobs have left (plans, broadcasts, results): its
    heap, mostly garbage by then, shrinks, and Spark's cleaner drops broadcasts and shuffle files that
    nothing refers to. Spark asks for the same by itself only every ``spark.cleaner.periodicGC.interval``."""
    if time.monotonic() - _released[0] >= RELEASE_SECONDS:
        spark.sparkContext._jvm.System.gc()
        _released[0] = time.monotonic()


def release_executors(spark: SparkSession) -> None:
    """Have the executors' JVMs collect what finished stages have left, by a small task on every core: their
    heaps, grown by the stages before, shrink and leave room for the Python workers of the next one."""
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).select(F.java_method(F.lit("java.lang.System"), F.lit("gc"))).collect()


def staged(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs only the tasks it was running. The folder is removed
    when the driver's process ends (lazy results may read it until then).
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", compression).parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def clear_staged() -> None:
    """Delete all staged tables of this process."""
    while _staged:
        spark, path = _staged.pop()
        try:
            if spark.sparkContext._jsc is not None:
                delete(spark, path)
        except Exception:  # the session is gone; the cluster's own cleaning applies
            pass


#: Keys (one 64-bit number each) up to which a semi-join sends them to all executors.
BROADCAST_KEYS = 2_000_000


def only(df: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """Rows of ``df`` whose long column ``name`` is in ``keys`` (a staged table of distinct values).

    Up to ``BROADCAST_KEYS`` counted keys are broadcast, so that wide rows of ``df`` (texts) are
    filtered where they are read; beyond that it is an ordinary shuffled semi-join.
    """
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return df.join(keys, name, "left_semi")


def parts(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Number of partitions for ``rows``, at least the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / rows_each))

"""Session helpers: a local session for tests and benches, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "panelforge") -> SparkSession:
    """A local session with the settings the library is tested with (AQE on, UI off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting is always used when present. Only a local-mode session without the
    setting (tests, benches) gets a fresh scratch folder; on a cluster an unset value is an
    error, because a machine-local folder is not visible to the executors.
    """
    sc = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a folder shared by all executors"
            )
        root = tempfile.mkdtemp(prefix="panelforge-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the shared checkpoint root for staged tables."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def observation(label: str):
    """A new ``Observation`` with a unique name: metrics are matched to queries by name, so
    concurrent jobs (several years at once) must never share one."""
    from pyspark.sql import Observation

    return Observation(f"panelforge_{label}_{uuid.uuid4().hex[:12]}")

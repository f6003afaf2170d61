import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    ckpt = tmp_path_factory.mktemp("ckpt")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("panelforge-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(ckpt))  # tests set their own; clusters provide it
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, order=None):
    out = [r.asDict(recursive=True) for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple((r[k] is not None, r[k]) for k in order))
    return out


class jobs:
    """Counts the Spark jobs that run inside."""

    def __init__(self, spark):
        self.sc = spark.sparkContext

    def __enter__(self):
        self.sc.setJobGroup(f"count-{id(self)}", "counted")
        return self

    def __exit__(self, *_):
        self.n = len(self.sc.statusTracker().getJobIdsForGroup(f"count-{id(self)}"))
        self.sc.setLocalProperty("spark.jobGroup.id", None)

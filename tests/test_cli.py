import os

import pytest
import yaml
from pyspark.sql import functions as F

from conftest import SF_SMALL
from panelforge.cli import main, resolve_placeholders


def test_placeholders():
    conf = {"path_pattern": "${dirs.input}/${year}/*.parquet", "columns": ["a"], "n": 3}
    out = resolve_placeholders(conf, {"dirs.input": "/raw", "year": "2018"})
    assert out == {"path_pattern": "/raw/2018/*.parquet", "columns": ["a"], "n": 3}
    with pytest.raises(KeyError):
        resolve_placeholders("${nope}", {})


def test_cli_select_qc_build(spark, tmp_path):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    for y in (1996, 1997):
        o.where(F.year("o_orderdate") == y).withColumn("year", F.lit(y)).write.parquet(str(tmp_path / "raw" / str(y)))
    table_conf = {
        "name": "orders",
        "path_pattern": "${dirs.input}/${year}/*.parquet",
        "output_name": "orders_${year}",
        "output_dir": "${dirs.inter}",
        "columns": ["o_orderkey", "o_custkey", "year", "o_totalprice"],
    }
    tc = tmp_path / "orders.yaml"
    tc.write_text(yaml.safe_dump(table_conf))
    var = ["--var", f"dirs.input={tmp_path / 'raw'}", "--var", f"dirs.inter={tmp_path / 'inter'}"]
    for y in ("1996", "1997"):
        assert main(["select", "--table-config", str(tc), "--year", y, *var]) == 0
    assert main(["qc", "--table-config", str(tc), "--year", "1996", *var]) == 0
    assert os.path.exists(tmp_path / "inter" / "orders_1996.qc" / "qc.json")
    dc = tmp_path / "dataset.yaml"
    dc.write_text(yaml.safe_dump({"tables": {"orders": {
        "path_pattern": "{basepath}/orders_{year}.parquet", "year_min": 1996, "year_max": 1997,
        "output_name": "orders_{year_min}_{year_max}", "primary_key": ["o_custkey", "year"]}}}))
    assert main(["build", "--dataset-config", str(dc), "--table", "orders",
                 "--basepath", str(tmp_path / "inter"), "--output", str(tmp_path / "out")]) == 0
    built = spark.read.parquet(str(tmp_path / "out" / "orders_1996_1997_array.parquet"))
    assert built.select(F.sum(F.size("o_orderkey"))).first()[0] == o.where(F.year("o_orderdate").isin(1996, 1997)).count()

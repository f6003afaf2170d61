import pytest

from panelforge.sinks import switch
from panelforge.sinks.parquet import shard_folders, write_parquet, write_sharded, write_table
from panelforge.sources import hadoop_fs


class Crash(Exception):
    pass


def crash_after(monkeypatch, steps):
    """The given number of file-system changes succeed, the next one ends the run."""
    left = [steps]

    def limited(change):
        def run(spark, *args, **kw):
            left[0] -= 1
            if left[0] < 0:
                raise Crash
            return change(spark, *args, **kw)

        return run

    for name in ("rename", "delete", "write_text"):
        monkeypatch.setattr(hadoop_fs, name, limited(getattr(hadoop_fs, name)))


def frame(spark, text, shards=(1, 2)):
    return spark.createDataFrame([(s, text) for s in shards], "s int, v string")


def seen(spark, base):
    """What the two outputs of a sharded table hold."""
    out = {}
    for name in ("t", "t_array"):
        if shard_folders(spark, f"{base}/{name}", "s"):
            out |= {(name, r.s): r.v for r in spark.read.parquet(f"{base}/{name}").collect()}
    return out


OLD = {("t", 1): "old", ("t", 2): "old", ("t", 3): "kept"}
NEW = {("t_array", 1): "new", ("t_array", 2): "new", ("t", 3): "kept"}


@pytest.mark.parametrize("steps", range(13))
def test_shards_under_both_suffixes(spark, tmp_path, monkeypatch, steps):
    base = str(tmp_path)
    write_table(frame(spark, "kept", (3,)), base, "t", "t", shard_by="s")
    write_table(frame(spark, "old"), base, "t", "t", shard_by="s")
    with monkeypatch.context() as m:
        crash_after(m, steps)
        try:
            write_table(frame(spark, "new"), base, "t", "t", shard_by="s", aggregated=True)
        except Crash:
            pass
        else:
            assert steps >= 9
    journaled = any(n.startswith("_switch-") and n.endswith(".json") for n in hadoop_fs.list_dir(spark, base))
    assert switch.recover(spark, base) == int(journaled)
    assert seen(spark, base) == (OLD if steps < 2 else NEW)
    write_table(frame(spark, "next", (1,)), base, "t", "t", shard_by="s")  # and later writes go on from there
    assert seen(spark, base)["t", 1] == "next" and ("t_array", 1) not in seen(spark, base)


@pytest.mark.parametrize("steps", range(8))
def test_one_dataset(spark, tmp_path, monkeypatch, steps):
    path = f"{tmp_path}/d.parquet"
    write_parquet(frame(spark, "old"), path)
    with monkeypatch.context() as m:
        crash_after(m, steps)
        try:
            write_parquet(frame(spark, "new"), path)
        except Crash:
            pass
    switch.recover(spark, str(tmp_path))
    assert {r.v for r in spark.read.parquet(path).collect()} == {"old" if steps < 2 else "new"}
    assert not [n for n in hadoop_fs.list_dir(spark, str(tmp_path)) if n.startswith("_switch-") and not n.endswith(".tmp")]


def test_a_failed_job_leaves_the_old_dataset(spark, tmp_path):
    path = f"{tmp_path}/d.parquet"
    write_parquet(frame(spark, "old"), path)
    with pytest.raises(Exception):
        write_parquet(spark.range(3).selectExpr("raise_error('no') AS v"), path)
    assert {r.v for r in spark.read.parquet(path).collect()} == {"old"}


def test_recovery_of_one_place_leaves_others_alone(spark, tmp_path, monkeypatch):
    for name in ("a", "b"):
        write_parquet(frame(spark, "old"), f"{tmp_path}/{name}")
    with monkeypatch.context() as m:
        crash_after(m, 2)
        with pytest.raises(Crash):
            write_parquet(frame(spark, "new"), f"{tmp_path}/a")
    assert switch.recover(spark, str(tmp_path), f"{tmp_path}/b") == 0
    assert switch.recover(spark, str(tmp_path), f"{tmp_path}/a") == 1
    assert {r.v for r in spark.read.parquet(f"{tmp_path}/a").collect()} == {"new"}


def test_untouched_shards_keep_their_files(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_sharded(frame(spark, "a"), path, "s")
    before = hadoop_fs.list_dir(spark, f"{path}/s_shard=2")
    res = write_sharded(frame(spark, "b", (1,)), path, "s")
    assert res.shards == ["1", "2"] and hadoop_fs.list_dir(spark, f"{path}/s_shard=2") == before

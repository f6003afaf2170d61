"""Replacing datasets, shards and files so that a crash leaves one current state.

New data is written aside first (``_new-<id>/`` beside its place). Then a journal, a small JSON file
named ``_switch-<id>.json``, lists which new folder goes to which place and which old ones go; from
the moment it exists the new state is the current one. The moves follow, each a rename, then the
journal is removed. A run that dies before the journal is there has changed nothing; one that dies
later is finished by ``recover``, which every write to the same place and every multi-year read of
the library calls first. Names with ``_`` in front are invisible to Spark's readers.

Renames of a folder are one step on HDFS, local and hierarchical object stores; where a store copies
instead, a move that was cut short is begun again from the new data, which is removed last.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

from panelforge.sources import hadoop_fs

JOURNAL = "_switch-"


def parent_of(path: str) -> str:
    return path.rstrip("/").rpartition("/")[0] or "/"


def aside(base: str) -> str:
    """A new folder under ``base`` for data that is not current yet."""
    return f"{base.rstrip('/')}/_new-{uuid.uuid4().hex[:12]}"


def record(spark: SparkSession, base: str, new_root: str, moves: list[tuple[str, str]], drops: Iterable[str] = ()) -> str:
    """Make the new state the current one by its journal, whose path is returned; nothing moves yet."""
    name = f"{base.rstrip('/')}/{JOURNAL}{uuid.uuid4().hex[:12]}.json"
    hadoop_fs.write_text(spark, f"{name}.tmp", json.dumps({"new_root": new_root, "moves": moves, "drops": list(drops)}))
    hadoop_fs.rename(spark, f"{name}.tmp", name)
    return name


def switch(spark: SparkSession, base: str, new_root: str, moves: list[tuple[str, str]], drops: Iterable[str] = ()) -> None:
    """Make the ``moves`` (new path, its place) and remove ``drops``, all or nothing; ``new_root``, the
    folder that the new paths lie in, goes as well."""
    _finish(spark, record(spark, base, new_root, moves, drops))


def _finish(spark: SparkSession, journal: str) -> None:
    plan = json.loads(hadoop_fs.read_text(spark, journal))
    trash = f"{journal.removesuffix('.json').replace(JOURNAL, '_old-')}"
    for i, (new, place) in enumerate(plan["moves"]):
        if hadoop_fs.exists(spark, new):  # else it was moved before
            if hadoop_fs.exists(spark, place):
                hadoop_fs.rename(spark, place, f"{trash}/{i}-{uuid.uuid4().hex[:8]}")
            hadoop_fs.rename(spark, new, place)
    for i, old in enumerate(plan["drops"]):
        if hadoop_fs.exists(spark, old):
            hadoop_fs.rename(spark, old, f"{trash}/drop{i}")
    hadoop_fs.delete(spark, journal)
    hadoop_fs.delete(spark, trash)
    hadoop_fs.delete(spark, plan["new_root"])


def recover(spark: SparkSession, base: str, place: str | None = None) -> int:
    """Finish the switches under ``base`` that a crash has cut short; their number. With ``place`` only
    those that touch it (or something in it), so that writers of other places are left alone."""
    found = [f"{base.rstrip('/')}/{n}" for n in hadoop_fs.list_dir(spark, base) if n.startswith(JOURNAL) and n.endswith(".json")]
    if place is not None:
        inside = f"{place.rstrip('/')}/"
        touches = lambda plan: any(f"{p}/".startswith(inside) for p in [*(to for _, to in plan["moves"]), *plan["drops"]])
        found = [j for j in found if touches(json.loads(hadoop_fs.read_text(spark, j)))]
    for journal in found:
        _finish(spark, journal)
    return len(found)

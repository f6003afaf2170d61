import corpus_pipeline
from panelforge.llm import tables


class Session:
    """Counts the calls of System.gc, as a session would pass them on."""

    def __init__(self):
        self.calls = 0
        self.sparkContext = self._jvm = self.System = self

    def gc(self):
        self.calls += 1


def test_the_driver_gives_memory_back_now_and_then(monkeypatch):
    session = Session()
    monkeypatch.setattr(tables, "_released", [float("-inf")])
    for _ in range(5):
        tables.release(session)
    assert session.calls == 1
    monkeypatch.setattr(tables, "RELEASE_SECONDS", 0)
    tables.release(session)
    assert session.calls == 2


def test_staged_tables_release_the_drivers_memory(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(tables, "release", seen.append)
    assert tables.staged(spark.range(5), "release").count() == 5 and len(seen) == 1


def test_the_executors_give_memory_back(spark):
    beans = spark._jvm.java.lang.management.ManagementFactory  # of the driver, which runs the tasks here
    collections = lambda: sum(b.getCollectionCount() for b in beans.getGarbageCollectorMXBeans())
    before = collections()
    tables.release_executors(spark)
    assert collections() > before


def test_later_stages_begin_with_room(spark, no_docs, monkeypatch):
    class Begun(Exception):
        pass

    def stop(session):
        raise Begun

    monkeypatch.setattr(corpus_pipeline, "release_executors", stop)
    for _, stage in corpus_pipeline.STAGES[1:]:
        try:
            stage(spark, no_docs, "")
        except Begun:
            continue
        raise AssertionError(stage)

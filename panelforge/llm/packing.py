"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of tokens (its documents in id order). In each round, a window of
``window`` tokens, source s may send its quantum: its cumulative allowance after k rounds is
C(k) = floor(k Q), with Q = window x target share. What a round can't send as whole tokens is the
deficit that later rounds get; as the allowance is cumulative, it carries over windows and over
partitions without a running state. The token at place x of a source goes out in the round k with
C(k) <= x < C(k + 1), so a document's round and place follow from three numbers: its place in its
source's queue (a prefix sum over partitions), the source's total, and the round's start, the sum
over sources of min(total, C(k)). A source that runs dry stops; the others keep their quanta, so
their relative shares hold. The rounds form one stream of tokens, cut into sequences of exactly
``length`` tokens; only the last sequence can be shorter.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from panelforge.llm.encoding import encoder
from panelforge.llm.tables import ship, staged

#: Rounds that are listed in one row on their way to a row each.
RUN = 1024
FRACTION = 16  # bits of a quantum behind the point
#: Rows of the tables of rounds and of (source, task) up to which they are broadcast (at most 40
#: bytes and a source's name each); larger ones are joined by a shuffle.
BROADCAST_ROWS = 500_000

PIECES = "array<struct<start:bigint,length:bigint,ids_crc32:bigint,sequence_id:bigint,offset:bigint,ids:binary>>"
_PIECE = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "ids_crc32", "sequence_id", "offset")] + [("ids", pa.binary())]))


def _tokens(docs: DataFrame, path: str, end_id: int, lower: bool) -> DataFrame:
    """(part, source, doc_id, before, n, ids): each task's rows are in queue order, ``before`` counts
    the task's earlier tokens of the same source."""
    schema = pa.schema([("part", pa.int32()), ("source", pa.string()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def encode(batches):
        tool, part, sent = encoder(path, lower), TaskContext.get().partitionId(), {}
        end = np.array([end_id], np.uint32).tobytes()
        for batch in batches:
            sources, ids, before, sizes = batch.column("source").to_pylist(), [], [], []
            for source, (found,) in zip(sources, tool.texts(batch.column("text"))):
                ids.append(found.astype("<u4").tobytes() + end)
                sizes.append(len(found) + 1)
                before.append(sent.get(source, 0))
                sent[source] = before[-1] + sizes[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(ids), pa.int32()), batch.column("source"), batch.column("doc_id"), pa.array(before, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                schema=schema,
            )

    return docs.mapInArrow(encode, "part int, source string, doc_id long, before long, n long, ids binary")


def _cut_rounds(rows: DataFrame) -> DataFrame:
    """Documents cut where a round ends: (source, round, doc_id, doc_tokens, start, shift, ids)."""
    one = 1 << FRACTION
    first, last = f"((at + 1) * {one} - 1) div quantum", f"((at + n) * {one} - 1) div quantum"
    rows = rows.withColumn("round", F.explode(F.sequence(F.expr(first), F.expr(last))))
    rows = rows.withColumn("opens", F.expr(f"round * quantum div {one}"))
    rows = rows.withColumn("begin", F.greatest("at", "opens"))
    rows = rows.withColumn("stop", F.least(F.col("at") + F.col("n"), F.expr(f"(round + 1) * quantum div {one}")))
    piece = F.expr("substring(ids, int(4 * (begin - at)) + 1, int(4 * (stop - begin)))")
    return rows.select(
        "source", "round", "doc_id", F.col("n").alias("doc_tokens"), (F.col("begin") - F.col("at")).alias("start"),
        (F.col("begin") - F.col("opens")).alias("shift"), piece.alias("ids"),
    )


def _cut_sequences(length: int, with_ids: bool):
    def cut(at: pa.Array, start: pa.Array, ids: pa.Array) -> pa.Array:
        out = []
        for g, first, data in zip(at.to_pylist(), start.to_pylist(), ids.to_pylist()):
            own, x, n = [], 0, len(data) // 4
            while x < n:
                m = min(n - x, length - (g + x) % length)
                part = data[4 * x : 4 * (x + m)]
                own.append({"start": first + x, "length": m, "ids_crc32": zlib.crc32(part), "sequence_id": (g + x) // length, "offset": (g + x) % length, "ids": part if with_ids else None})
                x += m
            out.append(own)
        return pa.array(out, _PIECE)

    return arrow_udf(cut, PIECES).asNondeterministic()


def pack_mixture(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    length: int = 2048,
    window: int = 1 << 20,
    weights: dict[str, float] | None = None,
    alpha: float = 0.7,
    lower: bool = False,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens.

    One row for each piece: doc_id, start (the document's tokens before it), length, ids_crc32,
    doc_tokens, source, round, sequence_id, offset, and ``ids`` (little-endian unsigned 32 bits)
    if asked for. Every token, with ``end_id`` behind each document, lies in exactly one piece.

    Target shares: ``weights`` by source (sources not named weigh 1), else each source's tokens to
    the power ``alpha``. They hold over each window of ``window`` tokens, to a token of each source, as
    long as no source has run dry; inside a window the sources' tokens stand one after the other, so
    a single sequence mixes sources only where ``window`` is near ``length``. A small window makes
    more rounds (a row for each source and round). Null text counts as empty: the document is its end id alone. Null source
    counts as the empty source. Rows that repeat an id are packed each for itself; a null id is
    kept. An empty table gives no pieces. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("source", "doc_id", F.length("text")).sortWithinPartitions("source", "doc_id", "text")
    tokens = staged(_tokens(rows, vocabulary, end_id, lower), "packing-tokens", "zstd")

    # tables of sources and of (source, task): no larger than the numbers of sources and tasks
    runs = tokens.groupBy("source", "part").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = staged(runs.select("source", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"), "n"), "packing-runs")
    share = F.pow("total", F.lit(float(alpha)))
    if weights:
        share = F.coalesce(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])[F.col("source")].cast("double"), F.lit(1.0))
    totals = runs.groupBy("source").agg(F.sum("n").alias("total")).withColumn("weight", share)
    whole = totals.agg(F.sum("weight").alias("w"), F.count("*").alias("m")).first()
    quantum = F.greatest(F.lit(1 << FRACTION), F.floor(F.col("weight") / F.lit(whole.w or 1.0) * F.lit(float(window << FRACTION))))
    totals = staged(totals.select("source", "total", quantum.cast("long").alias("quantum")), "packing-totals")

    last = F.expr(f"(total * {1 << FRACTION} - 1) div quantum")
    rounds = totals.agg(F.max(last).alias("k")).first().k
    # rounds in runs of RUN, dealt over the tasks, so that no row holds all of them
    grid = totals.select("source", "total", "quantum", F.explode(F.sequence(F.lit(0), F.lit((rounds or 0) // RUN).cast("long"))).alias("run"))
    grid = grid.repartition("source", "run").withColumn("round", F.explode(F.expr(f"sequence(run * {RUN}, least(run * {RUN} + {RUN - 1}, {rounds or 0}L))")))
    allowed = lambda k: F.least("total", F.expr(f"({k}) * quantum div {1 << FRACTION}"))
    grid = grid.select("source", "round", allowed("round").alias("sent"), allowed("round + 1").alias("next"))
    same = Window.partitionBy("round")
    before = F.sum(F.col("next") - F.col("sent")).over(same.orderBy("source").rowsBetween(Window.unboundedPreceding, -1))
    grid = grid.select("source", "round", (F.sum("sent").over(same) + F.coalesce(before, F.lit(0))).alias("base"), (F.col("next") > F.col("sent")).alias("used"))
    grid = staged(grid.where("used").drop("used"), "packing-rounds")
    if (rounds or 0) * whole.m <= BROADCAST_ROWS:
        grid = F.broadcast(grid)

    heads = staged(runs.select("source", "part", "ahead").join(totals.select("source", "quantum"), "source"), "packing-heads")
    if heads.count() <= BROADCAST_ROWS:
        heads = F.broadcast(heads)
    placed = tokens.join(heads, ["source", "part"])
    placed = placed.select("source", "doc_id", (F.col("ahead") + F.col("before")).alias("at"), "n", "quantum", "ids")
    placed = _cut_rounds(placed).join(grid, ["source", "round"]).withColumn("at", F.col("base") + F.col("shift"))
    pieces = placed.withColumn("p", _cut_sequences(length, with_ids)("at", "start", "ids"))
    pieces = pieces.select("doc_id", "doc_tokens", "source", "round", F.explode("p").alias("p"))
    wanted = ["start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    return pieces.select("doc_id", *[f"p.{c}" for c in wanted], "doc_tokens", "source", "round")

"""Token ids in a word-aligned binary format (Simple-8b), with per-block offsets.

A block holds the ids of consecutive whole documents, about ``BLOCK_IDS`` of them. Its payload is
a run of little-endian 64-bit words. The top four bits of a word select how many ids of how many
bits the other sixty hold:

    selector   1    2    3   4   5   6   7   8   9  10  11  12  13  14  15
    ids      240  120   60  30  20  15  12  10   8   7   6   5   4   3   1
    bits       0    0    1   2   3   4   5   6   7   8  10  12  15  20  60

Selector 0 is an escape: the word's low bits are a place in the block's list of escapes, 64-bit
numbers that need more than 60 bits. (A first word of selector 1 or 2 stands for that many zeros.)
The last word of a block may hold fewer ids than its selector allows; the block's count says how
many. Next to the payload stand the part it belongs to, the ids of that part before the block, the
number of ids and of words, and for each document its id and its first id in the block, so that a
reader can decode any block by itself, without the others, all words of one selector at once.

A token file is a folder of two sets of Parquet files, written and read by Spark: ``blocks`` (part,
block, ahead, n_ids, n_words, words, escapes, doc_ids, doc_starts) and ``parts`` (part, before), the
ids of all parts before each, so that the payload is written once, before the totals are known.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from panelforge.llm.encoding import encoder
from panelforge.llm.tables import release, scratch, ship
from panelforge.sources.hadoop_fs import exists

U64 = np.uint64
#: Fixed values of the format: ids in a word, and their bits, by selector (0 is the escape).
COUNTS = np.array([1, 240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 1], np.int64)
WIDTHS = np.array([60, 0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 60], np.int64)
BLOCK_IDS = 1 << 16
LANE = 128


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id."""
    if len(ids) and ids.max() >> U64(52):
        high = ids >> U64(32)
        return np.where(high > 0, 32 + np.frexp(high.astype(float))[1], np.frexp((ids & U64(0xFFFFFFFF)).astype(float))[1]).astype(np.uint8)
    return np.frexp(ids.astype(float))[1].astype(np.uint8)


def _selectors(bits: np.ndarray, n: int) -> np.ndarray:
    """For each place of a block, the selector that takes most ids from there on. Words end where their
    lane does; only the block's last word may be short. ``bits`` has zeros behind the ``n`` ids."""
    room = np.minimum(LANE - np.arange(n) % LANE, 255).astype(np.uint8)
    room[n - (n % LANE or LANE) :] = 255  # the last lane
    out = np.zeros(n, np.int64)
    widest, reach = bits, 1  # of the ids at a place and reach - 1 behind it
    for s in range(15, 0, -1):  # from few wide ids to many narrow ones: the last that fits
        while reach < COUNTS[s]:
            step = min(reach, int(COUNTS[s]) - reach)
            widest = np.maximum(widest[:-step], widest[step:])
            reach += step
        fits = (widest[:n] <= WIDTHS[s]) & (room >= min(COUNTS[s], 255))
        if fits.any():
            out[fits] = s
        elif not (widest[:n] <= WIDTHS[s]).any():
            break
    return out


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escapes) of a block of unsigned 64-bit ids."""
    ids = np.ascontiguousarray(ids, U64)
    n = len(ids)
    if n == 0:
        return np.zeros(0, U64), np.zeros(0, U64)
    every = _selectors(np.append(_widths(ids), np.zeros(240, np.uint8)), n)
    # lanes of the block are walked side by side, one word of each a step
    at = np.arange(0, n, LANE)
    stop = np.minimum(at + LANE, n)
    heads, chosen = [], []
    while len(at):
        selector = every[at]
        heads.append(at)
        chosen.append(selector)
        at = at + COUNTS[selector]
        live = at < stop
        at, stop = at[live], stop[live]
    heads, selector = np.concatenate(heads), np.concatenate(chosen)
    order = np.argsort(heads)
    heads, selector = heads[order], selector[order]
    sizes = np.diff(np.append(heads, n))
    words = selector.astype(U64) << U64(60)
    escapes = ids[heads[selector == 0]]
    words[selector == 0] = np.arange(len(escapes), dtype=U64)
    for s in range(3, 16):
        of = np.flatnonzero(selector == s)
        for j in range(COUNTS[s] if len(of) else 0):
            has = of[sizes[of] > j]
            words[has] |= ids[heads[has] + j] << U64(WIDTHS[s] * j)
    return words, escapes


def unpack(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of a block."""
    selector = (words >> U64(60)).astype(np.int64)
    first = np.cumsum(COUNTS[selector]) - COUNTS[selector]
    out = np.zeros(int(COUNTS[selector].sum()), U64)
    low = words & U64((1 << 60) - 1)
    of = selector == 0
    out[first[of]] = escapes[low[of].astype(np.int64)]
    for s in range(3, 16):
        of = np.flatnonzero(selector == s)
        mask = U64((1 << int(WIDTHS[s])) - 1)
        for j in range(COUNTS[s]):
            out[first[of] + j] = (low[of] >> U64(WIDTHS[s] * j)) & mask
    return out[:n]


NAMES = ["part", "block", "ahead", "n_ids", "n_words", "words", "escapes", "doc_ids", "doc_starts"]
KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
DDL = "part int, block int, ahead long, n_ids long, n_words long, words binary, escapes binary, doc_ids array<long>, doc_starts array<long>"


def encode_blocks(docs: DataFrame, vocabulary: str, end_id: int, lower: bool = True, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of the texts of ``docs``(doc_id, text), in the order of ids; ``ahead`` counts the ids
    that the same task wrote before the block."""
    schema = pa.schema(list(zip(NAMES, KINDS)))
    docs = docs.repartitionByRange("doc_id", F.length("text")).sortWithinPartitions("doc_id", "text")

    def blocks(batches):
        tool, part = encoder(vocabulary, lower), TaskContext.get().partitionId()
        number, ahead, names, ids, held = 0, 0, [], [], 0

        def close():
            nonlocal number, ahead, names, ids, held
            flat = np.concatenate(ids).astype(U64)
            words, escapes = pack(flat)
            sizes = np.array([len(v) for v in ids])
            row = [part, number, ahead, len(flat), len(words), words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes(), names, (np.cumsum(sizes) - sizes).tolist()]
            number, ahead, names, ids, held = number + 1, ahead + len(flat), [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, KINDS)], schema=schema)

        for batch in batches:
            for name, (found,) in zip(batch.column("doc_id").to_pylist(), tool.texts(batch.column("text"))):
                names.append(name)
                ids.append(np.append(found, end_id))
                held += len(found) + 1
                if held >= block_ids:
                    yield close()
        if names:
            yield close()

    return docs.select("doc_id", "text").mapInArrow(blocks, DDL)


def write_token_file(docs: DataFrame, path: str, vocabulary: str, end_id: int, lower: bool = True, id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of all texts, each followed by ``end_id``, in ascending order of document id.

    Null text counts as empty (its end id alone); null ids come first; rows that repeat an id are
    written each, in the order of their texts; an empty table gives a file without blocks; other
    columns are ignored, whatever their names. Documents of any length are kept whole in a block.
    """
    spark = docs.sparkSession
    ship(spark)
    if exists(spark, path):
        raise FileExistsError(path)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    encode_blocks(rows, vocabulary, end_id, lower, block_ids).write.parquet(f"{path}/blocks")
    release(spark)
    # the number of ids before each task's first: a table of one row for each task
    runs = spark.read.schema(DDL).parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")).write.parquet(f"{path}/parts")


def read_token_file(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents of a token file: doc_id, start, n_tokens, ids_crc32 (over the ids as little-endian
    unsigned 32-bit integers), n_words of its block, and ``ids`` if asked for."""
    ship(spark)
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int64()))]))

    def decode(words: pa.Array, escapes: pa.Array, n: pa.Array, start: pa.Array, names: pa.Array, firsts: pa.Array) -> pa.Array:
        out = []
        for w, e, m, s, ids_of, at in zip(*(v.to_pylist() for v in (words, escapes, n, start, names, firsts))):
            ids = unpack(np.frombuffer(w, "<u8").astype(U64), np.frombuffer(e, "<u8").astype(U64), m)
            raw, ends = ids.astype("<u4").tobytes(), at[1:] + [m]
            out.append([{"doc_id": d, "start": s + a, "n_tokens": b - a, "ids_crc32": zlib.crc32(raw[4 * a : 4 * b]), "ids": ids[a:b].astype(np.int64) if with_ids else None} for d, a, b in zip(ids_of, at, ends)])
        return pa.array(out, kind)

    rows = arrow_udf(decode, "array<struct<doc_id:bigint,start:bigint,n_tokens:bigint,ids_crc32:bigint,ids:array<bigint>>>").asNondeterministic()
    runs = spark.read.schema("part int, before long").parquet(f"{path}/parts")
    blocks = spark.read.schema(DDL).parquet(f"{path}/blocks").join(F.broadcast(runs), "part").withColumn("start", F.col("before") + F.col("ahead"))
    docs = blocks.withColumn("d", rows("words", "escapes", "n_ids", "start", "doc_ids", "doc_starts")).select(F.explode("d").alias("d"))
    return docs.select("d.doc_id", "d.start", "d.n_tokens", "d.ids_crc32", *["d.ids"] * with_ids)


def token_file(docs: DataFrame, vocabulary: str, end_id: int, lower: bool = True) -> str:
    """Write the token file of ``docs`` in the shared checkpoint folder, where it stays until the
    driver's process ends; its path."""
    path = scratch(docs.sparkSession, "token-file")
    write_token_file(docs, path, vocabulary, end_id, lower)
    return path

"""Merkle manifest of a dataset: a postorder append log for each source, and proofs from it.

*Leaves.* A row's leaf is the SHA-256 of its fields, each ``-`` for null, else its UTF-8 byte count,
``:`` and its value. Per source the leaves ascend by id; while several nodes remain, every ``ARITY``
consecutive ones (the last run may be shorter, even one) become the SHA-256 of their lower-case hex
digests. What remains is the source's root; these, in order of the sources, give the dataset's root
in the same way.

*Log.* Leaves are numbered by one range-partitioned sort and the row counts of its partitions.
Builders own aligned blocks of ``ARITY ** levels`` (4096) leaves, so no node but a block's root
needs another block. A builder appends each node when its last child is complete (postorder); its
segment of the log is one row, at most 140 KB of digests. The blocks' roots are the next tier's leaves, until
a source has one block: three tiers hold 68 billion leaves. No group is larger than a block, however
large a source is.

*Proofs.* A node's place in the log follows from subtree sizes alone (``position``): nodes are
complete once their last leaf is, so those before it are counted level by level. Siblings are
addressed by that formula in the segment; the path above a block is the same for all its leaves and
comes from the tier above. Paths go from the top tier down, joined by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.names import quote
from panelforge.llm.tables import parts, ship, staged

ARITY = 16
#: Levels that a builder owns.
LEVELS = 3
#: Leaves of a partition of the sort.
ROWS_EACH = 200_000
#: A digest's bytes in the log and in hex, as it is hashed.
RAW, HEX = 32, 64


@dataclass
class MerkleLog:
    """``tiers``: tables of segments (``tree``, ``block``, ``inputs`` of the tree on this tier, ``nodes``
    in completion order, ``root``, and on the first tier ``rows``, the leaves' ids and changed digests).
    ``roots``: (``tree``, ``root``), one for each tree."""

    tiers: list[DataFrame]
    roots: DataFrame
    levels: int = LEVELS


def leaf_digest(fields: list[Column]) -> Column:
    """Lower-case hex SHA-256 of the fields, each with its byte count before it."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def tree_name(source: Column) -> Column:
    """A name for each source, never null, that sorts as the sources do: null first, then bytewise."""
    return F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source.cast("string")))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``at``, the row's number (from 0) in its ``tree`` by ``order``, and ``inputs``, the
    tree's rows. Sorted by ranges, so a large tree is spread over many tasks; only a line for each
    tree and partition is summed up."""
    spark = rows.sparkSession
    n = parts(spark, rows.count(), ROWS_EACH)
    spread = rows.repartitionByRange(n, "tree", *order).sortWithinPartitions("tree", *order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    spread = staged(spread.select("*", F.spark_partition_id().alias("part"), place.alias("place")), "merkle-sorted")
    runs = spread.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(own).alias("inputs"))
    return spread.join(runs, ["tree", "part"]).withColumn("at", F.col("place") + F.col("shift")).drop("part", "place", "shift")


def level_sizes(m: int, height: int) -> list[int]:
    """Nodes on each level over ``m`` leaves."""
    return [-(-m // ARITY**k) for k in range(height + 1)]


def height_of(m: int) -> int:
    """Levels above ``m`` leaves until one node remains."""
    h = 0
    while ARITY**h < m:
        h += 1
    return h


def position(level: int, index, m: int, height: int):
    """Place in the log (from 0) of node ``index`` (a number or an array) of ``level`` over ``m`` leaves.

    Its last leaf is number e. When that is appended, every level up to its own has ceil(e / 16^k)
    complete nodes, this one the last of them; the levels above it have those that were complete one
    leaf earlier."""
    e = np.minimum((np.asarray(index, np.int64) + 1) * ARITY**level, m)
    done = sum(-(-e // ARITY**k) for k in range(level + 1))
    return done + sum((e - 1) // ARITY**k for k in range(level + 1, height + 1)) - 1


def own_height(inputs: int, levels: int) -> int:
    """Levels that a builder adds to its block in a tree (on one tier of it) of ``inputs`` leaves."""
    return min(height_of(inputs), levels)


def append_nodes(leaves: bytes, height: int) -> tuple[bytes, bytes]:
    """(all nodes in completion order, the root) over the raw digests ``leaves``."""
    m = len(leaves) // RAW
    sizes = level_sizes(m, height)
    nodes = np.empty((sum(sizes), RAW), np.uint8)
    raw = leaves
    for level, size in enumerate(sizes):
        nodes[position(level, np.arange(size), m, height)] = np.frombuffer(raw, np.uint8).reshape(size, RAW)
        if level < height:
            text, run = raw.hex().encode(), ARITY * HEX
            raw = b"".join(sha256(text[i : i + run]).digest() for i in range(0, len(text), run))
    return nodes.tobytes(), raw


def read_levels(nodes: bytes, m: int, height: int) -> list[bytes]:
    """The hex digests of each level, found in the log by their positions."""
    table = np.frombuffer(nodes, np.uint8).reshape(-1, RAW)
    return [table[position(level, np.arange(size), m, height)].tobytes().hex().encode() for level, size in enumerate(level_sizes(m, height))]


def build_log(leaves: DataFrame, levels: int = LEVELS) -> MerkleLog:
    """``leaves``: ``tree``, ``at``, ``inputs`` (see ``numbered``), ``digest`` (binary) and ``row`` (any
    struct, kept in the first tier's segments)."""
    spark = leaves.sparkSession
    ship(spark)
    block, tiers, done, rows = ARITY**levels, [], [], leaves
    while True:
        items = F.sort_array(F.collect_list(F.struct("at", "digest", "row"))).alias("items")
        blocks = rows.groupBy("tree", F.expr(f"at div {block}").alias("block"), "inputs").agg(items)
        blocks = blocks.select("tree", "block", "inputs", F.col("items.digest").alias("digests"), F.col("items.row").alias("rows"))

        def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                nodes, roots = [], []
                for digests, inputs in zip(batch.column("digests"), batch.column("inputs").to_pylist()):
                    own = b"".join(digests.as_py())
                    made, root = append_nodes(own, own_height(inputs, levels))
                    nodes.append(made)
                    roots.append(root)
                keep = [batch.column(c) for c in ("tree", "block", "inputs", "rows")]
                yield pa.RecordBatch.from_arrays([*keep, pa.array(nodes, pa.binary()), pa.array(roots, pa.binary())], ["tree", "block", "inputs", "rows", "nodes", "root"])

        schema = blocks.select("tree", "block", "inputs", "rows", F.lit(b"").alias("nodes"), F.lit(b"").alias("root")).schema
        segments = staged(blocks.mapInArrow(grow, schema), f"merkle-tier{len(tiers)}")
        tiers.append(segments)
        done.append(segments.where(F.col("inputs") <= block).select("tree", "root"))
        over = segments.where(F.col("inputs") > block)
        if over.isEmpty():
            return MerkleLog(tiers, reduce(DataFrame.union, done), levels)
        rows = over.select("tree", F.col("block").alias("at"), F.expr(f"(inputs + {block - 1}) div {block}").alias("inputs"), F.col("root").alias("digest"), F.lit(None).cast("struct<none:boolean>").alias("row"))


PATH = "array<struct<left:binary,right:binary>>"


def _sides(level: bytes, index: int) -> tuple[bytes, bytes]:
    """Hex digests of a node's siblings, before and behind it."""
    run = ARITY * HEX
    at = index * HEX
    begin = at - at % run
    return level[begin:at], level[at + HEX : begin + run]


def _paths_above(levels: list[bytes], index: int, above: list[tuple[bytes, bytes]]) -> list[tuple[bytes, bytes]]:
    """The siblings of node ``index`` of ``levels[0]``, level by level, then the path ``above``."""
    own = []
    for level in levels[:-1]:
        own.append(_sides(level, index))
        index //= ARITY
    return own + above


def _opened(segments: DataFrame, above: DataFrame, each, schema, levels: int) -> DataFrame:
    """``each(levels, path above, segment)`` -> record batch, over all segments with their ``path``.
    ``above``: (``tree``, ``block``, ``path``, ``subroot``, ``top``)."""
    joined, block = segments.join(above, ["tree", "block"]), ARITY**levels

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("tree", "block", "inputs", "nodes", "path", "subroot", "top")}
                m = min(block, row["inputs"] - row["block"] * block)
                found = read_levels(row["nodes"], m, own_height(row["inputs"], levels))
                path = [(p["left"], p["right"]) for p in row["path"]]
                yield from each(found, path, row, batch.column("rows")[i].values)

    return joined.mapInArrow(walk, schema)


def _block_paths(log: MerkleLog, tops: DataFrame) -> DataFrame:
    """(tree, block, path, subroot, top) of the first tier's blocks. ``tops``: the same for whole trees,
    without ``block``: the path from a tree's root upwards."""
    schema, size = f"tree string, block bigint, path {PATH}, subroot binary, top binary", ARITY**log.levels

    def split(levels, path, row, _):
        n = len(levels[0]) // HEX
        found = [[{"left": a, "right": b} for a, b in _paths_above(levels, i, path)] for i in range(n)]
        at = row["block"] * size
        columns = [pa.array([row["tree"]] * n, pa.string()), pa.array(range(at, at + n), pa.int64()), pa.array(found, pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())])))]
        columns += [pa.array([row[c]] * n, pa.binary()) for c in ("subroot", "top")]
        yield pa.RecordBatch.from_arrays(columns, ["tree", "block", "path", "subroot", "top"])

    lone = tops.withColumn("block", F.lit(0).cast("long"))
    below = None
    for tier, segments in reversed(list(enumerate(log.tiers))):
        whole = segments.where(F.col("inputs") <= size).select("tree").join(lone, "tree")
        here = whole.select("tree", "block", "path", "subroot", "top")
        here = here if below is None else here.unionByName(below)
        if tier == 0:
            return here
        below = staged(_opened(segments, here, split, schema, log.levels), f"merkle-paths{tier}")


@dataclass
class Manifest:
    """``log``: the sources' trees; ``top``: the tree over the sources' roots; ``paths``: for each first
    block its path to the dataset's root."""

    log: MerkleLog
    top: MerkleLog
    paths: DataFrame


def build_manifest(docs: DataFrame, fields: list[str], id_col: str = "doc_id", source_col: str = "source", changed: Column | None = None, levels: int = LEVELS) -> Manifest:
    """The logs of all rows of ``docs`` over the columns ``fields``. ``changed``: the hex digest of a
    changed leaf, for an audit, null where the leaf is as it was. Null ids come first; rows with one
    id are ordered by their digest, so repeated rows have the same trees in any order. A null source
    is a source of its own, the first. Empty table: no trees, and no rows in any result."""
    ship(docs.sparkSession)
    col = lambda c: F.col(quote(c))
    narrow = staged(
        docs.select(
            tree_name(col(source_col)).alias("tree"),
            F.unhex(leaf_digest([col(c) for c in fields])).alias("digest"),
            F.struct(col(id_col).alias("id"), F.unhex(F.lit(None).cast("string") if changed is None else changed).alias("changed")).alias("row"),
            F.monotonically_increasing_id().alias("tie"),
        ),
        "merkle-leaves",
    )
    log = build_log(numbered(narrow.withColumn("id", F.col("row.id")), ["id", "digest", "tie"]), levels)
    subroots = log.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"), F.struct("tree").alias("row"))
    top = build_log(numbered(subroots, ["name"]), levels)
    root = top.roots.select("tree", F.array().cast(PATH).alias("path"), F.lit(None).cast("binary").alias("subroot"), F.col("root").alias("top"))
    schema = f"tree string, path {PATH}, subroot binary, top binary"

    def split(levels, path, row, rows):
        names = rows.field("tree").to_pylist()
        found = [[{"left": a, "right": b} for a, b in _paths_above(levels, i, path)] for i in range(len(names))]
        raw = bytes.fromhex(levels[0].decode())
        columns = [pa.array(names, pa.string()), pa.array(found, pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())])))]
        columns += [pa.array([raw[i : i + RAW] for i in range(0, len(raw), RAW)], pa.binary()), pa.array([row["top"]] * len(names), pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["tree", "path", "subroot", "top"])

    tops = staged(_opened(top.tiers[0], _block_paths(top, root), split, schema, levels), "merkle-tops")
    return Manifest(log, top, _block_paths(log, tops))


def _per_leaf(manifest: Manifest, each, columns: str) -> DataFrame:
    segments = manifest.log.tiers[0]
    id_type = segments.schema["rows"].dataType.elementType["id"].dataType.simpleString()
    return _opened(segments, manifest.paths, each, f"id {id_type}, {columns}", manifest.log.levels)


def proofs(manifest: Manifest) -> DataFrame:
    """For each leaf: ``id``, ``leaf`` and ``path``, its siblings' hex digests (before and behind it) from
    its run upwards to the dataset's root. ``left + digest + right``, hashed level by level, gives ``root``."""

    def each(levels, above, row, rows):
        n = len(rows)
        found = [[{"left": a, "right": b} for a, b in _paths_above(levels, i, above)] for i in range(n)]
        leaf = [levels[0][i * HEX : (i + 1) * HEX].decode() for i in range(n)]
        paths = pa.array(found, pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())])))
        yield pa.RecordBatch.from_arrays([rows.field("id"), pa.array(leaf), paths, pa.array([row["top"].hex()] * n)], ["id", "leaf", "path", "root"])

    return _per_leaf(manifest, each, f"leaf string, path {PATH}, root string")


def audit(manifest: Manifest) -> DataFrame:
    """For each leaf: ``id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (the hash of the path's
    digests, level by level, left to right), ``folded_root``, recomputed from the leaf, or the changed
    one where there is one, and its siblings, and ``verified``, whether it equals ``root``."""

    def each(levels, above, row, rows):
        ids, changed = rows.field("id"), rows.field("changed").to_pylist()
        proof, folded, steps, tail, known = [], [], above, b"", {}
        base = levels[0]
        for i, other in enumerate(changed):
            leaf = base[i * HEX : (i + 1) * HEX] if other is None else other.hex().encode()
            if i % ARITY == 0 and len(levels) > 1:  # what is above the run is the same for all its leaves
                steps, known = _paths_above(levels[1:], i // ARITY, above), {}
            if i % ARITY == 0:
                tail = b"".join(a + b for a, b in steps)
            left, right = _sides(base, i) if len(levels) > 1 else (b"", b"")
            proof.append(sha256(left + right + tail).hexdigest())
            first = sha256(left + leaf + right).hexdigest().encode() if len(levels) > 1 else leaf
            if first not in known:
                node = first
                for a, b in steps:
                    node = sha256(a + node + b).hexdigest().encode()
                known[first] = node.decode()
            folded.append(known[first])
        n = len(changed)
        leaves = [base[i * HEX : (i + 1) * HEX].decode() for i in range(n)]
        same = [pa.array([row[c].hex()] * n) for c in ("subroot", "top")]
        yield pa.RecordBatch.from_arrays([ids, pa.array(leaves), *same, pa.array(proof), pa.array(folded), pa.array([f == row["top"].hex() for f in folded])], ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return _per_leaf(manifest, each, "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def log_nodes(log: MerkleLog) -> DataFrame:
    """The logs' nodes: ``tree``, ``position``, ``level``, ``digest`` (hex); sorted by position they stand in
    the order in which they were completed."""
    levels = log.levels
    sizes = log.tiers[0].groupBy("tree").agg(F.max("inputs").alias("leaves"))
    out = []
    for tier, segments in enumerate(log.tiers):

        def walk(batches: Iterator[pa.RecordBatch], tier: int = tier) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    m = min(ARITY**levels, row["inputs"] - row["block"] * ARITY**levels)
                    for level, text in enumerate(read_levels(row["nodes"], m, own_height(row["inputs"], levels))):
                        if tier and not level:
                            continue  # the lower tier's roots
                        n, up = len(text) // HEX, tier * levels + level
                        index = np.arange(n) + row["block"] * ARITY ** (levels - level)
                        at = position(up, index, row["leaves"], height_of(row["leaves"]))
                        digests = [text[i * HEX : (i + 1) * HEX].decode() for i in range(n)]
                        yield pa.RecordBatch.from_arrays([pa.array([row["tree"]] * n), pa.array(at), pa.array([up] * n, pa.int32()), pa.array(digests)], ["tree", "position", "level", "digest"])

        narrow = segments.select("tree", "block", "inputs", "nodes").join(sizes, "tree")
        out.append(narrow.mapInArrow(walk, "tree string, position bigint, level int, digest string"))
    return reduce(DataFrame.union, out)

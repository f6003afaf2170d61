"""Near-duplicate vectors by sorted projection passes.

Each pass orders all vectors by label and then lexicographically by the concatenated signs of
random projections, so that similar vectors come to stand near each other. Neighbours within a
bounded window are compared (exact cosines of a whole block at once), and the links found are
united over passes into components. Direct links are then counted exactly inside each component,
in blocks of bounded size. Equal vectors form one class first.

The projections are of the vectors less their label's mean, and the number of passes follows the
label (``turns``): its vectors, and how much of them the mean takes up, give the chance that one
pass brings a pair at the threshold into the window. A label that would need so many passes that
they compare more than all its pairs has all its pairs compared.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from panelforge.llm.components import connected_components
from panelforge.llm.tables import parts, ship, staged

PASSES = 8
WINDOW = 256
BLOCK = 1024
#: Share of the pairs just at the threshold that the passes are to find in each label.
RECALL = 0.996
#: Bytes of the labels' means up to which they are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 64 << 20


def _unit(vectors: pa.Array) -> pa.Array:
    """Unit vectors in double precision as bytes; null for vectors that link with nothing."""
    out = []
    for v in vectors.to_pylist():
        x = None if v is None or None in v else np.array(v, np.float64)
        if x is None or not len(x) or not np.isfinite(x).all() or not x.any():
            out.append(None)
        else:
            x = x / np.abs(x).max()
            out.append((x / np.sqrt((x * x).sum())).astype("<f8").tobytes())
    return pa.array(out, pa.binary())


def turns(n: int, shared: float, threshold: float, passes: int = PASSES, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes over a label of ``n`` vectors whose mean has the squared length ``shared``; 0 stands
    for all pairs.

    Signs of one projection agree with chance 1 - angle / pi, and a pair comes into the window if
    it agrees in the first log2(n / window) of them. Without the mean, a pair at ``threshold`` has
    the cosine 1 - (1 - threshold) / (1 - shared). At least ``passes``, but one where the window
    holds the whole label.
    """
    if n <= window + 1:
        return 1
    cosine = 1 - (1 - threshold) / max(1 - shared, 1e-12)
    agree = 1 - math.acos(min(1.0, max(-1.0, cosine))) / math.pi
    chance = agree ** math.log2(n / window)
    needed = passes if chance >= recall else math.inf if chance < 1e-12 else math.log1p(-recall) / math.log1p(-chance)
    if needed > passes and 2 * window * needed >= n:
        return 0
    return max(passes, math.ceil(needed))


def _labels(classes: DataFrame, plan) -> DataFrame:
    """(label, size, mean, n, turns) of the labels (for each length of vectors) that need more than one pass."""
    schema = pa.schema([("label", pa.int64()), ("size", pa.int32()), ("n", pa.int64()), ("total", pa.binary())])

    def rows(sums: dict) -> pa.RecordBatch:
        columns = [k[0] for k in sums], [k[1] for k in sums], [v[0] for v in sums.values()], [v[1].tobytes() for v in sums.values()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    def add(batches):
        sums, held = {}, 0
        for batch in batches:
            for label, unit in zip(batch.column("label").to_pylist(), batch.column("unit").to_pylist()):
                x = np.frombuffer(unit, "<f8")
                own = sums.get((label, len(x)))
                if own is None:
                    own = sums[label, len(x)] = [0, np.zeros(len(x))]
                    held += len(unit)
                own[0] += 1
                own[1] += x
            if held > 8 << 20:
                yield rows(sums)
                sums, held = {}, 0
        if sums:
            yield rows(sums)

    kind = pa.schema([("label", pa.int64()), ("size", pa.int32()), ("mean", pa.binary()), ("n", pa.int64()), ("turns", pa.int32())])

    def finish(group):
        n = sum(group.column("n").to_pylist())
        mean = sum(np.frombuffer(t, "<f8") for t in group.column("total").to_pylist()) / n
        own = plan(n, float(mean @ mean))
        return pa.table([pa.array([v], t) for v, t in zip((group["label"][0].as_py(), len(mean), mean.tobytes(), n, own), kind.types)], schema=kind)

    partial = classes.select("label", "unit").mapInArrow(add, "label long, size int, n long, total binary")
    found = partial.groupBy("label", "size").applyInArrow(lambda group: finish(group), "label long, size int, mean binary, n long, turns int")
    return found.where("turns <> 1")


def _signs():
    """For each vector, one 64-bit key a pass: the signs of 64 projections of it less its label's
    mean (if given), as sortable integers."""
    planes = {}

    def plane(size: int, turn: int) -> np.ndarray:
        if (size, turn) not in planes:
            if len(planes) * size > 1 << 16:  # at most 32 MB
                planes.clear()
            planes[size, turn] = np.random.default_rng([size, turn]).standard_normal((size, 64))
        return planes[size, turn]

    def signs(units: pa.Array, means: pa.Array, passes: pa.Array) -> pa.Array:
        x = [np.frombuffer(u, "<f8") if m is None else np.frombuffer(u, "<f8") - np.frombuffer(m, "<f8") for u, m in zip(units.to_pylist(), means.to_pylist())]
        passes = np.array(passes.to_pylist(), np.int64)
        size = np.array([len(v) for v in x], np.int64)
        keys = [np.zeros(n, np.int64) for n in passes]
        weights = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
        for d in np.unique(size):
            at = np.flatnonzero(size == d)
            own = np.stack([x[i] for i in at])
            for turn in range(passes[at].max()):
                some = np.flatnonzero(passes[at] > turn)
                bits = own[some] @ plane(int(d), turn) > 0
                for i, key in zip(at[some], (bits * weights).sum(axis=1, dtype=np.uint64).view(np.int64)):
                    keys[i][turn] = key
        return pa.array(keys, pa.list_(pa.int64()))

    return arrow_udf(signs, "array<bigint>").asNondeterministic()


def _cosines(units: list[bytes], others: list[bytes] | None = None) -> np.ndarray:
    """Cosines of all pairs; vectors of unequal size get -2."""
    rows = [np.frombuffer(u, "<f8") for u in units]
    columns = rows if others is None else [np.frombuffer(u, "<f8") for u in others]
    a, b = (np.array([len(v) for v in side]) for side in (rows, columns))
    out = np.full((len(rows), len(columns)), -2.0)
    for size in set(a.tolist()) & set(b.tolist()):
        i, j = np.flatnonzero(a == size), np.flatnonzero(b == size)
        out[np.ix_(i, j)] = np.stack([rows[k] for k in i]) @ np.stack([columns[k] for k in j]).T
    return out


def _place(rows: DataFrame) -> DataFrame:
    """Rows in order with their task and place in it."""
    fields = [("turn", pa.int32()), ("label", pa.int64()), ("rep", pa.int64()), ("unit", pa.binary()), ("part", pa.int32()), ("pos", pa.int64())]
    schema = pa.schema(fields)

    def number(batches):
        part, seen = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.num_rows
            columns = [b.column(c) for c in ("turn", "label", "rep", "unit")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([part] * n, pa.int32()), pa.array(range(seen, seen + n), pa.int64())], schema=schema)
            seen += n

    order = ["turn", "label", F.length("unit"), "key", "rep"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.select("turn", "label", "rep", "unit").mapInArrow(number, "turn int, label long, rep long, unit binary, part int, pos long")


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    passes: int = PASSES,
    window: int = WINDOW,
    block: int = BLOCK,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    recall: float = RECALL,
) -> DataFrame:
    """(id, n_links, component_id, kept), one row for each vector.

    Vectors link when their labels are equal and not null and their cosine, in double precision,
    is at least ``threshold``; ``n_links`` counts the other vectors of the component that link
    directly (copies included), ``component_id`` is the smallest id reachable by links found, and
    ``kept`` says whether that is the vector itself. ``passes`` are made at least, more where a label
    needs them for ``recall`` (see ``turns``).

    Null, empty and zero vectors, and those with null or non-finite parts, link with nothing;
    vectors of unequal length don't link. Rows that repeat an id count as vectors of their own
    and share its components; a null id gets a null component, is not kept and has no links. An
    empty table gives an empty table; other columns are ignored, whatever their names.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), arrow_udf(_unit, "binary").asNondeterministic()(F.col(vector_col)).alias("unit"))
    rows = staged(rows, "vectors")
    usable = rows.where("unit is not null and label is not null and id is not null")
    classes = staged(usable.groupBy("label", "unit").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "vector-classes")
    labels = staged(_labels(classes, lambda n, shared: turns(n, shared, threshold, passes, window, recall)), "vector-labels")
    about = labels.agg(F.sum(F.length("mean")).alias("held"), F.min("turns").alias("least")).first()
    sized = classes.select("label", "rep", "unit", F.expr("int(length(unit) div 8)").alias("size"))
    sized = sized.join(F.broadcast(labels) if (about.held or 0) <= BROADCAST_BYTES else labels, ["label", "size"], "left")
    passing = sized.withColumn("turns", F.coalesce("turns", F.lit(1))).where("turns > 0")
    keyed = passing.select("label", "rep", "unit", F.posexplode(_signs()("unit", "mean", "turns")).alias("turn", "signed"))
    keyed = keyed.withColumn("key", F.col("signed").bitwiseXOR(F.lit(-(2**63))))  # unsigned order
    placed = staged(_place(keyed.select("turn", "label", "key", "rep", "unit")), "vector-order")
    runs = placed.groupBy("part").agg(F.count("*").alias("n"))  # a row for each task
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = placed.join(F.broadcast(runs), "part").withColumn("place", F.col("before") + F.col("pos"))
    own = F.expr(f"place div {block}")
    tail = F.expr(f"place % {block} >= {block - window}")
    placed = placed.select("turn", "label", "rep", "unit", "place", F.explode(F.when(tail, F.array(own, own + 1)).otherwise(F.array(own))).alias("block"))
    none = F.lit(0).cast("long")
    placed = placed.select("*", none.alias("home"), none.alias("length"), none.alias("i"), none.alias("j"))
    if about.least == 0:  # all pairs of some labels: each pair of their blocks is a group, at the same place
        every = sized.where("turns = 0").withColumn("blocks", F.expr(f"(n + {block - 1}) div {block}"))
        every = every.withColumn("i", F.pmod(F.xxhash64("rep"), F.col("blocks"))).withColumn("j", F.explode(F.expr("sequence(0L, blocks - 1)")))
        every = every.select(
            F.lit(0).alias("turn"), "label", "rep", "unit", none.alias("place"), F.lit(-1).cast("long").alias("block"),
            F.col("label").alias("home"), F.col("size").cast("long").alias("length"), F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"),
        )
        placed = placed.unionByName(every)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(key, group):
        order = np.argsort(group.column("place").to_numpy())
        place, label, turn, rep = (group.column(c).to_numpy()[order] for c in ("place", "label", "turn", "rep"))
        units = group.column("unit").to_pylist()
        near = _cosines([units[i] for i in order]) >= threshold
        near &= (label[:, None] == label) & (turn[:, None] == turn) & (np.abs(place[:, None] - place) <= window)
        np.fill_diagonal(near, False)
        # a spanning forest of the block's links is enough: direct links are counted later
        seen, a, b = np.zeros(len(rep), bool), [], []
        for root in np.flatnonzero(near.any(axis=1)):
            if seen[root]:
                continue
            seen[root], todo = True, [root]
            while todo:
                x = todo.pop()
                new = np.flatnonzero(near[x] & ~seen)
                seen[new] = True
                todo += new.tolist()
                a += [rep[x]] * len(new)
                b += rep[new].tolist()
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

    links = placed.groupBy("block", "home", "length", "i", "j").applyInArrow(lambda key, group: compare(key, group), "a long, b long").distinct()
    found = connected_components(links).select(F.col("id").alias("rep"), F.col("component").alias("component_id"))
    counted = _count_links(classes.join(found, "rep"), threshold, block)
    classes = classes.join(found, "rep", "left").join(counted, ["label", "rep", "component_id"], "left")
    known = classes.select("label", "unit", F.coalesce("component_id", "rep").alias("component_id"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.join(known, ["label", "unit"], "left")
    has = F.col("id").isNotNull()
    component = F.when(has, F.coalesce("component_id", "id"))
    return out.select(
        F.col("id").alias(id_col),
        F.when(has, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )


def _count_links(members: DataFrame, threshold: float, block: int) -> DataFrame:
    """(label, rep, component_id, linked): the other vectors of its component that each class links with.

    Small components share a task; a large one is dealt into blocks, and each pair of blocks is
    one task, so no task holds more than two blocks. No pairs are written.
    """
    sizes = members.groupBy("component_id").agg(F.count("*").alias("m"))
    members = staged(members.join(sizes, "component_id"), "vector-members")
    total = members.count()
    tasks = parts(members.sparkSession, total, block)
    blocks = F.ceil(F.col("m") / block)
    deal = F.pmod(F.xxhash64("rep"), blocks)
    every = F.sequence(F.lit(0).cast("long"), blocks - 1)
    small = members.where(F.col("m") <= block).select("component_id", "label", "rep", "unit", "copies", F.pmod(F.xxhash64("component_id"), F.lit(tasks)).alias("c"), F.lit(-1).cast("long").alias("i"), F.lit(-1).cast("long").alias("j"), F.lit(True).alias("left"))
    large = members.where(F.col("m") > block).withColumn("own", deal)
    held = ["component_id", "label", "rep", "unit", "copies", F.col("component_id").alias("c")]
    left = large.select(*held, F.col("own").alias("i"), F.explode(every).alias("j"), F.lit(True).alias("left"))
    right = large.select(*held, F.explode(every).alias("i"), F.col("own").alias("j"), F.lit(False).alias("left"))
    schema = pa.schema([("label", pa.int64()), ("rep", pa.int64()), ("component_id", pa.int64()), ("linked", pa.int64())])

    def count(key, group):
        comp, label, rep, copies = (group.column(c).to_numpy() for c in ("component_id", "label", "rep", "copies"))
        units, side = group.column("unit").to_pylist(), np.array(group.column("left").to_pylist(), bool)
        out = []
        order = np.argsort(comp, kind="stable")
        cuts = np.append(np.flatnonzero(np.diff(comp[order], prepend=comp[order[0]] - 1)), len(order)) if len(order) else [0]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            at = order[lo:hi]
            a = at[side[at]]
            b = a if key[1].as_py() < 0 else at[~side[at]]
            if not len(a) or not len(b):
                continue
            near = (_cosines([units[k] for k in a], [units[k] for k in b]) >= threshold) & (label[a][:, None] == label[b])
            near &= rep[a][:, None] != rep[b]
            out.append((a, (near * copies[b]).sum(axis=1)))
        a = np.concatenate([x for x, _ in out]) if out else np.zeros(0, np.int64)
        n = np.concatenate([x for _, x in out]) if out else np.zeros(0, np.int64)
        return pa.table([pa.array(label[a]), pa.array(rep[a]), pa.array(comp[a]), pa.array(n.astype(np.int64))], schema=schema)

    counts = small.unionByName(left).unionByName(right).groupBy("c", "i", "j")
    counts = counts.applyInArrow(lambda key, group: count(key, group), "label long, rep long, component_id long, linked long")
    return counts.groupBy("label", "rep", "component_id").agg(F.sum("linked").alias("linked"))

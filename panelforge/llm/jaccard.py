"""Exact Jaccard similarity join of texts on word shingles, in a metric space of pivots.

The space is that of shingle sets under the Jaccard distance d = 1 - J; a link is d <= r = 1 - t.
Documents as root pivots can't part such a space (nearly all documents lie at distance 1 from any
document, so a window of 2r holds everything). The root pivots are therefore the one-shingle sets
{s}: d(x, {s}) = 1 - 1/|x| when s is in x, else 1.

* Region: x lies equally near to all its own shingles' pivots; ties go by a fixed order of pivots
  (a hash; very common shingles last), so its cell is that of its first shingle.
* Window: |x - y| <= r|x| for any partner y, hence a partner holds at least one of x's first
  floor(r|x|) + 1 shingles, and x is copied to the regions of these pivots (and of a margin more,
  which is always allowed). Every linked pair meets in at least one region.
* Recursion inside regions: first every region measures its documents against one document
  pivot; a document within r is linked. Documents of one component need not meet again and a
  region whose documents are all in one component is closed, so groups of near copies shrink to
  their main component and a few outliers, and never give all pairs.
* Regions that stay open and hold more than ``SMALL`` documents are joined into clusters; there
  each outlier is measured against all documents, in blocks of bounded size, one task a pair of
  blocks, without writing pairs. In smaller open regions all pairs of different components are
  measured. After that no region is open: the result is exact.
* Shingles whose region still holds more than ``wide`` components after the first round (passages
  that many otherwise different documents share) go to the end of the pivot order. Documents
  whose margin this uses up are entered with all their shingles.

Candidates are first held against a sound bound on the intersection (from the stored first
shingles), then verified on the full sets. Exact copies (equal sets) form one class first.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from panelforge.llm.components import connected_components
from panelforge.llm.textops import U64, mix, shingle_sets, tidy
from panelforge.llm.tables import only, parts, ship, staged

#: Documents of an open region up to which all pairs of its components are measured at once.
SMALL = 32
#: Documents in one block of a cluster.
BLOCK = 512
#: Components left in a region after round one from which its shingle goes last in the order.
WIDE = 32
#: Rows of shingles that one regional task holds.
REGION_ROWS = 250_000


def window_size(n, t: Fraction):
    """floor((1 - t) n) + 1: first shingles of which any partner must hold one."""
    return n * (t.denominator - t.numerator) // t.denominator + 1


def entry_size(n, t: Fraction):
    """Shingles entered at first: the window and a margin for very common ones."""
    return n * (t.denominator - t.numerator) * 3 // (2 * t.denominator) + 16


def _enough(inter, union, t: Fraction) -> Column:
    return inter * F.lit(t.denominator) >= union * F.lit(t.numerator)


def _signature_udf(k: int, t: Fraction | None):
    """Set size, two hashes of the set, and its first shingles (all of them without ``t``)."""
    kind = pa.struct([("n", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("entry", pa.binary())])

    def signature(texts: pa.Array) -> pa.Array:
        out = []
        for s in shingle_sets(texts, k):
            n = len(s)
            c1 = np.bitwise_xor.reduce(mix(s)) if n else U64(0)
            c2 = mix(s ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64)
            first = s[: entry_size(n, t)] if t else s
            out.append((n, int(c1.view(np.int64)), int(c2.view(np.int64)), first.tobytes()))
        columns = zip(*out) if out else ((), (), (), ())
        tidy("powers")
        return pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(columns, kind)], fields=list(kind))

    return arrow_udf(signature, "struct<n:bigint,c1:bigint,c2:bigint,entry:binary>").asNondeterministic()


def _signed(texts: DataFrame, k: int, t: Fraction | None) -> DataFrame:
    """(doc, n, c1, c2, entry): ``n``, ``c1`` and ``c2`` tell shingle sets apart."""
    return texts.select("doc", _signature_udf(k, t)("text").alias("s")).select("doc", "s.*")


def _full_sets(texts: DataFrame, entries: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(rep, entry) with all shingles, for the ``wanted``(rep), read again from the texts."""
    docs = staged(only(entries.select("rep", "doc", "n", "c1", "c2"), wanted, "rep"), "jaccard-docs")
    full = _signed(only(texts, docs.select("doc").distinct(), "doc"), k, None)
    return full.join(docs, ["doc", "n", "c1", "c2"]).select("rep", "entry").dropDuplicates(["rep"])


_AS_LONGS = "array<bigint>"


def _longs(v: pa.Array) -> pa.Array:
    return pa.array([np.frombuffer(x, np.int64) for x in v.to_pylist()], pa.list_(pa.int64()))


def _steps(values: np.ndarray) -> bytes:
    """Differences of neighbours, which compress well, as bytes."""
    return np.diff(values, prepend=np.int64(0)).tobytes()


def _from_steps(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, np.int64))


def _enter(rows: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """(rep, entry) -> blocks (bucket, shingles, reps), one for each bucket of an Arrow batch.

    Shingles in ``hot`` need no search for partners; their rows go out in blocks of their own
    (negative buckets) that no task has to hold together.
    """
    schema = pa.schema([("bucket", pa.int64()), ("h", pa.binary()), ("rep", pa.binary()), ("pos", pa.binary())])

    def blocks(batches):
        for batch in batches:
            tidy("powers")  # of the batch before
            entry = batch.column("entry").to_pylist()
            sizes = np.array([len(v) // 8 for v in entry], np.int64)
            h = np.frombuffer(b"".join(entry), U64)
            rep = np.repeat(batch.column("rep").to_numpy(), sizes)  # ascending as rows were numbered
            pos = (np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
            is_hot = np.isin(h, hot) if len(hot) else np.zeros(len(h), bool)
            spread = (rep.astype(U64) % U64(buckets)).astype(np.int64)
            bucket = np.where(is_hot, -1 - spread, (h % U64(buckets)).astype(np.int64))
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-(2**62)))
            ends = np.append(cuts[1:], len(order))
            h, rep, pos = h[order], rep[order], pos[order]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[order][cuts]),
                    pa.array([h[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                    pa.array([_steps(rep[a:b]) for a, b in zip(cuts, ends)], pa.binary()),
                    pa.array([pos[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                ],
                schema=schema,
            )

    return rows.mapInArrow(blocks, "bucket long, h binary, rep binary, pos binary")


def _shared(blocks: DataFrame) -> DataFrame:
    """(h, rep, pos) for every shingle that at least two entered documents hold.

    ``pos`` is the shingle's place among the document's shingles in the order of hashes.
    """
    schema = pa.schema([("h", pa.int64()), ("rep", pa.int64()), ("pos", pa.int32())])

    def meet(key, group):
        h = np.frombuffer(b"".join(group.column("h").to_pylist()), U64)
        rep = np.concatenate([_from_steps(v) for v in group.column("rep").to_pylist()])
        pos = np.frombuffer(b"".join(group.column("pos").to_pylist()), np.int32)
        if key[0].as_py() >= 0:
            order = np.argsort(h)
            h, rep, pos = h[order], rep[order], pos[order]
            same = h[1:] == h[:-1]
            keep = np.zeros(len(h), bool)
            keep[1:] = same
            keep[:-1] |= same
            h, rep, pos = h[keep], rep[keep], pos[keep]
        tidy("powers")
        return pa.table([pa.array(h.view(np.int64)), pa.array(rep), pa.array(pos)], schema=schema)

    return blocks.groupBy("bucket").applyInArrow(lambda key, group: meet(key, group), "h long, rep long, pos int")


def _hot_shingles(entries: DataFrame, limit: int) -> np.ndarray:
    """Shingles seen so often in a sample of the entries that they would fill a regional task.

    At most (rows / limit) of them can exist. Only the way rows travel depends on this list,
    never the result.
    """
    share = 1 / 64
    least = max(2, int(limit * share / 2))
    sample = entries.sample(False, share, seed=7).select(F.explode(arrow_udf(_longs, _AS_LONGS)("entry")).alias("h"))
    found = sample.groupBy("h").count().where(F.col("count") >= least).select("h").collect()
    return np.array([r.h for r in found], np.int64).view(U64)


def _bound_udf(t: Fraction):
    """True where the stored first shingles still allow the pair: a sound bound, no link is lost."""

    def possible(n: pa.Array, a: pa.Array, m: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for nx, x, ny, y in zip(n.to_pylist(), a.to_pylist(), m.to_pylist(), b.to_pylist()):
            x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
            last = min(x[-1] if len(x) < nx else U64(2**64 - 1), y[-1] if len(y) < ny else U64(2**64 - 1))
            i, j = int(np.searchsorted(x, last, "right")), int(np.searchsorted(y, last, "right"))
            common = len(np.intersect1d(x[:i], y[:j], assume_unique=True)) + min(nx - i, ny - j)
            out.append(common * t.denominator >= (nx + ny - common) * t.numerator)
        return pa.array(out, pa.bool_())

    return arrow_udf(possible, "boolean").asNondeterministic()


def _overlap_udf():
    def overlap(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(
            [len(np.intersect1d(np.frombuffer(x, U64), np.frombuffer(y, U64), assume_unique=True)) for x, y in zip(a.to_pylist(), b.to_pylist())],
            pa.int64(),
        )

    return arrow_udf(overlap, "bigint").asNondeterministic()


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()


def _linked(pairs: DataFrame, entries: DataFrame, texts: DataFrame, k: int, t: Fraction) -> DataFrame:
    """The (a, b) of ``pairs`` that really link, each measured on the full shingle sets."""
    size = entries.select("rep", "n")
    near = pairs.join(size.toDF("a", "na"), "a").join(size.toDF("b", "nb"), "b")
    near = staged(near.where(_enough(F.least("na", "nb"), F.greatest("na", "nb"), t)), "jaccard-sized")
    entry = only(entries.select("rep", "entry"), staged(_ends(near), "jaccard-ends"), "rep")
    near = near.join(entry.toDF("a", "ea"), "a").join(entry.toDF("b", "eb"), "b")
    near = staged(near.where(_bound_udf(t)("na", "ea", "nb", "eb")).select("a", "b", "na", "nb"), "jaccard-near")
    wanted = staged(_ends(near), "jaccard-wanted")
    sets = staged(_full_sets(texts, entries, wanted, k), "jaccard-sets")
    both = near.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    both = both.select("a", "b", "na", "nb", _overlap_udf()("sa", "sb").alias("o"))
    return both.where(_enough(F.col("o"), F.col("na") + F.col("nb") - F.col("o"), t)).select("a", "b")


def _label(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """``rows`` with the component of each document."""
    found = comps.select(F.col("id").alias("rep"), F.col("component").alias("found"))
    return rows.join(found, "rep", "left").withColumn("comp", F.coalesce("found", "rep")).drop("found")


def _open_regions(rows: DataFrame) -> DataFrame:
    """The rows of regions that hold more than one component."""
    spans = rows.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    return rows.join(spans.select("h"), "h", "left_semi")


def _side(region: DataFrame, x: str) -> DataFrame:
    names = {"h": "h", "rep": "", "comp": "c", "n": "n", "rank": "r"}
    return region.select(*[F.col(c).alias(p + x) for c, p in names.items()])


def _may_link(t: Fraction) -> Column:
    """Two documents of a region that may link, and don't belong together yet.

    Sizes allow it, and so do the ranks: if this is their first common shingle, all that stands
    before it on either side is outside the intersection. (If it isn't, they meet at the first.)
    """
    sizes = _enough(F.least("na", "nb"), F.greatest("na", "nb"), t)
    apart = (F.col("ra") + F.col("rb")) * F.lit(t.denominator + t.numerator)
    ranks = apart <= (F.col("na") + F.col("nb")) * F.lit(t.denominator - t.numerator)
    return (F.col("ha") == F.col("hb")) & (F.col("ca") != F.col("cb")) & sizes & ranks


def _cluster_links(region: DataFrame, entries: DataFrame, texts: DataFrame, k: int, t: Fraction) -> DataFrame:
    """Links that join components inside clusters of open regions.

    Every document outside its cluster's main component is held against all of the cluster, on
    the full sets. Blocks of about ``BLOCK`` documents meet in one task; it returns at most one
    link for each document and component.
    """
    least = region.groupBy("h").agg(F.min("rep").alias("b"))
    ties = region.select("h", F.col("rep").alias("a")).join(least, "h").select("a", "b").distinct()
    cluster = connected_components(ties).select(F.col("id").alias("rep"), F.col("component").alias("cluster"))
    docs = region.select("rep", "comp", "n").distinct().join(cluster, "rep")
    comps = docs.groupBy("cluster", "comp").agg(F.count("*").alias("m"))
    main = comps.groupBy("cluster").agg(F.max(F.struct("m", "comp")).alias("main"), F.sum("m").alias("m"))
    main = main.select("cluster", F.col("main.comp").alias("main"), "m", (F.col("m") - F.col("main.m")).alias("outside"))
    docs = staged(docs.join(main, "cluster"), "jaccard-cluster")
    sets = _full_sets(texts, entries, staged(docs.select("rep").distinct(), "jaccard-reps"), k).withColumnRenamed("entry", "s")
    docs = docs.join(sets, "rep")
    deal = lambda total, seed: F.pmod(F.xxhash64("rep", F.lit(seed)), F.ceil(F.col(total) / BLOCK))
    copies = lambda total: F.explode(F.sequence(F.lit(0), F.ceil(F.col(total) / BLOCK) - 1))
    held = ["cluster", "rep", "comp", "n", "s"]
    out = docs.where("comp <> main").select(*held, F.lit(True).alias("outer"), deal("outside", 1).alias("i"), copies("m").alias("j"))
    all_ = docs.where("outside > 0").select(*held, F.lit(False).alias("outer"), deal("m", 2).alias("j"), copies("outside").alias("i"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def meet(key, group):
        rep, comp, n = (group.column(c).to_numpy() for c in ("rep", "comp", "n"))
        outer = np.array(group.column("outer").to_pylist(), bool)
        flat = [np.frombuffer(v, U64) for v in group.column("s").to_pylist()]
        a, b = [], []
        left, right = np.flatnonzero(outer), np.flatnonzero(~outer)
        if len(left) and len(right):
            owner = np.repeat(np.arange(len(right)), n[right])
            every = np.concatenate([flat[i] for i in right])
            order = np.argsort(every, kind="stable")
            every, owner = every[order], owner[order]
            for x in left:
                lo, hi = np.searchsorted(every, flat[x], "left"), np.searchsorted(every, flat[x], "right")
                runs = hi - lo
                at = np.repeat(lo - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())
                common = np.bincount(owner[at], minlength=len(right))
                link = common * t.denominator >= (n[x] + n[right] - common) * t.numerator
                link &= comp[right] != comp[x]
                _, first = np.unique(comp[right[link]], return_index=True)
                for y in right[link][first]:
                    a.append(rep[x])
                    b.append(rep[y])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

    return out.unionByName(all_).groupBy("cluster", "i", "j").applyInArrow(lambda key, group: meet(key, group), "a long, b long")


def jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    threshold: str = "0.8",
    region_rows: int = REGION_ROWS,
    wide: int = WIDE,
) -> DataFrame:
    """``docs`` -> (doc id, n_shingles, class_id, component_id), one row for each input row.

    ``class_id`` is the smallest id with the same shingle set, ``component_id`` the smallest id
    reachable by links (J >= ``threshold``, an exact decimal), the row's own id included.

    Defined cases: null or wordless text has no shingle, links with nothing and is its own
    component; fewer words than ``shingle_words`` make one shingle; rows that repeat an id each
    get the result of their own text; rows with a null id link with nothing and get a null class
    and component; an empty table gives an empty table; further columns of ``docs`` are ignored,
    whatever their names. Texts of any length are read whole. Shingles and shingle sets are told
    apart by 64-bit hashes.
    """
    ship(docs.sparkSession)
    t = Fraction(threshold)
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    sig = _signed(texts, shingle_words, t).withColumn("row", F.monotonically_increasing_id())
    sig = staged(sig, "jaccard-signatures")
    same = ["n", "c1", "c2"]
    classes = sig.where("n > 0 and doc is not null").groupBy(*same).agg(F.min(F.struct("doc", "row")).alias("head"))
    # a class goes by the row number of its first document
    classes = staged(classes.select(*same, F.col("head.doc").alias("class_id"), F.col("head.row").alias("rep")), "jaccard-classes")
    entries = only(sig.withColumnRenamed("row", "rep"), classes.select("rep"), "rep")
    links = _join_entries(entries, texts.where("doc is not null"), shingle_words, t, region_rows, wide)

    reach = connected_components(links).select(F.col("id").alias("rep"), "component")
    known = classes.join(reach, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    least = known.groupBy("component").agg(F.min("class_id").alias("component_id"))
    known = known.join(least, "component").select(*same, "class_id", "component_id")
    out = sig.select("doc", *same).join(known, same, "left")  # empty texts are no class
    return out.select(
        F.col("doc").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc").isNotNull(), F.coalesce("class_id", "doc")).alias("class_id"),
        F.when(F.col("doc").isNotNull(), F.coalesce("component_id", "doc")).alias("component_id"),
    )


def _join_entries(entries, texts, k, t, region_rows, wide) -> DataFrame:
    """Links (a, b) between set ids; they join exactly the right components."""
    spark = entries.sparkSession
    rows = entries.agg(F.sum(F.length("entry") / 8).cast("long")).first()[0] or 0
    buckets = parts(spark, rows, region_rows)
    hot = _hot_shingles(entries, region_rows // 3)
    region = staged(_shared(_enter(entries.select("rep", "entry"), buckets, hot)), "jaccard-regions")

    def first_round(region):
        """Each region's smallest document is its pivot: one candidate for each row."""
        pivot = region.groupBy("h").agg(F.min("rep").alias("b"))
        pairs = region.select("h", F.col("rep").alias("a")).join(pivot, "h").where("a <> b")
        return pairs.select("a", "b").distinct()

    tested = staged(first_round(region), "jaccard-tested")
    links = staged(_linked(tested, entries, texts, k, t), "jaccard-links")
    comps = connected_components(links)

    # common shingles go last; documents without enough others enter with all their shingles
    common = _label(region, comps).groupBy("h").agg(F.approx_count_distinct("comp", 0.05).alias("m")).where(F.col("m") > wide).select("h")
    common = staged(common, "jaccard-common")
    lost = region.join(common, "h", "left_semi").groupBy("rep").agg(F.count("*").alias("lost"))
    need = F.expr(f"n * {t.denominator - t.numerator} div {t.denominator} + 1")
    size = entries.select("rep", "n", need.alias("need"), (F.length("entry") / 8).cast("long").alias("entered"))
    size = size.join(lost, "rep", "left").withColumn("lost", F.coalesce("lost", F.lit(0)))
    size = staged(size, "jaccard-sizes")
    short = size.where(F.col("entered") - F.col("lost") < F.col("need"))
    region = region.select("h", "rep", "pos")
    if not short.isEmpty():
        full = staged(_full_sets(texts, entries, staged(short.select("rep"), "jaccard-short"), k), "jaccard-full")
        every = full.select("rep", F.explode(arrow_udf(_longs, _AS_LONGS).asNondeterministic()("entry")).alias("h"))
        rest = entries.select("rep", "entry").join(short, "rep", "left_anti").unionByName(full)
        region = staged(_shared(_enter(rest, buckets, hot)), "jaccard-regions")
        # common shingles of such a document only as far as its window needs them
        others = every.join(common, "h", "left_anti").groupBy("rep").agg(F.count("*").alias("others"))
        missing = short.join(others, "rep", "left").withColumn("take", F.col("need") - F.coalesce("others", F.lit(0)))
        last = every.join(common, "h", "left_semi").join(missing.where("take > 0").select("rep", "take"), "rep")
        last = last.groupBy("rep", "take").agg(F.sort_array(F.collect_list("h")).alias("hs"))
        last = last.select(F.explode(F.expr("slice(hs, 1, int(take))")).alias("h"), "rep", F.lit(0).alias("rank"))
        lost = region.join(common, "h", "left_semi").groupBy("rep").agg(F.count("*").alias("lost"))
        size = staged(size.drop("lost").join(lost, "rep", "left").withColumn("lost", F.coalesce("lost", F.lit(0))), "jaccard-sizes")
    else:
        last = spark.range(0).selectExpr("id AS h", "id AS rep", "CAST(id AS INT) AS rank")
    # a shingle's rank among the others of its document is pos - lost at least
    region = region.join(common, "h", "left_anti").join(size, "rep").where(F.col("pos") < F.col("need") + F.col("lost"))
    region = region.select("h", "rep", F.greatest(F.col("pos") - F.col("lost"), F.lit(0)).cast("int").alias("rank"))
    region = staged(region.unionByName(last).join(size.select("rep", "n"), "rep"), "jaccard-regions")

    region = staged(_open_regions(_label(region, comps)), "jaccard-open")
    many = region.groupBy("h").count().where(F.col("count") > SMALL).select("h")
    large = region.join(many, "h", "left_semi")
    small = region.join(many, "h", "left_anti")
    pairs = _side(small, "a").join(_side(small, "b"), _may_link(t) & (F.col("a") < F.col("b"))).select("a", "b").distinct()
    seen = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = staged(pairs.join(seen, ["a", "b"], "left_anti"), "jaccard-pairs")
    found = _linked(pairs, entries, texts, k, t)
    return staged(links.unionByName(found).unionByName(_cluster_links(large, entries, texts, k, t)), "jaccard-links")

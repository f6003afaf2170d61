"""Exact duplicates by two-pass Bloom filtering, with DataFrame functions only.

Texts are equal when they are identical after each run of white space ``[\\x20\\x09-\\x0D]+`` has
become one space. One scan turns every document into a narrow staged row: its id, the SHA-256 of the
normalised text and a row number. The filter works on those rows:

1. *Sightings.* The filter is blocked: a digest owns one of ``WORDS_EACH`` times as many 64-bit words
   as there are documents, and two of the word's ``LANES`` counters. Words are summed map-side and
   then by word, so a text copied a million times sends one row a task. A counter at two or more
   marks its lane as seen again; words without such a lane end here.
2. *Possibly repeated.* A document whose two lanes were both seen again may be a duplicate; every
   duplicate is (a counter never counts too little). Only these rows are shuffled by their digest.
   The rest pass straight through: their text is the only one of its kind.

A word with more than 511 documents could carry over from one counter to the next; all its lanes
count as seen again. That and unlucky neighbours cost a few needless rows in step 2, never a result.

The words that were seen again are broadcast up to ``BROADCAST_KEYS`` counted rows; beyond that the
narrow rows (no texts) meet them by a shuffle of the words. A group of equal texts is reduced
map-side. Words and groups with more than a thousandth of all rows, so at most a thousand of each,
meet their rows by broadcast in any case: no key of a shuffle is larger than that thousandth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.names import quote
from panelforge.llm.tables import BROADCAST_KEYS, staged

#: Counters of a filter word and the bits of each: 63 bits of a signed 64-bit sum.
LANES, LANE_BITS = 7, 9
LANE_MOST = (1 << LANE_BITS) - 1
#: Filter words for each document.
WORDS_EACH = 2
#: A group with more rows than this part of all rows meets them by broadcast.
HEAVY_PART = 1000


def normalised(text: Column) -> Column:
    """``text`` with one space for each run of white space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _lanes(digest: Column) -> tuple[Column, Column]:
    """The two different counters of a digest."""
    h = F.xxhash64(digest, F.lit("lanes"))
    one = F.pmod(h, F.lit(LANES))
    return one, F.pmod(one + 1 + F.pmod(F.shiftright(h, 20), F.lit(LANES - 1)), F.lit(LANES))


def _bits(one: Column, two: Column, bits_each: int) -> Column:
    """A number with the unit of each of the two lanes, ``bits_each`` wide."""
    unit = lambda lane: F.call_function("shiftleft", F.lit(1).cast("long"), (lane * bits_each).cast("int"))
    return unit(one) + unit(two)


def seen_again(rows: DataFrame) -> DataFrame:
    """(word, again, n) of the filter words that hold a counter of two or more; ``again`` has a bit
    for each lane, ``n`` is the word's number of rows. ``rows`` hold ``word`` and ``units``."""
    words = rows.groupBy("word").agg(F.try_sum("units").alias("total"), F.count(F.lit(1)).alias("n"))
    lanes = [
        F.when(F.shiftright("total", LANE_BITS * i).bitwiseAND(F.lit(LANE_MOST)) >= 2, F.lit(1 << i)).otherwise(F.lit(0))
        for i in range(LANES)
    ]
    again = F.when(F.col("n") > LANE_MOST, F.lit((1 << LANES) - 1)).otherwise(sum(lanes[1:], lanes[0]))
    return words.where("n > 1").select("word", again.cast("long").alias("again"), "n").where("again > 0")


def meet(rows: DataFrame, found: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` left-joined with ``found`` (one row a ``key``) as a struct ``met``: by broadcast where
    ``size`` is over a thousandth of ``total`` rows, by a shuffle elsewhere."""
    found = found.select(key, F.struct(*[c for c in found.columns if c != key]).alias("met"))
    heavy = F.col(f"met.{size}") > total // HEAVY_PART
    tried = rows.join(F.broadcast(found.where(heavy)), key, "left")
    rest = tried.where("met is null").drop("met").join(found.where(~heavy), key, "left")
    return tried.where("met is not null").unionByName(rest)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``keep_id`` (the id of the row that stays of its
    group of equal texts), ``group_size``, ``kept``, ``text_sha256`` (lower-case hex of the normalised
    text in UTF-8) and ``row``, a struct of the columns ``carry`` (any names; none by default).

    The row with the smallest id stays. Null text counts as empty, so null, empty and no other texts
    are equal to each other; blank ones equal a single space. A null id is larger than any id: such a
    row stays only in a group without ids, with a null ``keep_id``. Of repeated rows (one id, one
    text) exactly one stays. Texts of any length are hashed whole. An empty table gives no rows.
    """
    narrow = staged(
        docs.select(
            F.col(quote(id_col)).alias("doc_id"),
            F.unhex(F.sha2(normalised(F.col(quote(text_col))), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row_number"),
            F.struct(*[F.col(quote(c)) for c in carry or []] or [F.lit(True).alias("none")]).alias("row"),
        ),
        "exact-digests",
    )
    total = narrow.count()
    word = F.pmod(F.xxhash64("digest"), F.lit(max(1024, WORDS_EACH * total))).alias("word")
    lanes = _lanes(F.col("digest"))
    again = staged(seen_again(narrow.select(word, _bits(*lanes, LANE_BITS).alias("units"))), "exact-again")

    own = _bits(*lanes, 1)
    maybe = F.coalesce(F.col("again").bitwiseAND(own) == own, F.lit(False)).alias("maybe")
    if again.count() <= BROADCAST_KEYS:
        tested = narrow.withColumn("word", word).join(F.broadcast(again.drop("n")), "word", "left").select(*narrow.columns, maybe)
    else:
        tested = meet(narrow.withColumn("word", word), again, "word", "n", total).withColumn("again", F.col("met.again"))
        tested = staged(tested.select(*narrow.columns, maybe), "exact-tested")

    repeated = tested.where("maybe").drop("maybe")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("odd"), "doc_id", "row_number"))
    groups = repeated.groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("size"))
    groups = staged(groups.where("size > 1"), "exact-groups")
    resolved = meet(repeated, groups, "digest", "size", total)
    alone = tested.where("not maybe").drop("maybe").withColumn("met", F.lit(None).cast(resolved.schema["met"].dataType))
    single = F.col("met").isNull()
    return resolved.unionByName(alone).select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("met.first.doc_id")).alias("keep_id"),
        F.coalesce("met.size", F.lit(1)).cast("long").alias("group_size"),
        (single | F.coalesce(F.col("met.first.row_number") == F.col("row_number"), F.lit(False))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "row",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops: the same columns, whatever their names."""
    return exact_dedup(docs, id_col, text_col, carry=docs.columns).where("kept").select("row.*")

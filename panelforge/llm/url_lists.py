"""URL filter with dated lists: a temporal join of captures and list entries.

A list is a log of dated entries: at an instant, a key (a host with its subdomains, a path prefix,
or one address) is added to a category or removed from it. The log becomes validity intervals
[from, to), and an as-of join evaluates every capture against the intervals that hold at its fetch
time. Keys that a capture can match (its host's suffixes, its path's folders, its address) are
exploded and joined by equality of key and month, so that an interval is met only by captures of
its time; a hot host is split by AQE's skew join. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def canonical(url: Column) -> tuple[Column, Column]:
    """(host, path with query) of an address: no scheme, user, port, fragment or trailing host dot;
    the host in lower case, the path at least '/'. Null where there is no host."""
    rest = F.regexp_replace(F.trim(url), r"#.*$", "")
    rest = F.regexp_replace(rest, r"^[A-Za-z][A-Za-z0-9+.\-]*:", "")
    rest = F.when(rest.startswith("//"), rest)
    authority = F.regexp_extract(rest, r"^//([^/?]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", ""), r"\.+$", ""))
    path = F.regexp_replace(rest, r"^//[^/?]*", "")
    path = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    known = host != ""
    return F.when(known, host), F.when(known, path)


def match_keys(host: Column, path: Column) -> Column:
    """All keys that list entries may use for a capture: ``h:`` host suffixes, ``p:`` host and
    folder (with its slash), ``u:`` host, path and query."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("h:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    parts = F.split(F.regexp_replace(path, r"\?.*$", ""), "/")  # '' first; the last is no folder
    folders = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
        lambda i: F.concat(F.lit("p:"), host, F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")),
    )
    return F.array_distinct(F.concat(suffixes, folders, F.array(F.concat(F.lit("u:"), host, path))))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``entries``(key, category, action, at) -> disjoint (key, category, valid_from, valid_to).

    ``action`` is 'add' or 'remove' (others and null keys, categories and dates are ignored). Of
    entries for one key, category and instant a removal wins; repeated additions and removals
    change nothing; an interval without a removal stays open (``valid_to`` null). Entries of one
    instant are combined before the shuffle, so a key has at most one row for each instant.
    """
    log = entries.where("key is not null and category is not null and at is not null and action in ('add', 'remove')")
    log = log.groupBy("key", "category", "at").agg(F.max(F.when(F.col("action") == "remove", 1).otherwise(0)).alias("removed"))
    order = Window.partitionBy("key", "category").orderBy("at")
    changes = log.withColumn("was", F.coalesce(F.lag("removed").over(order), F.lit(1))).where("removed <> was")
    changes = changes.withColumn("valid_to", F.lead("at").over(order))
    return changes.where("removed = 0").select("key", "category", F.col("at").alias("valid_from"), "valid_to")


def _month(at: Column) -> Column:
    return F.year(at) * 12 + F.month(at)


def url_list_join(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """(id, host, fetched_at, n_matches, categories, first_key, blocked), one row for each capture.

    ``n_matches`` counts the intervals that hold at the fetch time, ``categories`` lists theirs
    (sorted, joined by commas; empty if none), ``first_key`` is the smallest matching key.

    A null, empty or hostless address, or a null fetch time, matches nothing. Captures that repeat
    in id, address and time each get the same result. Empty tables on either side are fine; other
    columns of both are ignored, whatever their names.
    """
    host, path = canonical(F.col(url_col))
    seen = captures.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(time_col).alias("_at"), host.alias("host"), path.alias("path"))
    held = validity_intervals(entries.select("key", "category", "action", "at"))
    span = seen.agg(F.min("_at").alias("lo"), F.max("_at").alias("hi")).first()  # one row
    keyed = seen.where("host is not null and _at is not null").select("_id", "_url", "_at", F.explode(match_keys(F.col("host"), F.col("path"))).alias("key")).distinct()
    keyed = keyed.withColumn("month", _month(F.col("_at")))
    from_, to = F.greatest(F.col("valid_from"), F.lit(span.lo)), F.least(F.col("valid_to"), F.lit(span.hi))  # of months with captures
    held = held.where((F.col("valid_from") <= F.lit(span.hi)) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(span.lo))))
    held = held.withColumn("month", F.explode(F.sequence(_month(from_), _month(to)))).withColumnRenamed("key", "entry")
    at = F.col("_at")
    meets = (keyed["key"] == held["entry"]) & (keyed["month"] == held["month"]) & (at >= F.col("valid_from")) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
    hits = keyed.join(held, meets).groupBy("_id", "_url", "_at").agg(
        F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("category")), ",").alias("categories"), F.min("key").alias("first_key")
    )
    hits = hits.select(F.col("_id").alias("i"), F.col("_url").alias("u"), F.col("_at").alias("t"), "n", "categories", "first_key")
    same = F.col("_id").eqNullSafe(F.col("i")) & (F.col("_url") == F.col("u")) & (F.col("_at") == F.col("t"))
    out = seen.join(hits, same, "left")
    return out.select(
        F.col("_id").alias(id_col),
        "host",
        F.col("_at").alias(time_col),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_matches"),
        F.coalesce("categories", F.lit("")).alias("categories"),
        "first_key",
        F.col("n").isNotNull().alias("blocked"),
    )

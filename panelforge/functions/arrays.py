"""Array column expressions, all built-in (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.types import contains_map


def element_at_period(arr: Column, period: Column) -> Column:
    """1-based element of ``arr``; NULL for a NULL array or a period past the end.

    ``F.get`` is used because ``element_at`` and ``arr[i]`` raise under ANSI mode for an index
    out of range, whereas a short array must give NULL here.
    """
    return F.get(arr, period - F.lit(1))


def distinct_non_null_count(array_sql: str, element_type: T.DataType) -> Column:
    """Number of distinct non-NULL elements of the array expression ``array_sql`` (SQL text),
    as BIGINT; an empty array gives 0.

    Built from SQL text: one expression per column instead of a Python lambda round trip per
    node, which keeps plan construction cheap for wide tables. Elements holding a map are
    compared by their string form, since Spark has no equality on maps.
    """
    arr = f"transform({array_sql}, x -> CAST(x AS STRING))" if contains_map(element_type) else array_sql
    return F.expr(f"CAST(size(array_distinct(filter({arr}, x -> x IS NOT NULL))) AS BIGINT)")


def hashable_equality(t: T.DataType) -> bool:
    """Whether Spark compares values of ``t`` by hashing (atomic types except binary).

    For other types ``array_distinct`` falls back to a nested loop, quadratic in the array
    length; their distinct counts are taken with ``collect_set`` during aggregation instead.
    """
    return not isinstance(t, (T.ArrayType, T.StructType, T.MapType, T.BinaryType))


def set_input(c: Column, t: T.DataType) -> Column:
    """``c`` as text with the same equality (NULL stays NULL), so that sets of it are hashed:
    nested values as JSON with full timestamps, binary as base64."""
    if isinstance(t, T.BinaryType):
        return F.base64(c)
    full = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    options = {"timestampFormat": full, "timestampNTZFormat": full.removesuffix("XXX"), "ignoreNullFields": "false"}
    return F.when(c.isNotNull(), F.to_json(F.struct(c.alias("v")), options))

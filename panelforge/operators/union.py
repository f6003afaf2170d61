"""Union of slices by column name with type widening."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.names import col
from panelforge.functions.types import SchemaConflictError, widen


def target_schema(schemas: list[T.StructType], labels: list[str] | None = None) -> T.StructType:
    """Columns in first-seen order (case-insensitive names, first spelling kept), widened types."""
    labels = labels or [str(i) for i in range(len(schemas))]
    order: list[str] = []
    spelled: dict[str, str] = {}
    types: dict[str, T.DataType] = {}
    for schema, label in zip(schemas, labels):
        for f in schema.fields:
            key = f.name.lower()
            if key not in types:
                order.append(key)
                spelled[key] = f.name
                types[key] = f.dataType
            else:
                try:
                    types[key] = widen(types[key], f.dataType, f.name)
                except SchemaConflictError as e:
                    raise SchemaConflictError(f"{e} (slice {label})") from None
    return T.StructType([T.StructField(spelled[k], types[k], True) for k in order])


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """Select ``target``'s columns from ``df``: cast where the type differs, NULL where absent."""
    have = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for f in target.fields:
        src = have.get(f.name.lower())
        if src is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif src.dataType == f.dataType:
            out.append(col(src.name).alias(f.name))
        else:
            out.append(col(src.name).cast(f.dataType).alias(f.name))
    return df.select(*out)


def union_by_name(frames: list[DataFrame], labels: list[str] | None = None) -> DataFrame:
    """Stack ``frames`` by column name: missing columns are NULL, new columns are appended,
    differing types are widened (``SchemaConflictError`` where no common type exists).

    Every frame is conformed to the common schema explicitly, so the result does not depend on
    Spark's own union coercion (which, under ANSI, tries string -> bigint and fails).
    """
    if not frames:
        raise ValueError("nothing to union")
    target = target_schema([f.schema for f in frames], labels)
    return reduce(DataFrame.union, [conform(f, target) for f in frames])

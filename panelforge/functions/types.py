"""Type widening for combining year slices by column name.

The result type of two column types follows the union-by-name rules the normalization
semantics expect: integers widen to the larger integer, integers and decimals to a decimal
wide enough for both, anything numeric with a double to double, anything scalar with a string
to string, date with timestamp to timestamp, arrays element-wise. Temporal types never combine
with numbers or booleans, and a scalar never combines with an array: those raise
``SchemaConflictError`` at plan time, before any data is read.
"""

from __future__ import annotations

from pyspark.sql import types as T


class SchemaConflictError(TypeError):
    """Two slices hold one column with types that have no common type."""


_INTEGRAL_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_INTEGRAL_ORDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_MAX_PRECISION = 38


def _is_integral(t: T.DataType) -> bool:
    return type(t) in _INTEGRAL_DIGITS


def _is_temporal(t: T.DataType) -> bool:
    return isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType))


def _is_complex(t: T.DataType) -> bool:
    return isinstance(t, (T.ArrayType, T.StructType, T.MapType))


def _as_decimal(t: T.DataType) -> T.DecimalType:
    if isinstance(t, T.DecimalType):
        return t
    if isinstance(t, T.BooleanType):
        return T.DecimalType(1, 0)
    return T.DecimalType(_INTEGRAL_DIGITS[type(t)], 0)


def _widen_decimal(a: T.DataType, b: T.DataType) -> T.DataType:
    da, db = _as_decimal(a), _as_decimal(b)
    scale = max(da.scale, db.scale)
    precision = max(da.precision - da.scale, db.precision - db.scale) + scale
    if precision > _MAX_PRECISION:
        return T.DoubleType()
    return T.DecimalType(precision, scale)


def widen(a: T.DataType, b: T.DataType, column: str = "?") -> T.DataType:
    """The common type of ``a`` and ``b`` or ``SchemaConflictError``."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a

    def conflict() -> SchemaConflictError:
        return SchemaConflictError(
            f"column '{column}' has types {a.simpleString()} and {b.simpleString()} with no common type"
        )

    if _is_complex(a) or _is_complex(b):
        if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
            return T.ArrayType(widen(a.elementType, b.elementType, column), True)
        if isinstance(a, T.MapType) and isinstance(b, T.MapType):
            return T.MapType(
                widen(a.keyType, b.keyType, column), widen(a.valueType, b.valueType, column), True
            )
        if isinstance(a, T.StructType) and isinstance(b, T.StructType):
            na = [f.name.lower() for f in a.fields]
            nb = [f.name.lower() for f in b.fields]
            if na != nb:
                raise conflict()
            return T.StructType(
                [
                    T.StructField(fa.name, widen(fa.dataType, fb.dataType, f"{column}.{fa.name}"), True)
                    for fa, fb in zip(a.fields, b.fields)
                ]
            )
        raise conflict()

    if isinstance(a, (T.StringType, T.CharType, T.VarcharType)) or isinstance(
        b, (T.StringType, T.CharType, T.VarcharType)
    ):
        return T.StringType()
    if isinstance(a, T.BinaryType) or isinstance(b, T.BinaryType):
        raise conflict()

    if _is_temporal(a) or _is_temporal(b):
        if not (_is_temporal(a) and _is_temporal(b)):
            raise conflict()
        if isinstance(a, T.TimestampType) or isinstance(b, T.TimestampType):
            return T.TimestampType()
        return T.TimestampNTZType()

    # numbers and booleans
    if isinstance(a, T.BooleanType):
        return b
    if isinstance(b, T.BooleanType):
        return a
    if isinstance(a, T.DoubleType) or isinstance(b, T.DoubleType):
        return T.DoubleType()
    if isinstance(a, T.FloatType) or isinstance(b, T.FloatType):
        return T.FloatType()
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        return _widen_decimal(a, b)
    if _is_integral(a) and _is_integral(b):
        return max(a, b, key=lambda t: _INTEGRAL_ORDER.index(type(t)))
    raise conflict()


def widen_all(types: list[T.DataType], column: str = "?") -> T.DataType:
    out: T.DataType = T.NullType()
    for t in types:
        out = widen(out, t, column)
    return out


def is_orderable(t: T.DataType) -> bool:
    """Whether Spark can sort values of this type (maps cannot)."""
    if isinstance(t, T.MapType):
        return False
    if isinstance(t, T.ArrayType):
        return is_orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(is_orderable(f.dataType) for f in t.fields)
    return True


def contains_map(t: T.DataType) -> bool:
    """Whether equality on this type is unavailable in Spark (a map at any depth)."""
    return not is_orderable(t)

"""Content digests: one fixed-width value that stands for a wide one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemirror.errors import SchemaError
from tablemirror.schemas import require_columns


def is_wide_type(dt: T.DataType) -> bool:
    """Columns of variable width whose digests are equal exactly where the values are: text,
    binary, arrays and structs with an array of fixed-width parts, and whatever holds a map, which
    text may be part of."""
    if isinstance(dt, T.BinaryType) or dt == T.StringType():
        return True
    if _has_map(dt):
        return _formable(dt)
    return isinstance(dt, (T.ArrayType, T.StructType)) and _nestable(dt)


def wide_columns(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Columns outside the keys that are compared by digest unless the caller says otherwise."""
    return [f.name for f in df.schema if f.name not in keys and is_wide_type(f.dataType)]


def digest_bytes(column: str, dt: T.DataType | None = None) -> Column:
    """SHA-256 of a column as 32 bytes; null stays null, and null is unlike empty.

    Arrays and structs are digested as JSON with null fields kept, in which each value has
    one form: both zeros are 0.0 and all NaN are one. Maps are the arrays of their entries in the order of
    their keys, so that two maps with equal entries are equal however they were built.
    """
    col = F.col(column)
    if isinstance(dt, (T.ArrayType, T.StructType, T.MapType)):
        whole = F.to_json(F.struct(_one_form(col, dt).alias("v")), {"ignoreNullFields": "false"})
        col = F.when(col.isNotNull(), whole)
    return F.unhex(F.sha2(col, 256))


def _nestable(dt: T.DataType) -> bool:
    if isinstance(dt, T.ArrayType):
        return _nestable(dt.elementType)
    if isinstance(dt, T.StructType):
        return bool(dt.fields) and all(_nestable(f.dataType) for f in dt)
    return isinstance(dt, (T.NumericType, T.BooleanType, T.DateType))


def _has_map(dt: T.DataType) -> bool:
    if isinstance(dt, T.ArrayType):
        return _has_map(dt.elementType)
    if isinstance(dt, T.StructType):
        return any(_has_map(f.dataType) for f in dt)
    return isinstance(dt, T.MapType)


def _formable(dt: T.DataType) -> bool:
    """As ``_nestable``, with text and maps as parts."""
    if isinstance(dt, T.ArrayType):
        return _formable(dt.elementType)
    if isinstance(dt, T.StructType):
        return bool(dt.fields) and all(_formable(f.dataType) for f in dt)
    if isinstance(dt, T.MapType):
        return _formable(dt.keyType) and _formable(dt.valueType)
    return dt == T.StringType() or _nestable(dt)


def _one_form(col: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.MapType):
        # a value as text, as maps within maps cannot be ordered; JSON frames every text in it
        def entry(e: Column) -> Column:
            value = F.struct(_one_form(e["value"], dt.valueType).alias("v"))
            return F.struct(
                _one_form(e["key"], dt.keyType).alias("k"),
                F.to_json(value, {"ignoreNullFields": "false"}).alias("v"),
            )

        return F.array_sort(F.transform(F.map_entries(col), entry))
    if isinstance(dt, T.ArrayType):
        return F.transform(col, lambda x: _one_form(x, dt.elementType))
    if isinstance(dt, T.StructType):
        inner = [_one_form(col.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(dt)]
        return F.when(col.isNotNull(), F.struct(*inner))
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return col + F.lit(0.0).cast(dt)  # -0.0 and 0.0 are one value
    return col


def row_digest(df: DataFrame, cols: str | Sequence[str], name: str = "digest") -> DataFrame:
    """Add the lower-case hex SHA-256 of ``cols`` as column ``name``.

    One column: the digest of its bytes, null for null. Several: the digest of the
    column digests in the order given. Each part is either 64 hex digits or a
    dash for null, so no two different rows share one input.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    if not cols:
        raise SchemaError("row_digest needs at least one column")
    require_columns(df, cols)
    parts = [_part(df, c) for c in cols]
    if len(parts) == 1:
        return df.withColumn(name, parts[0])
    return df.withColumn(name, F.sha2(F.concat(*[F.coalesce(p, F.lit("-")) for p in parts]), 256))


def content_digest(df: DataFrame, cols: Sequence[str], stored: str | None = None) -> Column:
    """16 bytes that stand for the values of ``cols``, in whatever order they are named.

    The first half of a SHA-256 over one part for each column, by name: the digest of a wide
    value, any other value behind its length, a dash for null. So no two different rows share one input.
    Where ``df`` has the digest of a wide column as ``<column><stored>``, that is read in its place.
    """
    cols = sorted(cols)
    require_columns(df, cols)
    parts = [_framed(df, c, stored) for c in cols] or [F.lit("")]
    return F.unhex(F.left(F.sha2(F.concat(*parts), 256), F.lit(32)))


def _framed(df: DataFrame, column: str, stored: str | None) -> Column:
    dt = df.schema[column].dataType
    if is_wide_type(dt):
        known = stored is not None and column + stored in df.columns
        part = F.lower(F.hex(F.col(column + stored) if known else digest_bytes(column, dt)))
    else:
        text = _canonical(df, column)
        part = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(part, F.lit("-"))


_HALF = 1 << 64


def digest_sum(digest: Column) -> Column:
    """Aggregate of 16-byte digests: their sum modulo 2**128, as 32 hex digits; null for no rows.

    The order and the partitioning of the rows do not matter, a repeated row counts again, and the
    sum over a group is the sum of the sums over its parts. Combines before the shuffle.
    """

    def total(at: int) -> Column:
        return F.sum(F.conv(F.hex(F.substring(digest, at, 8)), 16, 10).cast("decimal(20,0)"))

    size = F.lit(str(_HALF)).cast("decimal(20,0)")
    low, high = total(9), total(1)
    high = high + F.call_function("div", low, size)

    def digits(n: Column) -> Column:
        return F.lower(F.lpad(F.conv((n % size).cast("decimal(20,0)").cast("string"), 10, 16), 16, "0"))

    return F.concat(digits(high), digits(low))


def _part(df: DataFrame, column: str) -> Column:
    dt = df.schema[column].dataType
    if isinstance(dt, (T.ArrayType, T.StructType, T.MapType)) and is_wide_type(dt):
        return F.lower(F.hex(digest_bytes(column, dt)))
    return F.sha2(_canonical(df, column), 256)


def _canonical(df: DataFrame, column: str) -> Column:
    """A text form that is equal exactly where the values are equal."""
    dt, col = df.schema[column].dataType, F.col(column)
    if is_wide_type(dt):
        return col
    if isinstance(dt, T.FractionalType) and not isinstance(dt, T.DecimalType):
        return (col + F.lit(0.0).cast(dt)).cast("string")  # -0.0 and 0.0 are one value
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(col).cast("string")  # local time repeats an hour each autumn
    if isinstance(dt, (T.NumericType, T.BooleanType, T.DateType, T.TimestampNTZType)):
        return col.cast("string")
    raise SchemaError(f"no digest for column {column} ({dt.simpleString()}); compare it by value")

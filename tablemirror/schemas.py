"""Schema checks shared by the operators; all look at types only, no job runs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablemirror.errors import SchemaError


def key_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    columns = list(columns)
    dotted = [c for c in {*columns, *df.columns} if "." in c or "`" in c]
    if dotted:
        raise SchemaError(f"rename columns with a dot or a backquote: {', '.join(sorted(dotted))}")
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise SchemaError(f"no such column: {', '.join(absent)}")


def check_same_schema(source: DataFrame, target: DataFrame, ignore: Iterable[str] = ()) -> None:
    """Same column names and types on both sides; order and nullability are free."""
    skip = set(ignore)
    s, t = (
        {f.name: f.dataType.simpleString() for f in df.schema if f.name not in skip}
        for df in (source, target)
    )
    if s != t:
        parts = [
            f"{name}: source {s.get(name, 'absent')}, target {t.get(name, 'absent')}"
            for name in sorted(s.keys() | t.keys())
            if s.get(name) != t.get(name)
        ]
        raise SchemaError("schemas differ: " + "; ".join(parts))


def check_comparable(df: DataFrame, columns: Iterable[str]) -> None:
    """Refuse types that ``<=>`` cannot compare."""
    for c in columns:
        if not _comparable(df.schema[c].dataType):
            raise SchemaError(
                f"column {c} ({df.schema[c].dataType.simpleString()}) cannot be compared; "
                "turn maps into sort_array(map_entries(...)) first"
            )


def has_wide_payload(df: DataFrame, keys: Sequence[str]) -> bool:
    """Is any column outside the keys of variable width?"""
    fixed = (T.NumericType, T.BooleanType, T.DatetimeType, T.AnsiIntervalType)
    return any(not isinstance(f.dataType, fixed) for f in df.schema if f.name not in keys)


def _comparable(dt: T.DataType) -> bool:
    if isinstance(dt, T.ArrayType):
        return _comparable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_comparable(f.dataType) for f in dt)
    return not isinstance(dt, (T.MapType, T.VariantType))

"""Named rows: all of them, or nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemirror.errors import MissingKeysError, SchemaError
from tablemirror.operators.keys import KeyStats, key_stats
from tablemirror.operators.scope import under
from tablemirror.schemas import key_list, require_columns

#: A list this short becomes an IN filter that the Parquet scan can use to skip row groups.
PUSHDOWN_KEYS = 10
#: Absent names that an error message shows at most.
_SHOWN = 10


def select_required(
    source: DataFrame,
    keys: DataFrame,
    on: str | Sequence[str] | None = None,
    validate: bool = True,
) -> DataFrame:
    """Rows of ``source`` named by ``keys``; raise if any named row is absent.

    ``on`` defaults to all columns of ``keys``. With ``validate=False`` the check
    for absent rows, and its job, is left out.
    """
    on, names, stats = _names(source, keys, on)
    if validate:
        _refuse_absent(source, names, on, stats)
    return _named(source, names, on, stats)


def required_names(
    source: DataFrame, keys: DataFrame, on: str | Sequence[str], validate: bool
) -> tuple[DataFrame, KeyStats]:
    """The list that ``select_required`` uses, and its size."""
    on, names, stats = _names(source, keys, on)
    if validate:
        _refuse_absent(source, names, on, stats)
    return names, stats


def named_or_in_scope(
    source: DataFrame,
    names: DataFrame,
    on: list[str],
    stats: KeyStats,
    prefixes: list[str],
    column: str,
) -> DataFrame:
    """Source rows that are named or lie under a prefix, in one pass over the source."""
    if not prefixes:
        return _named(source, names, on, stats)
    values = _short_list(source, names, on, stats)
    inside = F.coalesce(under(prefixes, column), F.lit(False))
    if values is not None:
        return source.filter(F.col(on[0]).isin(values) | inside)
    listed = names.distinct().withColumn("__named", F.lit(True))
    found = source.join(F.broadcast(listed) if stats.small else listed, on, "left")
    kept = found.filter(F.coalesce("__named", F.lit(False)) | inside)
    return kept.select(*source.columns)


def _refuse_absent(source: DataFrame, names: DataFrame, on: list[str], stats: KeyStats) -> None:
    absent = _absent(source, names, on, stats).limit(_SHOWN + 1).collect()
    if absent:
        shown = ", ".join(str(tuple(r)) for r in absent[:_SHOWN])
        shown += " and more" if len(absent) > _SHOWN else ""
        raise MissingKeysError(f"required rows are absent from the source: {shown}")


def missing_required(
    source: DataFrame, keys: DataFrame, on: str | Sequence[str] | None = None
) -> DataFrame:
    """Named keys that ``source`` lacks."""
    on, names, stats = _names(source, keys, on)
    return _absent(source, names, on, stats)


def _names(
    source: DataFrame, keys: DataFrame, on: str | Sequence[str] | None
) -> tuple[list[str], DataFrame, KeyStats]:
    on = key_list(keys.columns if on is None else on)
    require_columns(keys, on)
    require_columns(source, on)
    for c in on:
        s, k = (df.schema[c].dataType.simpleString() for df in (source, keys))
        if s != k:
            raise SchemaError(f"key column {c}: source {s}, required list {k}")
    names = keys.select(*on)
    # A short list is read once: what was seen is what is used, here and in every later job.
    short = names.limit(PUSHDOWN_KEYS + 1).collect()
    if len(short) <= PUSHDOWN_KEYS:
        names = source.sparkSession.createDataFrame(short, names.schema)
    return on, names, key_stats(names, on)


def _short_list(source: DataFrame, names: DataFrame, on: list[str], stats: KeyStats) -> list | None:
    """The names as values for an IN filter, if they are few and of one plain type."""
    if len(on) > 1 or stats.rows > PUSHDOWN_KEYS:
        return None
    if not isinstance(source.schema[on[0]].dataType, (T.StringType, T.IntegralType)):
        return None
    return [r[0] for r in names.collect() if r[0] is not None]


def _named(source: DataFrame, names: DataFrame, on: list[str], stats: KeyStats) -> DataFrame:
    values = _short_list(source, names, on, stats)
    if values is not None:
        return source.filter(F.col(on[0]).isin(values))
    return source.join(F.broadcast(names) if stats.small else names, on, "left_semi")


def _absent(source: DataFrame, names: DataFrame, on: list[str], stats: KeyStats) -> DataFrame:
    """Anti join of the names against the source.

    A short list is first looked up in the source, where it can be broadcast, so
    that the source is scanned in place and only its hits are shuffled.
    """
    if not stats.small:
        # distinct on both sides: a name or a source key that is repeated often stays one row
        return names.distinct().join(source.select(*on).distinct(), on, "left_anti")
    present = _named(source.select(*on), names, on, stats).distinct()
    return names.distinct().join(F.broadcast(present), on, "left_anti")

"""Putting source rows into a target: with and without deletions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemirror.errors import EmptySourceError
from tablemirror.operators.keys import check_sides, key_stats, split_stats
from tablemirror.operators.membership import without_keys
from tablemirror.operators.scope import (
    check_prefixes,
    check_scope_column,
    in_scope,
    out_of_scope,
    prefix_of,
    require_scope_key,
)
from tablemirror.schemas import check_same_schema, has_wide_payload, key_list


def upsert(
    source: DataFrame,
    target: DataFrame,
    keys: str | Sequence[str],
    validate: bool | str = True,
) -> DataFrame:
    """All of ``source``, plus the target rows whose key is not in it."""
    keys = key_list(keys)
    check_same_schema(source, target)
    stats = check_sides(source, target, keys, validate).get("source") or key_stats(source, keys)
    return without(target, source, keys, stats.small).unionByName(source)


def mirror(
    source: DataFrame,
    target: DataFrame,
    prefix: str | Sequence[str],
    column: str = "path",
    allow_empty_source: bool = True,
    keys: str | Sequence[str] | None = None,
    validate: bool | str = True,
) -> DataFrame:
    """The target with everything under ``prefix`` replaced by the source's rows there.

    Two filters and a union: nothing is shuffled. A scope that is empty in the
    source is emptied in the result; ``allow_empty_source=False`` raises instead.
    The keys, by default ``column`` alone, are checked first as in ``upsert``; ``column`` must
    be one of them, so that no row can change its scope.
    """
    prefixes = check_prefixes(prefix)
    check_same_schema(source, target)
    check_scope_column(source, column)
    keys = [column] if keys is None else key_list(keys)
    require_scope_key(column, keys)
    check_sides(source, target, keys, validate)
    if not allow_empty_source:
        refuse_empty(source, prefixes, column)
    return out_of_scope(target, prefixes, column).unionByName(in_scope(source, prefixes, column))


def without(
    target: DataFrame, source: DataFrame, keys: Sequence[str], small: bool
) -> DataFrame:
    """Target rows whose key is not in ``source``, with as little of them shuffled as can be.

    ``small`` says that the source's keys were measured and may be broadcast. If they
    may not, the keys of both sides meet first, without the payload: where
    either the rows to drop or the rows to keep turn out to be few, those are
    broadcast and the target is read in place. If both are many, but most rows stay, a table of
    bits (``without_keys``) keeps most of these out of the shuffle. All of the target is
    shuffled only otherwise, or if its payload is no wider than keys are.
    """
    keys = list(keys)
    gone = source.select(*keys)
    if small:
        return target.join(F.broadcast(gone), keys, "left_anti")
    if not has_wide_payload(target, keys):
        return target.join(gone, keys, "left_anti")
    hits, rest = split_stats(target, gone, keys)
    mine = target.select(*keys)
    if hits.small:
        return target.join(F.broadcast(mine.join(gone, keys, "left_semi")), keys, "left_anti")
    if rest is not None and rest.small:
        return target.join(F.broadcast(mine.join(gone, keys, "left_anti")), keys, "left_semi")
    if rest is not None and 2 * hits.rows <= rest.rows:
        return without_keys(target, gone, keys)
    return target.join(gone, keys, "left_anti")


def refuse_empty(source: DataFrame, prefixes: Sequence[str], column: str) -> None:
    found = in_scope(source, prefixes, column).select(prefix_of(prefixes, column).alias("prefix"))
    hits = {row["prefix"] for row in found.distinct().collect()}  # no more than there are prefixes
    empty = [p for p in prefixes if p not in hits]
    if empty:
        raise EmptySourceError(f"the source has no row under {', '.join(empty)}")

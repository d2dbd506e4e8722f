"""Scopes: the rows whose path starts with a prefix such as ``reports/``."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemirror.errors import RuleError, SchemaError
from tablemirror.schemas import require_columns


def in_scope(df: DataFrame, prefix: str | Sequence[str], column: str = "path") -> DataFrame:
    """Rows under ``prefix``; the filter reaches the Parquet scan."""
    prefixes = check_prefixes(prefix)
    check_scope_column(df, column)
    return df.filter(under(prefixes, column))


def out_of_scope(df: DataFrame, prefix: str | Sequence[str], column: str = "path") -> DataFrame:
    """Every other row, those with a null path included."""
    prefixes = check_prefixes(prefix)
    check_scope_column(df, column)
    return df.filter(F.col(column).isNull() | ~under(prefixes, column))


#: Scope of the files that lie at the top, outside every folder.
TOP = "."
#: Lists up to this length become one prefix test each, which Parquet scans understand best.
_PUSHDOWN_PREFIXES = 16


def scope_of(column: str = "path", prefixes: Sequence[str] = ()) -> Column:
    """Scope of a path: the longest of ``prefixes`` that it lies under, or its first step.

    Both come without their last slash; prefixes may lie inside each other. Paths without
    a slash share the scope ``.``.
    """
    path = F.col(column)
    first = F.when(F.contains(path, F.lit("/")), F.substring_index(path, "/", 1)).otherwise(
        F.when(path.isNotNull(), TOP)
    )
    if not prefixes:
        return first
    for p in prefixes:
        _require_slash(p)
    longest = F.lit(None).cast("string")
    for length, same in sorted(_by_length(prefixes).items(), reverse=True):
        head = F.left(path, F.lit(length))
        longest = F.coalesce(longest, F.when(head.isin(same), F.left(path, F.lit(length - 1))))
    return F.coalesce(longest, first)


def under(prefixes: Sequence[str], column: str) -> Column:
    """Whether the path lies under one of the prefixes.

    Long lists become one set test per length of prefix, together with the range of paths
    that all of them lie in, which a Parquet scan can use; the result is the same.
    """
    path = F.col(column)
    if len(prefixes) <= _PUSHDOWN_PREFIXES:
        return reduce(or_, [path.startswith(p) for p in prefixes])
    tests = [F.left(path, F.lit(n)).isin(same) for n, same in _by_length(prefixes).items()]
    # a prefix ends in a slash, so what lies under it sorts before the same with a "0"
    inside = (path >= min(prefixes)) & (path < max(p[:-1] + "0" for p in prefixes))
    return inside & reduce(or_, tests)


def prefix_of(prefixes: Sequence[str], column: str) -> Column:
    """The prefix that the path lies under, of prefixes that do not overlap; null for none."""
    path = F.col(column)
    return F.coalesce(*[
        F.when(F.left(path, F.lit(n)).isin(same), F.left(path, F.lit(n)))
        for n, same in _by_length(prefixes).items()
    ])


def _by_length(prefixes: Sequence[str]) -> dict[int, list[str]]:
    found = defaultdict(list)
    for p in prefixes:
        found[len(p)].append(p)
    return found


def _require_slash(prefix: str) -> None:
    if not prefix.endswith("/"):
        raise RuleError(f"prefix {prefix!r} must end with a slash")


def check_prefixes(prefix: str | Sequence[str]) -> list[str]:
    prefixes = [prefix] if isinstance(prefix, str) else list(prefix)
    if not prefixes:
        raise RuleError("at least one prefix is needed")
    for p in prefixes:
        _require_slash(p)
    ordered = sorted(prefixes)
    for a, b in zip(ordered, ordered[1:]):
        if b.startswith(a):
            raise RuleError(f"prefixes {a!r} and {b!r} overlap")
    return prefixes


def check_scope_column(df: DataFrame, column: str) -> None:
    require_columns(df, [column])
    if not isinstance(df.schema[column].dataType, T.StringType):
        raise SchemaError(f"scope column {column} must be a string")


def require_scope_key(column: str, keys: Sequence[str]) -> None:
    if column not in keys:
        raise RuleError(f"scope column {column} must be a key column")

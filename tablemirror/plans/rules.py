"""An ordered list of rules applied to one target as a single query."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame

from tablemirror.errors import RuleError
from tablemirror.operators.keys import check_sides, fits_broadcast, key_stats
from tablemirror.operators.merge import refuse_empty, without
from tablemirror.operators.required import named_or_in_scope, required_names
from tablemirror.operators.scope import (
    check_prefixes,
    check_scope_column,
    in_scope,
    out_of_scope,
    require_scope_key,
)
from tablemirror.schemas import check_same_schema, key_list

UPSERT, MIRROR = "upsert", "mirror"


class Rule(NamedTuple):
    seq: int
    prefix: str
    mode: str


def load_rules(table: DataFrame) -> list[Rule]:
    """Rules from a control table with columns ``seq, prefix, mode``.

    The driver holds the list and every plan carries its prefixes.
    """
    return check_rules([Rule(*r) for r in table.select("seq", "prefix", "mode").collect()])


def check_rules(rules: Sequence[Rule | tuple[int, str, str]]) -> list[Rule]:
    """The rules in order; raise on an unknown mode, a bad prefix or an overlap."""
    rules = sorted(Rule(*r) for r in rules)
    for rule in rules:
        if rule.mode not in (UPSERT, MIRROR):
            raise RuleError(f"rule {rule.seq}: unknown mode {rule.mode!r}")
    if len({rule.seq for rule in rules}) < len(rules):
        raise RuleError("two rules share one seq")
    if rules:
        check_prefixes([rule.prefix for rule in rules])
    return rules


def run_plan(
    source: DataFrame,
    target: DataFrame,
    keys: str | Sequence[str],
    rules: Sequence[Rule | tuple[int, str, str]],
    required: DataFrame | None = None,
    column: str = "path",
    allow_empty_source: bool = True,
    validate: bool | str = True,
) -> DataFrame:
    """Upsert the ``required`` rows, then apply the prefix rules in order.

    The prefixes may not overlap, so the order of the rules cannot be seen in the
    result and the whole list becomes one query. Let M, U be the rows under the
    mirror and upsert prefixes and R the required rows:

        result = source rows in M, U or R
               + target rows outside M whose key is not among those source rows

    Incoming keys that are few are broadcast and the target is read in place. If
    they are many, only the target rows under an upsert prefix are shuffled to meet
    them; rows that no rule touches pass through. ``column`` carries the path and
    must be one of the keys, so that no row can change its scope.
    """
    keys = key_list(keys)
    rules = check_rules(rules)
    check_same_schema(source, target)
    check_scope_column(source, column)
    require_scope_key(column, keys)
    mirrored = [r.prefix for r in rules if r.mode == MIRROR]
    upserted = [r.prefix for r in rules if r.mode == UPSERT]
    checked = check_sides(source, target, keys, validate).get("source")
    if mirrored and not allow_empty_source:
        refuse_empty(source, mirrored, column)

    scopes = mirrored + upserted
    rest = _outside(target, mirrored, column)
    incoming, arriving, sizes = [], [], []
    if upserted:
        fresh = in_scope(source, upserted, column).select(*keys)
        # The keys of the whole source bound those of any part of it.
        size = checked if checked and checked.small else key_stats(fresh, keys)
        arriving.append(fresh)
        sizes.append(size)
    if required is not None:
        if set(required.columns) != set(keys):
            raise RuleError(f"the required list must have the key columns {', '.join(keys)}")
        names, size = required_names(source, required, keys, bool(validate))
        # What arrives is bounded by the list, however often the source repeats a key.
        listed = _outside(names, scopes, column)
        if not validate:
            listed = listed.join(source.select(*keys).distinct(), keys, "left_semi")
        arriving.append(listed.select(*keys).distinct())
        sizes.append(size)
        incoming.append(named_or_in_scope(source, names, keys, size, scopes, column))
    elif scopes:
        incoming.append(in_scope(source, scopes, column))

    if not arriving:
        kept = rest
    elif fits_broadcast(*sizes):
        kept = without(rest, reduce(DataFrame.union, arriving), keys, True)
    else:
        kept = _outside(rest, upserted, column)
        if required is not None:
            kept = without(kept, arriving[-1], keys, sizes[-1].small)
        if upserted:
            touched = in_scope(rest, upserted, column)
            kept = kept.unionByName(without(touched, arriving[0], keys, sizes[0].small))
    return reduce(DataFrame.unionByName, incoming, kept)


def _outside(df: DataFrame, prefixes: list[str], column: str) -> DataFrame:
    return out_of_scope(df, prefixes, column) if prefixes else df

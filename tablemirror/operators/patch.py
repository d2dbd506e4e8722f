"""Change sets as tables: made from two snapshots, applied to a third, put together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemirror.errors import PatchError, SchemaError
from tablemirror.functions.digest import content_digest, is_wide_type
from tablemirror.operators.diff import ADDED, DELETED, DIGEST_SUFFIX, MODIFIED
from tablemirror.operators.keys import check_sides, checked_key_stats, key_stats
from tablemirror.operators.merge import without
from tablemirror.schemas import check_comparable, check_same_schema, key_list, require_columns

#: Columns of a patch beside its keys: what happens to a row, its digest before and after, and
#: its new content. ``before`` is null for an added row, ``after`` and ``row`` for a deleted one.
CHANGE, BEFORE, AFTER, ROW = "change", "before", "after", "row"
_OWN = [CHANGE, BEFORE, AFTER, ROW]


def make_patch(
    source: DataFrame,
    target: DataFrame,
    keys: str | Sequence[str],
    validate: bool | str = True,
) -> DataFrame:
    """The changes that turn ``target`` into ``source``: ``keys, change, before, after, row``.

    Only keys and 16-byte digests of both sides meet in the comparison; the new content is then
    fetched for the changed rows alone, with their keys broadcast where Spark finds them small.
    Stored digests of a version read ``with_digests`` spare reading its wide columns.
    """
    keys = key_list(keys)
    _check_names(source, keys)
    plain = [c for c in source.columns if not c.endswith(DIGEST_SUFFIX)]
    ignored = [c for c in {*source.columns, *target.columns} if c.endswith(DIGEST_SUFFIX)]
    check_same_schema(source, target, ignore=ignored)
    payload = [c for c in plain if c not in keys]
    check_comparable(source, [c for c in payload if not is_wide_type(source.schema[c].dataType)])
    check_sides(source, target, keys, validate)

    def narrow(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, content_digest(df, payload, DIGEST_SUFFIX).alias(name))

    both = narrow(source, AFTER).join(narrow(target, BEFORE), keys, "full_outer")
    changed = both.filter(~F.col(BEFORE).eqNullSafe(F.col(AFTER))).withColumn(CHANGE, _change())
    arriving = changed.filter(F.col(CHANGE) != DELETED).select(*keys, CHANGE, BEFORE, AFTER)
    content = source.select(*keys, F.struct(*payload).alias(ROW) if payload else F.struct(F.lit(True).alias("present")).alias(ROW))
    arriving = arriving.join(content, keys)
    leaving = changed.filter(F.col(CHANGE) == DELETED).select(
        *keys, CHANGE, BEFORE, AFTER, F.lit(None).cast(arriving.schema[ROW].dataType).alias(ROW)
    )
    return arriving.unionByName(leaving)


def apply_patch(
    target: DataFrame, patch: DataFrame, keys: str | Sequence[str] | None = None, validate: bool = True
) -> DataFrame:
    """``target`` with the changes of ``patch``, or ``PatchError`` if it was made for other rows.

    Every row that the patch replaces or deletes must be there with the digest that the patch
    remembers, and none that it adds may be there. The check is one job over keys and
    digests, with one example brought back; ``validate=False`` leaves it out. Target rows stay in
    place where the patch's keys are few (see ``upsert``).
    """
    keys = patch_keys(patch) if keys is None else key_list(keys)
    payload = check_patch(target, patch, keys)
    size = checked_key_stats(keys, patch=patch)["patch"] if validate else key_stats(patch, keys)
    if validate:
        refuse_conflict(target, patch, keys, payload, size.small)
    rows = patch.filter(F.col(CHANGE) != DELETED).select(*keys, *[F.col(f"{ROW}.{c}").alias(c) for c in payload])
    plain = target.select(*[c for c in target.columns if not c.endswith(DIGEST_SUFFIX)])
    return without(plain, patch, keys, size.small).unionByName(rows)


def compose_patches(
    first: DataFrame, second: DataFrame, keys: str | Sequence[str] | None = None
) -> DataFrame:
    """One patch that does what ``first`` and then ``second`` do.

    A row that both touch keeps the digest that the first remembers and gets the content of
    the second; what the second undoes is gone. Where the second does not continue the first (its
    digest of a row is not the one the first left), any job that reads the result fails.
    """
    keys = patch_keys(first) if keys is None else key_list(keys)
    check_same_schema(first, second)
    require_columns(first, [*keys, *_OWN])

    def side(df: DataFrame, mark: str) -> DataFrame:
        return df.select(*keys, *[F.col(c).alias(f"__{mark}_{c}") for c in _OWN], F.lit(True).alias(f"__{mark}"))

    def of(mark: str, column: str):
        return F.col(f"__{mark}_{column}")

    joined = side(first, "f").join(side(second, "s"), keys, "full_outer")
    both = F.col("__f").isNotNull() & F.col("__s").isNotNull()
    broken = both & ~of("f", AFTER).eqNullSafe(of("s", BEFORE))
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    fault = F.raise_error(F.concat(F.lit("patches do not follow each other at "), key))
    later = F.col("__s").isNotNull()
    out = joined.select(
        *keys,
        F.when(broken, fault.cast("binary"))
        .when(F.col("__f").isNotNull(), of("f", BEFORE)).otherwise(of("s", BEFORE)).alias(BEFORE),
        F.when(later, of("s", AFTER)).otherwise(of("f", AFTER)).alias(AFTER),
        F.when(later, of("s", ROW)).otherwise(of("f", ROW)).alias(ROW),
    )
    kept = out.filter(~F.col(BEFORE).eqNullSafe(F.col(AFTER)))
    return kept.select(*keys, _change().alias(CHANGE), BEFORE, AFTER, ROW)


def patch_keys(patch: DataFrame) -> list[str]:
    require_columns(patch, _OWN)
    return [c for c in patch.columns if c not in _OWN]


def check_patch(target: DataFrame, patch: DataFrame, keys: list[str]) -> list[str]:
    """The columns of the target outside its keys; raise if the patch has others."""
    _check_names(target, keys)
    require_columns(patch, [*keys, *_OWN])
    payload = [c for c in target.columns if c not in keys and not c.endswith(DIGEST_SUFFIX)]
    inside = patch.schema[ROW].dataType
    have = {f.name: f.dataType.simpleString() for f in inside.fields} if isinstance(inside, T.StructType) else {}
    if not payload:
        have.pop("present", None)
    want = {c: target.schema[c].dataType.simpleString() for c in payload}
    have |= {c: patch.schema[c].dataType.simpleString() for c in keys}
    want |= {c: target.schema[c].dataType.simpleString() for c in keys}
    if have != want:
        raise SchemaError(f"the patch was made for other columns: {have}, not {want}")
    return payload


def refuse_conflict(
    target: DataFrame, patch: DataFrame, keys: list[str], payload: list[str], small: bool
) -> None:
    """One job: raise ``PatchError`` if the target's rows are not those the patch was made for."""
    asked = patch.select(*keys, CHANGE, BEFORE)
    wanted = F.broadcast(asked.select(*keys)) if small else asked.select(*keys)
    found = target.join(wanted, keys, "left_semi")
    found = found.select(*keys, content_digest(found, payload, DIGEST_SUFFIX).alias("__now"))
    # null-safe: before is null for rows that must not be there
    bad = asked.join(found, keys, "left").filter(~F.col(BEFORE).eqNullSafe(F.col("__now")))
    example = bad.select(*keys, CHANGE, F.col("__now").isNull().alias("absent")).limit(1).collect()
    if example:
        row = example[0].asDict()
        absent = row.pop("absent")
        state = "absent" if absent else "already there" if row[CHANGE] == ADDED else "another row"
        raise PatchError(f"the patch has another parent: {row} is {state} in the target")


def _change():
    return (
        F.when(F.col(BEFORE).isNull(), ADDED).when(F.col(AFTER).isNull(), DELETED).otherwise(MODIFIED)
    )


def _check_names(df: DataFrame, keys: list[str]) -> None:
    require_columns(df, keys)
    taken = [k for k in keys if k in _OWN]
    if taken:
        raise SchemaError(f"key columns cannot be named {', '.join(taken)}")

"""What changed between two snapshots, and how much."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemirror.errors import SchemaError
from tablemirror.functions.digest import digest_bytes, is_wide_type, wide_columns
from tablemirror.operators.keys import check_sides, unique_row
from tablemirror.schemas import (
    check_comparable,
    check_same_schema,
    key_list,
    require_columns,
)

ADDED, DELETED, MODIFIED, UNCHANGED = "added", "deleted", "modified", "unchanged"
#: Value of ``validate``: check keys within the job that compares.
INLINE = "inline"
#: A stored digest of column ``c`` is named ``c__sha256``.
DIGEST_SUFFIX = "__sha256"


def diff(
    source: DataFrame,
    target: DataFrame,
    keys: str | Sequence[str],
    compare: Sequence[str] | None = None,
    keep_unchanged: bool = False,
    digest: Sequence[str] | None = None,
    validate: bool | str = True,
) -> DataFrame:
    """Key columns plus ``change``: added, deleted, modified or unchanged.

    ``compare`` lists the columns that count as content, by default all but the
    keys. Columns in ``digest`` are reduced to 32 bytes where they are read, so that wide
    values never enter the shuffle: by default all columns of text, bytes, and arrays or
    structs of fixed-width types; ``digest=[]`` compares all by value. If a side holds the
    digest as ``<column>__sha256``, the value is not read at all (where both sides hold one,
    name the column: such columns may be content of their own). All other columns are
    compared by value with ``<=>``.

    ``validate="source"`` leaves out the key check of the target, ``False`` that of both
    sides; a repeated key then multiplies rows. ``validate="inline"`` checks both sides
    within the shuffle and sort of the comparison itself: no job runs now and none is added,
    and a null or repeated key fails the job that reads the result. It is the cheaper check
    where keys are all but sure. The trade: a key repeated very often then gathers in one
    task before it fails, while the default counts before it shuffles.
    """
    keys = key_list(keys)
    require_columns(source, keys)
    wide = _wide_columns(source, target, keys, compare, digest)
    stored = [c + DIGEST_SUFFIX for c in wide]
    check_same_schema(source, target, ignore=stored)
    if compare is None:
        compare = [c for c in source.columns if c not in keys and c not in stored]
    require_columns(source, compare)
    if "change" in keys:
        raise SchemaError("a key column cannot be named change")
    overlap = [c for c in compare if c in keys]
    if overlap:
        raise SchemaError(f"key columns cannot be compared as content: {', '.join(overlap)}")
    check_comparable(source, [c for c in compare if c not in wide])
    if validate != INLINE:
        check_sides(source, target, keys, validate)

    def narrowed(df: DataFrame, side: str) -> DataFrame:
        content = [_content(df, c, wide).alias(f"__{side[0]}_{i}") for i, c in enumerate(compare)]
        rows, here = df.select(*keys, *content), f"__{side[0]}_here"
        if validate == INLINE:
            return unique_row(rows, keys, side, here)
        return rows.withColumn(here, F.lit(True))

    differs = reduce(
        or_,
        [~F.col(f"__s_{i}").eqNullSafe(F.col(f"__t_{i}")) for i in range(len(compare))],
        F.lit(False),
    )
    # Each branch reads the flag of its own side, which may carry an inline key check.
    change = (
        F.when(F.col("__t_here").isNull() & F.col("__s_here"), ADDED)
        .when(F.col("__s_here").isNull() & F.col("__t_here"), DELETED)
        .when(differs, MODIFIED)
        .otherwise(UNCHANGED)
    )
    out = narrowed(source, "source").join(narrowed(target, "target"), keys, "full_outer")
    out = out.select(*keys, change.alias("change"))
    return out if keep_unchanged else out.filter(F.col("change") != UNCHANGED)


def change_summary(
    changes: DataFrame, by: Sequence[str | Column] | str | Column | None = None
) -> DataFrame:
    """Count ``n`` of each ``change``, optionally per value of ``by``."""
    if by is None:
        by = []
    elif isinstance(by, (str, Column)):
        by = [by]
    counted = changes.groupBy(*by, "change").agg(F.count("*").alias("__n"))
    if "n" in counted.columns:
        raise SchemaError("a summary cannot be by a column named n, as the count is")
    return counted.withColumnRenamed("__n", "n")


def _wide_columns(
    df: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None,
    digest: Sequence[str] | None,
) -> list[str]:
    if digest is None:
        return [
            c
            for c in wide_columns(df, keys)
            if not c.endswith(DIGEST_SUFFIX)
            and (compare is None or c in compare)
            # on both sides it may be content that only looks like a digest
            and not (c + DIGEST_SUFFIX in df.columns and c + DIGEST_SUFFIX in other.columns)
        ]
    require_columns(df, digest)
    for c in digest:
        if c in keys or not is_wide_type(df.schema[c].dataType):
            raise SchemaError(f"column {c} cannot be compared by digest")
    return list(digest)


def _content(df: DataFrame, column: str, wide: Sequence[str]) -> Column:
    if column not in wide:
        return F.col(column)
    if column + DIGEST_SUFFIX in df.columns:
        return F.col(column + DIGEST_SUFFIX)
    return digest_bytes(column, df.schema[column].dataType)

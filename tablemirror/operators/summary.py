"""One digest for all rows of a table, or of each of its scopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemirror.errors import SchemaError
from tablemirror.functions.digest import content_digest, digest_sum
from tablemirror.schemas import key_list, require_columns


def scope_digest(
    df: DataFrame,
    by: Sequence[str | Column] | str | Column | None = None,
    cols: str | Sequence[str] | None = None,
) -> DataFrame:
    """``by`` columns, ``n`` and ``digest``: row count and order-free digest of the rows.

    Two tables have equal digests where they hold the same rows equally often, in whatever
    order and partitioning. ``cols`` are the columns that count as content, by default all. The
    digests of disjoint parts add up to that of the whole, and one row more or less moves it by
    that row's digest. One aggregate that combines before its shuffle, so a scope that
    holds most of the rows is no hot key. A table without rows has the digest of zeros, if there is
    no ``by``.
    """
    cols = df.columns if cols is None else key_list(cols)
    require_columns(df, cols)
    by = [] if by is None else [by] if isinstance(by, (str, Column)) else list(by)
    named = [F.col(c) if isinstance(c, str) else c for c in by]
    rows = df.select(*named, content_digest(df, cols).alias("__digest"))
    names = rows.columns[:-1]
    if {"n", "digest"} & set(names):
        raise SchemaError("a digest cannot be by a column named n or digest")
    out = rows.groupBy(*names).agg(
        F.count("*").alias("n"), digest_sum(F.col("__digest")).alias("digest")
    )
    return out if names else out.withColumn("digest", F.coalesce("digest", F.lit("0" * 32)))

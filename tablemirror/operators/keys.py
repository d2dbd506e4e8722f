"""Key checks, and the size check that decides on a broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemirror.errors import KeyCheckError, SchemaError
from tablemirror.schemas import check_comparable, key_list, require_columns

#: Setting: key sets measured at or below this many bytes are broadcast, larger ones shuffle.
BROADCAST_SETTING = "spark.tablemirror.broadcastBytes"
BROADCAST_DEFAULT = 64 * 1024 * 1024
_ROW_OVERHEAD = 32


class KeyStats(NamedTuple):
    rows: int
    bytes: int
    limit: int

    @property
    def small(self) -> bool:
        return fits_broadcast(self)


def fits_broadcast(*sizes: KeyStats) -> bool:
    return sum(size.bytes for size in sizes) <= min(size.limit for size in sizes)


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``n``."""
    keys = _checked(df, keys)
    if "n" in keys:
        raise SchemaError("a key column cannot be named n here, as the count is")
    counted = df.groupBy(*keys).agg(F.count("*").alias("__n")).filter(F.col("__n") > 1)
    return counted.withColumnRenamed("__n", "n")


def null_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows with a null in any key column."""
    keys = _checked(df, keys)
    return df.filter(any_null(keys))


def check_keys(df: DataFrame, keys: str | Sequence[str]) -> None:
    """Raise ``KeyCheckError`` if a key is null or not unique."""
    checked_key_stats(keys, rows=df)


def checked_key_stats(keys: str | Sequence[str], **sides: DataFrame) -> dict[str, KeyStats]:
    """``check_keys`` and ``key_stats`` of several tables in one job.

    Each table is aggregated on its own, so that one bucketed by its keys needs no
    shuffle, and the stages run side by side. Counting combines on the map side: a key
    that holds a third of all rows still sends one row per task. The driver sees one
    row per table.
    """
    found = reduce(DataFrame.union, [_key_report(df, keys, side) for side, df in sides.items()])
    stats = {}
    limit = broadcast_limit(found)
    for row in found.collect():
        if row["bad"] is not None:
            example = row["bad"]["key"].asDict()
            fault = "null key" if None in example.values() else "duplicate key"
            raise KeyCheckError(f"{row['side']}: {fault} {example}, {row['bad']['n']} rows")
        stats[row["side"]] = KeyStats(row["rows"] or 0, row["bytes"] or 0, limit)
    return stats


def check_sides(
    source: DataFrame,
    target: DataFrame,
    keys: str | Sequence[str],
    validate: bool | str,
) -> dict[str, KeyStats]:
    """Check what ``validate`` asks for: True both, ``"source"`` the source only, False none.

    A target that was read from a store has been checked when it was published.
    """
    if validate not in (True, False, "source"):
        raise KeyCheckError(f"validate must be True, False or 'source', not {validate!r}")
    if not validate:
        return {}
    if validate == "source":
        return checked_key_stats(keys, source=source)
    return checked_key_stats(keys, source=source, target=target)


def unique_row(df: DataFrame, keys: Sequence[str], side: str, name: str) -> DataFrame:
    """Add column ``name``: true, or an error in any job that reads these rows if a key is unfit.

    A null key fails where it is read. Counting the rows of a key asks for the same
    partitioning and order as a sort-merge join by that key, so the check adds neither a
    shuffle nor a sort in front of one. Rows are filtered by the flag, so that no plan can
    leave it out, whatever columns are asked for.
    """

    def fails(fault: str) -> Column:
        key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
        return F.raise_error(F.concat(F.lit(f"{side}: {fault} "), key))

    named = F.when(any_null(keys), fails("null key").cast("boolean")).otherwise(True)
    n = F.count("*").over(Window.partitionBy(*keys))
    alone = F.when(n == 1, F.col(name)).otherwise(fails("duplicate key").cast("boolean"))
    return df.withColumn(name, named).withColumn(name, alone).filter(F.col(name))


def _key_report(df: DataFrame, keys: str | Sequence[str], side: str) -> DataFrame:
    keys = _checked(df, keys)
    n = F.col("__n")
    bad = (n > 1) | any_null(keys)
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("__n"))
        .agg(
            F.lit(side).alias("side"),
            F.sum(n).alias("rows"),
            F.sum(n * key_width(df, keys)).alias("bytes"),
            F.min(F.when(bad, F.struct(F.struct(*keys).alias("key"), n.alias("n")))).alias("bad"),
        )
    )


def key_stats(df: DataFrame, keys: str | Sequence[str]) -> KeyStats:
    """Row count and key bytes, from a scan of the key columns without a shuffle of rows."""
    keys = _checked(df, keys)
    found = df.agg(F.count("*").alias("rows"), F.sum(key_width(df, keys)).alias("bytes")).first()
    return KeyStats(found["rows"], found["bytes"] or 0, broadcast_limit(df))


def split_stats(
    df: DataFrame, other: DataFrame, keys: Sequence[str]
) -> tuple[KeyStats, KeyStats | None]:
    """Sizes of the keys of ``df`` that ``other`` has and lacks, from a join of keys alone.

    The second is None if ``df`` has a null key, which no equality join can find again.
    """
    keys = list(keys)
    width, unfit = key_width(df, keys).alias("__width"), any_null(keys).alias("__unfit")
    mine = df.select(*keys, width, unfit)
    theirs = other.select(*keys, F.lit(True).alias("__hit"))
    hit = F.coalesce("__hit", F.lit(False))
    found = (
        mine.join(theirs, keys, "left")
        .agg(
            F.count_if(hit).alias("hits"),
            F.sum(F.when(hit, F.col("__width"))).alias("hit_bytes"),
            F.count_if(~hit).alias("rest"),
            F.sum(F.when(~hit, F.col("__width"))).alias("rest_bytes"),
            F.max("__unfit").alias("unfit"),
        )
        .first()
    )
    limit = broadcast_limit(df)
    hits = KeyStats(found["hits"], found["hit_bytes"] or 0, limit)
    rest = KeyStats(found["rest"], found["rest_bytes"] or 0, limit)
    return hits, None if found["unfit"] else rest


def _checked(df: DataFrame, keys: str | Sequence[str]) -> list[str]:
    keys = key_list(keys)
    if not keys:
        raise KeyCheckError("at least one key column is needed")
    require_columns(df, keys)
    check_comparable(df, keys)
    return keys


def broadcast_limit(df: DataFrame) -> int:
    """Bytes that may be broadcast, as set in the session."""
    return int(df.sparkSession.conf.get(BROADCAST_SETTING, str(BROADCAST_DEFAULT)))


def any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def key_width(df: DataFrame, keys: Sequence[str]) -> Column:
    """Bytes one key row takes in a hashed relation, at least."""

    def one(key: str) -> Column:
        dt, col = df.schema[key].dataType, F.col(key)
        if isinstance(dt, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(col), F.lit(0)) + 8
        if isinstance(dt, (T.ArrayType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0)) * 4 + 8
        return F.lit(16)

    return reduce(add, [one(k) for k in keys], F.lit(_ROW_OVERHEAD)).cast("bigint")

"""Sharding by Hilbert-curve order (operator 6).

Several metadata columns are quantised to equally filled cells, the cells become one index
on a Hilbert curve, rows are sorted by that index, and the sorted run is cut into shards
whose row counts differ by one at most. A shard then covers a compact box of metadata, so a
reader that filters on any of the columns skips most shards by their least and greatest
values.

Defined results: nulls fill a cell of their own, below all values; ties (equal metadata) are
ordered by id, then checksum; wholly equal rows take neighbouring places in either order; an
empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemirror.llm.common import ship, stored

#: Bits per dimension: cells = 2 ** (BITS * dimensions).
BITS = 8
_PREFIX = 6  # characters behind the common prefix that order a text


def hilbert_index(cells: list[np.ndarray], bits: int) -> np.ndarray:
    """Place on the Hilbert curve through ``2 ** bits`` cells along each axis.

    Skilling's transposition: undo the excess rotations from the highest bit down, take the
    Gray code across the axes, then interleave the bits.
    """
    x = [c.astype(np.int64).copy() for c in cells]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            turn = (x[i] & q) != 0
            swap = np.where(turn, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turn, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[n - 1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | (((x[i] ^ flip) >> b) & 1)
    return out


def _ordered_number(column: F.Column, kind: T.DataType, common: int) -> F.Column:
    """A number in the order of the column; texts by the characters behind their common prefix."""
    if isinstance(kind, T.NumericType):
        return column.cast("double")
    tail = F.rpad(F.substring(column, common + 1, _PREFIX), _PREFIX, "\0")
    code = F.lit(0.0)
    for k in range(_PREFIX):
        point = F.least(F.ascii(F.substring(tail, k + 1, 1)), F.lit(255))
        code = code * 256 + point
    return code


def hilbert_cells(df: DataFrame, dimensions: list[str], bits: int = BITS) -> DataFrame:
    """``df`` with the column ``hilbert``. Cells hold equal shares of the rows.

    The driver sees the least and greatest text of each column and ``2 ** bits - 1`` cuts.
    """
    ship(df.sparkSession)
    kinds = {c: df.schema[c].dataType for c in dimensions}
    ends = df.agg(
        *[f(F.col(c).cast("string")).alias(f"{n}_{c}") for c in dimensions for n, f in (("low", F.min), ("high", F.max))]
    ).first()
    common = {}
    for c in dimensions:
        low, high = ends[f"low_{c}"] or "", ends[f"high_{c}"] or ""
        common[c] = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
    numbers = [_ordered_number(F.col(c), kinds[c], common[c]).alias(f"_{i}") for i, c in enumerate(dimensions)]
    steps = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = df.select(*numbers).agg(
        *[F.percentile_approx(f"_{i}", steps, 10 << bits).alias(f"_{i}") for i in range(len(dimensions))]
    ).first()
    cuts = [np.unique(found[i]) if found[i] else np.array([]) for i in range(len(dimensions))]

    @F.pandas_udf("long")
    def place(*columns: pd.Series) -> pd.Series:
        cells = []
        for cut, c in zip(cuts, columns, strict=True):
            value = c.to_numpy(float)
            cell = np.minimum(np.searchsorted(cut, value, "right") + 1, (1 << bits) - 1)
            # few distinct values spread over the whole axis, so that each axis weighs alike
            cell = cell * ((1 << bits) - 1) // (len(cut) + 1)
            cells.append(np.where(np.isnan(value), 0, cell))
        return pd.Series(hilbert_index(cells, bits))

    return df.withColumn("hilbert", place(*numbers))


def ranked(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``rank``: places from 0 without gaps in the given order, over all rows.

    Range partitions are sorted and stored, which fixes them; their row counts, one row per
    partition, give each its first rank.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(
        spread.withColumn("_part", F.spark_partition_id().cast("long")).withColumn(
            "_row", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
        ),
        "ranked",
    )
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    # one narrow row per range partition
    return placed.join(F.broadcast(starts), "_part").withColumn(
        "rank", F.col("_start") + F.col("_row")
    ).drop("_part", "_row", "_start")


def shards(df: DataFrame, dimensions: list[str], order: list[str], n_shards: int, bits: int = BITS) -> DataFrame:
    """``df`` with ``hilbert``, ``shard`` (int) and ``slot`` (long, from 0 in each shard).

    ``order`` names the columns that decide between equal places on the curve.
    """
    narrow = stored(df, "metadata")
    curve = ranked(hilbert_cells(narrow, dimensions, bits), "hilbert", *order)
    total = narrow.count()
    if not total:
        return curve.select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).drop("rank")
    small, extra = divmod(total, n_shards)
    wide = extra * (small + 1)  # ranks below it lie in the shards with one row more
    rank = F.col("rank")
    shard = F.when(rank < wide, F.floor(rank / (small + 1))).otherwise(
        extra + F.floor((rank - wide) / max(small, 1))
    )
    slot = F.when(rank < wide, rank % (small + 1)).otherwise((rank - wide) % max(small, 1))
    return curve.select("*", shard.cast("int").alias("shard"), slot.cast("long").alias("slot")).drop("rank")


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard, sorted along the curve, for readers that skip by metadata."""
    df.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

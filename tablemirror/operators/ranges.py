"""Key ranges whose limits come from the keys themselves, and digest trees over them.

A key starts a new range if a hash of it is a multiple of the number of rows that a range shall
hold; a range reaches up to the next such key. So the ranges of a table depend on its keys alone:
two tables that differ in few rows have nearly the same ranges, however they came about.

A digest tree has the ranges as its leaves. Nodes of the next level begin at every start whose
hash is a multiple of ``FANOUT`` times as much, and so on; each holds the count and the order-free
digest (``digest_sum``) of the rows below it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemirror.functions.digest import digest_sum
from tablemirror.operators.keys import key_stats

#: Nodes below one node of a tree, on average.
FANOUT = 16
#: Starts that a plan may carry as values, and node ids that a descent pushes into a scan.
LISTED = 512
#: Name of the column with the start of the range that a row lies in; null before the first start.
START = "__start"


def starts_of(df: DataFrame, keys: Sequence[str], rows_per_range: int) -> DataFrame:
    """Keys of ``df`` that start a range."""
    return df.select(*keys).filter(_at_level(keys, rows_per_range, 0)).distinct()


def _at_level(keys: Sequence[str], rows_per_range: int, level: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(rows_per_range * FANOUT**level)) == 0


def with_start(df: DataFrame, keys: Sequence[str], starts: DataFrame) -> DataFrame:
    """``df`` with the struct column ``__start``: the greatest of ``starts`` not above the key.

    A binary search in built-in expressions. A few starts are values of the plan. Of more, every
    so many-th is; a row finds its part of the list so, and within the part, which a join brings
    along, its start. That list is broadcast if it was measured and may be, and is joined as
    Spark sees fit if not.
    """
    keys = list(keys)
    found = starts.select(*keys)
    # ordered here, since a plan would sort its list anew at every step of every row's search
    listed = found.orderBy(*keys).limit(LISTED + 1).collect()
    if len(listed) <= LISTED:
        return df.withColumn(START, _found(df, keys, listed))
    size = key_stats(found, keys)
    step = -(-2 * size.rows // LISTED)
    while True:
        some = found.filter(F.pmod(F.xxhash64(*keys, F.lit(1)), F.lit(step)) == 0)
        some = some.orderBy(*keys).limit(LISTED + 1).collect()
        if len(some) <= LISTED:
            break
        step *= 2
    part = "__part"
    place = _places(found, keys, some)
    lists = found.groupBy(place.alias(part)).agg(F.array_sort(F.collect_list(F.struct(*keys))).alias("__list"))
    lists = F.broadcast(lists) if size.small else lists
    joined = df.withColumn(part, _places(df, keys, some)).join(lists, part, "left")
    at = _search(F.col("__list"), F.struct(*keys), size.rows)
    return joined.withColumn(START, F.get("__list", at - 1)).drop(part, "__list")


def _list(df: DataFrame, keys: list[str], rows: list) -> Column:
    """The rows as a constant of the plan, in the order given."""
    return F.array(*[F.struct(*[F.lit(r[k]).cast(df.schema[k].dataType).alias(k) for k in keys]) for r in rows])


def _places(df: DataFrame, keys: list[str], rows: list) -> Column:
    return _search(_list(df, keys, rows), F.struct(*keys), len(rows)) if rows else F.lit(0)


def _found(df: DataFrame, keys: list[str], rows: list) -> Column:
    if not rows:
        nothing = [F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys]
        return F.when(F.lit(False), F.struct(*nothing))
    return F.get(_list(df, keys, rows), _places(df, keys, rows) - 1)


def _search(ordered: Column, key: Column, most: int) -> Column:
    """How many values of an ordered array of up to ``most`` are not above ``key``."""
    steps = [1 << k for k in reversed(range(max(1, int(most).bit_length())))]

    def further(at: Column, step: Column) -> Column:
        return F.when(F.get(ordered, at + step - 1) <= key, at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), further)


def start_id(keys: Sequence[str], column: str = START) -> Column:
    """A number for a start, that of the first range included."""
    return F.xxhash64(*[F.col(f"{column}.{k}") for k in keys], F.col(column).isNull())


def tree_over(leaves: DataFrame, keys: Sequence[str], starts: DataFrame, rows_per_range: int) -> DataFrame:
    """``level, id, parent, start, n, digest`` of every node, from ``__start, n, digest`` of the leaves.

    The last level is the first one with at most ``FANOUT`` starts.
    """
    keys = list(keys)
    level, nodes, out = 0, leaves.select(START, F.col("n").alias("__n"), F.col("digest").alias("__digest")), None
    while True:
        top = starts.limit(FANOUT + 1).count() <= FANOUT
        higher = starts.filter(_at_level(keys, rows_per_range, level + 1))
        own = nodes.select(
            *[F.col(f"{START}.{k}").alias(k) for k in keys],
            F.col(START).alias("__own"), start_id(keys).alias("__id"), "__n", "__digest",
        )
        if top:
            placed = own.withColumn(START, F.lit(None).cast(nodes.schema[START].dataType))
        else:
            placed = with_start(own, keys, higher)
        rows = placed.select(
            F.lit(level).alias("level"), F.col("__id").alias("id"), start_id(keys).alias("parent"),
            F.col("__own").alias("start"), F.col("__n").alias("n"), F.col("__digest").alias("digest"),
        )
        out = rows if out is None else out.union(rows)
        if top:
            return out
        nodes = placed.groupBy(START).agg(
            F.sum("__n").alias("__n"), digest_sum(F.unhex("__digest")).alias("__digest")
        )
        starts, level = higher, level + 1


def unequal_leaves(one: DataFrame, other: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ids of the leaves of each tree whose rows the other tree does not have as a leaf.

    Descends from the highest level that both have. Only nodes that differ are opened, and
    where they are few, only their children are read from the trees. Rows of all other leaves are
    the same on both sides, so a comparison of the trees' tables may leave them out.
    """
    tops = [t.agg(F.max("level")).first()[0] for t in (one, other)]
    if None in tops:
        return tuple(t.filter("level = 0").select("id") for t in (one, other))
    open_ = [None, None]
    for level in range(min(tops), -1, -1):
        nodes = []
        for tree, parents in zip((one, other), open_, strict=True):
            below = tree.filter(F.col("level") == level)
            if isinstance(parents, list):
                below = below.filter(F.col("parent").isin(parents))
            elif parents is not None:
                below = below.join(parents.withColumnRenamed("id", "parent"), "parent", "left_semi")
            nodes.append(below.select("id", "n", "digest"))
        left = [a.join(b, ["id", "n", "digest"], "left_anti").select("id") for a, b in (nodes, nodes[::-1])]
        if level:
            found = [rows.limit(LISTED + 1).collect() for rows in left]
            open_ = [
                [r[0] for r in some] if len(some) <= LISTED else rows
                for some, rows in zip(found, left, strict=True)
            ]
    return left[0], left[1]

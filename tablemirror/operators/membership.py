"""A table of bits for a set of keys, to keep most rows that it lacks out of a shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemirror.errors import SchemaError
from tablemirror.operators.keys import broadcast_limit
from tablemirror.schemas import check_comparable, key_list, require_columns

#: Keys of a word of 64 bits, on average: one row in thirty that the keys lack then passes.
_KEYS_PER_WORD = 6
#: Bytes that a word takes once it has been broadcast.
_WORD_BYTES = 32
#: Types whose equal values have equal hashes in every release.
_HASHED = (T.StringType, T.BinaryType, T.IntegralType, T.DecimalType, T.BooleanType, T.DatetimeType)


class KeyFilter(NamedTuple):
    """Which keys a set may hold: each key sets two bits of one word, and words are rows."""

    words: DataFrame
    keys: list[str]
    n_words: int

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of ``df`` whose key the set may hold, and those whose key it certainly lacks."""
        word, mask = _place(self.keys, self.n_words)
        asked = df.withColumns({"__word": word, "__mask": mask})
        table = F.broadcast(self.words)
        set_ = F.col("__bits").bitwiseAND(F.col("__mask")) == F.col("__mask")
        possible = asked.join(table, "__word").filter(set_)
        absent = asked.join(table, "__word", "left").filter(~F.coalesce(set_, F.lit(False)))
        return possible.select(*df.columns), absent.select(*df.columns)


def key_filter(
    df: DataFrame, keys: str | Sequence[str], words: int | None = None
) -> KeyFilter | None:
    """The filter of the keys of ``df``, or None where it cannot be had.

    Its size is known before it is made: one word for every six rows of ``df``, which are
    counted, or ``words``. It is made by one aggregate that combines before its shuffle, and
    broadcast. There is none where that would be over ``spark.tablemirror.broadcastBytes``, or
    for keys of a type whose equal values may differ in bits (floats, collated strings, arrays,
    structs).
    """
    keys = key_list(keys)
    require_columns(df, keys)
    if not all(_hashes_alike(df.schema[k].dataType) for k in keys):
        return None
    if words is None:
        words = max(1, -(-df.count() // _KEYS_PER_WORD))
    if words * _WORD_BYTES > broadcast_limit(df):
        return None
    word, mask = _place(keys, words)
    table = df.select(word.alias("__word"), mask.alias("__mask"))
    table = table.groupBy("__word").agg(F.bit_or("__mask").alias("__bits"))
    return KeyFilter(table, keys, words)


def without_keys(
    df: DataFrame, gone: DataFrame, keys: str | Sequence[str], words: int | None = None
) -> DataFrame:
    """Rows of ``df`` whose key is not among those of ``gone``; a null key is in no set.

    Rows that the filter of ``gone`` rules out stay where they are. The others, that is the rows
    to drop and one in thirty of the rest, are shuffled to an exact join. ``df`` is read twice.
    Where there is no filter, all rows are shuffled to that join. ``words`` sets the size of the
    filter by hand; a smaller one lets more rows pass, with the same result.
    """
    keys = key_list(keys)
    require_columns(df, keys)
    check_comparable(df, keys)
    for k in keys:
        mine, theirs = (side.schema[k].dataType.simpleString() for side in (df, gone))
        if mine != theirs:
            raise SchemaError(f"key column {k}: {mine} here, {theirs} among the keys to drop")
    names = gone.select(*keys)
    known = key_filter(names, keys, words)
    if known is None:
        return df.join(names, keys, "left_anti").select(*df.columns)
    possible, absent = known.split(df)
    return absent.unionByName(possible.join(names, keys, "left_anti").select(*df.columns))


def _place(keys: Sequence[str], n_words: int) -> tuple[Column, Column]:
    """The word of a key, and its two bits there."""
    first, second = F.xxhash64(*keys), F.xxhash64(*keys, F.lit(1))

    def bit(by: int) -> Column:
        at = F.shiftright(second, by).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), at)

    return F.pmod(first, F.lit(n_words).cast("long")), bit(0).bitwiseOR(bit(6))


def _hashes_alike(dt: T.DataType) -> bool:
    if isinstance(dt, T.StringType):
        return dt.simpleString() == "string"  # not char, varchar or a collation of its own
    return isinstance(dt, _HASHED)

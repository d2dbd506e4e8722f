"""Versions that share the files of what has not changed.

    <store>/snapshots/N-<attempt>/leaf=<range>/   the files that version N has written itself
    <store>/manifests/N-<attempt>/                one row per key range: its files, counts and digest
    <store>/trees/N-<attempt>/                    the digest tree over the ranges

The manifest of a version names the files of all its ranges, those of earlier versions among
them. A version therefore writes only ranges that differ from its parent's, two versions are
compared by reading only ranges that differ, and a read of some scopes passes only files that can
hold them. As in every store, a version exists once its history row does.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemirror.errors import EmptyMessageError, NothingChangedError, PublishError, SchemaError, StaleParentError
from tablemirror.functions.digest import content_digest, digest_sum, is_wide_type
from tablemirror.operators.diff import ADDED, DELETED, DIGEST_SUFFIX, MODIFIED, UNCHANGED, change_summary, diff
from tablemirror.operators.keys import any_null, checked_key_stats
from tablemirror.operators.patch import apply_patch, check_patch, patch_keys
from tablemirror.operators.ranges import START, start_id, starts_of, tree_over, unequal_leaves, with_start
from tablemirror.operators.scope import check_prefixes, check_scope_column, scope_of, under
from tablemirror.schemas import check_comparable, check_same_schema, key_list, require_columns
from tablemirror.sources import paths, versions

#: Rows of a range, on average.
ROWS_PER_RANGE = 500_000
#: Stored with each row: 16 bytes of digest over all its columns.
ROW_DIGEST = "__row" + DIGEST_SUFFIX
_BITS = 64
_NODE = T.StructType([
    T.StructField("level", T.IntegerType()), T.StructField("id", T.LongType()), T.StructField("parent", T.LongType()),
    T.StructField("n", T.LongType()), T.StructField("digest", T.StringType()),
])
#: Folders of a version; the first ones are gone once it is published.
_PASSING = ("starts", "leaves", "patches")
_PARTS = (*_PASSING, "snapshots", "manifests", "trees")


def publish_ranged(
    result: DataFrame,
    store: str,
    message: str,
    author: str,
    parent: int,
    *,
    keys: str | Sequence[str],
    scope: str | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
    allow_empty: bool = False,
) -> int:
    """Write the ranges of ``result`` that differ from ``parent``, name the others again, and return
    the new version; refusals are those of ``publish``.

    ``result`` is read three times: its keys for the limits of the ranges, all columns for their
    digests, and once more the rows of ranges that differ, which alone are shuffled with their
    payload. ``scope`` names a path column, by default ``path`` if that is a key; files then
    remember which scopes they hold. Keep ``rows_per_range`` and the keys from version to version:
    ranges of another size have nothing in common with the parent's.
    """
    spark = result.sparkSession
    keys = key_list(keys)
    if not message:
        raise EmptyMessageError("a version needs a message")
    versions.refuse_stale(spark, store, parent)
    require_columns(result, keys)
    reserved = [c for c in result.columns if c.endswith(DIGEST_SUFFIX) or c in (START, "leaf")]
    if reserved:
        raise SchemaError(f"reserved column name: {', '.join(reserved)}")
    check_comparable(result, [f.name for f in result.schema if f.name not in keys and not is_wide_type(f.dataType)])
    scope = _scope_column(result, keys, scope)
    before = version_of(spark, store, parent) if parent else None
    if before is not None:
        check_same_schema(result, before.shape)
    folder = f"{parent + 1}-{uuid.uuid4().hex}"
    where = {part: paths.join(store, part, folder) for part in _PARTS}
    try:
        starts_of(result, keys, rows_per_range).write.parquet(where["starts"])
        starts = spark.read.schema(T.StructType([result.schema[k] for k in keys])).parquet(where["starts"])
        rows = _placed(result, keys, starts)
        leaves = _leaves(rows, keys, scope)
        counts = _write(rows, leaves, before, scope, keys, starts, where, rows_per_range)
        if not any(counts.values()) and not allow_empty:
            raise NothingChangedError(f"nothing changed since version {parent}")
        versions.refuse_stale(spark, store, parent)
    except Exception:
        _drop(spark, where.values())
        raise
    _drop(spark, [where[part] for part in _PASSING])
    if not any(counts.values()):
        _drop(spark, where.values())
        return parent
    try:
        versions.append(spark, store, parent + 1, parent, message, author, counts, folder)
    except StaleParentError:
        _drop(spark, where.values())
        raise
    return parent + 1


def publish_patch(
    patch: DataFrame,
    store: str,
    message: str,
    author: str,
    parent: int,
    *,
    rows_per_range: int = ROWS_PER_RANGE,
) -> int:
    """Apply ``patch`` (see ``make_patch``) to the ranged version ``parent`` and publish the outcome.

    Only the ranges that hold a key of the patch are read and written; all others are named again.
    The patch is refused unless it was made for the rows that ``parent`` holds. It is computed once
    and read from the store for each step, until the version is published.
    """
    spark = patch.sparkSession
    if not message:
        raise EmptyMessageError("a version needs a message")
    versions.refuse_stale(spark, store, parent)
    before = version_of(spark, store, parent)
    if before is None or before.manifest is None:
        raise PublishError(f"version {parent} has no ranges")
    keys = before.keys
    if sorted(patch_keys(patch)) != sorted(keys):
        raise SchemaError(f"the patch must have the keys {', '.join(keys)}")
    check_patch(before.shape, patch, keys)
    folder = f"{parent + 1}-{uuid.uuid4().hex}"
    where = {part: paths.join(store, part, folder) for part in _PARTS}
    try:
        patch.write.parquet(where["patches"])
        patch = spark.read.schema(patch.schema).parquet(where["patches"])
        old_starts = before.manifest.filter(F.col(START).isNotNull()).select(f"{START}.*")
        asked = with_start(patch.select(*keys), keys, old_starts)
        touched = asked.select(start_id(keys).alias("id")).distinct()
        part = before.only(touched)
        result = apply_patch(part, patch, keys)
        kept = before.manifest.join(touched, "id", "left_anti")
        # new limits within the touched ranges, and all old ones: a limit stays though its row may go
        gone = before.manifest.join(touched, "id", "left_semi")
        names = [T.StructField(k, result.schema[k].dataType) for k in keys]
        new = starts_of(result, keys, rows_per_range).union(gone.filter(F.col(START).isNotNull()).select(f"{START}.*"))
        new.union(kept.filter(F.col(START).isNotNull()).select(f"{START}.*")).distinct().write.parquet(where["starts"])
        starts = spark.read.schema(T.StructType(names)).parquet(where["starts"])
        rows = _placed(result, keys, starts)
        leaves = _leaves(rows, keys, before.scope)
        _store(rows, leaves, kept, before.scope, keys, starts, where, rows_per_range)
        counts = dict.fromkeys((ADDED, MODIFIED, DELETED), 0)
        counts |= {r["change"]: r["n"] for r in change_summary(patch.select("change")).collect()}
        if not any(counts.values()):
            raise NothingChangedError(f"nothing changed since version {parent}")
        versions.refuse_stale(spark, store, parent)
    except Exception:
        _drop(spark, where.values())
        raise
    _drop(spark, [where[part] for part in _PASSING])
    try:
        versions.append(spark, store, parent + 1, parent, message, author, counts, folder)
    except StaleParentError:
        _drop(spark, where.values())
        raise
    return parent + 1


def diff_versions(
    spark: SparkSession,
    store: str,
    old: int,
    new: int,
    *,
    new_store: str | None = None,
    keys: str | Sequence[str] | None = None,
) -> DataFrame:
    """Key columns and ``change`` from version ``old`` to ``new``, which may lie in another store.

    Two ranged versions meet by their digest trees: only ranges that differ are read, and of
    these only keys and row digests. Other versions are compared in full, by ``keys``.
    """
    a, b = version_of(spark, store, old), version_of(spark, new_store or store, new)
    for version, number in ((a, old), (b, new)):
        if version is None:
            raise PublishError(f"there is no version {number}")
    check_same_schema(a.shape, b.shape)
    if a.manifest is None or b.manifest is None or a.keys != b.keys:
        keys = keys or a.keys or b.keys
        if keys is None:
            raise SchemaError("versions without ranges need keys to be compared by")
        return diff(b.rows, a.rows, keys, validate=False)
    sides = [v.only(ids, digests=True) for v, ids in zip((a, b), unequal_leaves(a.tree, b.tree), strict=True)]
    return _changes(*sides, a.keys)


def diff_latest(
    source: DataFrame, store: str, *, rows_per_range: int = ROWS_PER_RANGE, validate: bool = True
) -> DataFrame:
    """Key columns and ``change`` from the newest ranged version to ``source``.

    The source is read in full, once for its limits and twice for its digests; of the version,
    only the ranges whose digests differ are.
    """
    spark = source.sparkSession
    latest = version_of(spark, store, versions.latest(spark, store))
    if latest is None or latest.manifest is None:
        raise PublishError(f"the newest version in {store} has no ranges")
    keys = latest.keys
    check_same_schema(source, latest.shape)
    if validate:
        checked_key_stats(keys, source=source)
    rows = _placed(source, keys, starts_of(source, keys, rows_per_range))
    mine = _leaves(rows, keys, None).select(start_id(keys).alias("id"), "n", "digest")
    theirs = latest.manifest.select("id", "n", "digest")
    ids = [x.join(y, ["id", "n", "digest"], "left_anti").select("id") for x, y in ((mine, theirs), (theirs, mine))]
    fresh = _within(rows, ids[0], keys).select(*keys, ROW_DIGEST)
    return _changes(latest.only(ids[1], digests=True), fresh, keys)


class Version:
    """One version: its rows, and for a ranged one its manifest and tree."""

    def __init__(self, spark: SparkSession, store: str, folder: str):
        self.spark, self.store = spark, store
        where = paths.join(store, "manifests", folder)
        self.manifest = self.keys = self.scope = None
        if paths.exists(spark, where):
            self.manifest = spark.read.parquet(where)
            self._tree = paths.join(store, "trees", folder)
            self.keys = self.manifest.schema[START].dataType.names
            self.scope = self.manifest.schema["scopes"].metadata.get("column")
            self.schema = T.StructType.fromJson(self.manifest.schema["files"].metadata["schema"])
        else:
            self.plain = spark.read.parquet(paths.join(store, "snapshots", folder))

    @property
    def shape(self) -> DataFrame:
        """A table without rows, with the columns of the version; no file is listed for it."""
        every = self.plain if self.manifest is None else versions.empty(self.spark, self.schema)
        return every.select(*[c for c in every.columns if not c.endswith(DIGEST_SUFFIX)])

    @property
    def tree(self) -> DataFrame:
        start = T.StructField("start", self.manifest.schema[START].dataType)
        return self.spark.read.schema(T.StructType([*_NODE.fields[:3], start, *_NODE.fields[3:]])).parquet(self._tree)

    @property
    def rows(self) -> DataFrame:
        every = self.plain if self.manifest is None else self._read(self.manifest)
        return every.select(*[c for c in every.columns if not c.endswith(DIGEST_SUFFIX)])

    @property
    def with_digests(self) -> DataFrame:
        return self.plain if self.manifest is None else self._read(self.manifest)

    def only(self, ids: DataFrame, digests: bool = False) -> DataFrame:
        """The rows of the ranges with these ids; with ``digests`` keys and row digests alone."""
        found = self._read(self.manifest.join(ids, "id", "left_semi"))
        return found.select(*self.keys, ROW_DIGEST) if digests else found

    def in_scope(self, prefixes: list[str], column: str) -> DataFrame:
        """The rows under the prefixes, from files that can hold some."""
        if self.manifest is None:
            return self.rows.filter(under(prefixes, column))
        chosen = self.manifest
        if column in self.keys and isinstance(self.schema[column].dataType, T.StringType):
            least, greatest = F.col(f"least.{column}"), F.col(f"greatest.{column}")
            # a prefix ends in a slash, so what lies under it sorts before the same with a "0"
            meets = [(greatest >= p) & (least < p[:-1] + "0") for p in prefixes]
            chosen = chosen.filter(reduce(or_, meets))
        if column == self.scope:
            first = self.spark.range(1).select(
                F.explode(F.array(*[F.lit(p) for p in prefixes])).alias(column)
            )
            mask = first.agg(_scope_bits(column)).first()[0]
            chosen = chosen.filter(F.col("scopes").bitwiseAND(F.lit(mask)) != 0)
        found = self._read(chosen).filter(under(prefixes, column))
        return found.select(*[c for c in found.columns if not c.endswith(DIGEST_SUFFIX)])

    def _read(self, manifest: DataFrame) -> DataFrame:
        # the driver lists the files of any table that it plans a read of
        files = [r[0] for r in manifest.select(F.explode("files")).collect()]
        if not files:
            nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
            return self.spark.range(0).select(*nothing)
        where = [paths.join(self.store, "snapshots", f) for f in sorted(files)]
        return self.spark.read.schema(self.schema).parquet(*where).select(*self.schema.names)


def version_of(spark: SparkSession, store: str, number: int) -> Version | None:
    folder = versions.folder(spark, store, number)
    return Version(spark, store, folder) if folder else None


def read_scope(spark: SparkSession, store: str, prefix: str | Sequence[str], column: str = "path") -> DataFrame:
    """Rows of the newest version under ``prefix``; files that cannot hold any are not read.

    A ranged version knows for each file the least and greatest value of every key column and 64 bits
    for the scopes (first steps) of its path column.
    """
    prefixes = check_prefixes(prefix)
    latest = version_of(spark, store, versions.latest(spark, store))
    if latest is None:
        raise PublishError(f"nothing has been published in {store}")
    check_scope_column(latest.shape, column)
    return latest.in_scope(prefixes, column)


# ---------------------------------------------------------------- parts


def _scope_column(df: DataFrame, keys: list[str], scope: str | None) -> str | None:
    if scope is None:
        return "path" if "path" in keys and isinstance(df.schema["path"].dataType, T.StringType) else None
    check_scope_column(df, scope)
    return scope


def _scope_bits(column: str) -> Column:
    """Aggregate: a bit for the first step of every path, 64 of them shared by all steps."""
    place = F.pmod(F.xxhash64(scope_of(column)), F.lit(_BITS)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    return F.coalesce(F.bit_or(bit), F.lit(0).cast("long"))


def _placed(df: DataFrame, keys: list[str], starts: DataFrame) -> DataFrame:
    """The rows with their range and their digest; a null key fails any job that reads them."""
    plain = df.select(*[c for c in df.columns if not c.endswith(DIGEST_SUFFIX)])
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    fault = F.raise_error(F.concat(F.lit("result: null key "), key)).cast("binary")
    digest = F.when(any_null(keys), fault).otherwise(content_digest(plain, plain.columns))
    return with_start(plain.withColumn(ROW_DIGEST, digest), keys, starts)


def _within(rows: DataFrame, ids: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the ranges with these ids."""
    wanted = ids.withColumnRenamed("id", "__id")
    return rows.withColumn("__id", start_id(keys)).join(wanted, "__id", "left_semi").drop("__id")


def _leaves(rows: DataFrame, keys: list[str], scope: str | None) -> DataFrame:
    """One row per range, from one aggregate that combines before its shuffle."""
    return rows.groupBy(START).agg(
        F.count("*").alias("n"),
        digest_sum(F.col(ROW_DIGEST)).alias("digest"),
        F.struct(*[F.min(k).alias(k) for k in keys]).alias("least"),
        F.struct(*[F.max(k).alias(k) for k in keys]).alias("greatest"),
        (_scope_bits(scope) if scope else F.lit(-1).cast("long")).alias("scopes"),
    )


def _write(rows, leaves, before, scope, keys, starts, where, rows_per_range) -> dict[str, int]:
    """Store what differs from ``before``, and count the changes."""
    ranged = before is not None and before.manifest is not None and before.keys == keys
    ranged = ranged and before.scope == scope
    spark = rows.sparkSession
    if ranged:
        # digests of the result, once for all that follows
        leaves.write.parquet(where["leaves"])
        leaves = spark.read.schema(leaves.schema).parquet(where["leaves"])
        same = ["id", "n", "digest"]
        mine = leaves.withColumn("id", start_id(keys))
        kept = before.manifest.join(mine.select(*same), same, "left_semi")
        fresh = mine.join(kept.select("id"), "id", "left_anti")
        changed = _within(rows, fresh.select("id"), keys)
        written = _store(changed, fresh.drop("id"), kept, scope, keys, starts, where, rows_per_range)
    else:
        written = _store(rows, leaves, None, scope, keys, starts, where, rows_per_range)
    checked = checked_key_stats(keys, result=written)
    counts = dict.fromkeys((ADDED, MODIFIED, DELETED), 0)
    if before is None:
        counts[ADDED] = checked["result"].rows
        return counts
    if ranged:
        old = before.only(before.manifest.join(kept.select("id"), "id", "left_anti").select("id"), digests=True)
    else:
        plain = before.rows
        old = plain.select(*keys, content_digest(plain, plain.columns).alias(ROW_DIGEST))
    found = change_summary(_changes(old, written.select(*keys, ROW_DIGEST), keys))
    return counts | {r["change"]: r["n"] for r in found.collect()}


def _store(rows, leaves, kept, scope, keys, starts, where, rows_per_range) -> DataFrame:
    """Write the rows, range by range, then the manifest with the ranges that are kept, and the tree."""
    spark = rows.sparkSession
    leaf = start_id(keys).alias("leaf")
    # by key, so that a partition is a run of ranges and no range depends on one task
    placed = rows.select("*", leaf).repartitionByRange(*keys).sortWithinPartitions("leaf", *keys)
    plain = [c for c in rows.columns if c != START]
    placed.select(*plain, "leaf").write.partitionBy("leaf").parquet(where["snapshots"])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema if f.name != START])
    folder = where["snapshots"].rsplit("/", 1)[1]
    written = spark.read.schema(T.StructType([*schema.fields, T.StructField("leaf", T.LongType())])).parquet(where["snapshots"])
    name = F.concat(F.lit(folder + "/"), F.substring_index(F.col("_metadata.file_path"), f"/{folder}/", -1))
    files = written.select(F.col("leaf").alias("id"), name.alias("file")).groupBy("id").agg(F.collect_set("file").alias("files"))
    manifest = leaves.withColumn("id", start_id(keys)).join(files, "id")
    if kept is not None:
        manifest = manifest.unionByName(kept.select(*manifest.columns))
    marked = manifest.select(
        *[c for c in manifest.columns if c not in ("files", "scopes")],
        F.col("scopes").alias("scopes", metadata={"column": scope} if scope else {}),
        F.col("files").alias("files", metadata={"schema": schema.jsonValue()}),
    )
    marked.coalesce(1).write.parquet(where["manifests"])
    manifest = spark.read.schema(marked.schema).parquet(where["manifests"])
    clash = manifest.groupBy("id").count().filter("count > 1").limit(1).collect()
    if clash:
        raise PublishError("two ranges share one number; choose another rows_per_range")
    tree = tree_over(manifest.select(START, "n", "digest"), keys, starts, rows_per_range)
    tree.repartition(1).sortWithinPartitions("level", "parent").write.parquet(where["trees"])
    return written.drop("leaf")


def _changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Changes between two tables of keys and row digests."""
    joined = old.withColumnRenamed(ROW_DIGEST, "__old").join(
        new.withColumnRenamed(ROW_DIGEST, "__new"), keys, "full_outer"
    )
    change = (
        F.when(F.col("__old").isNull(), ADDED).when(F.col("__new").isNull(), DELETED)
        .when(F.col("__old") != F.col("__new"), MODIFIED).otherwise(UNCHANGED)
    )
    return joined.select(*keys, change.alias("change")).filter(F.col("change") != UNCHANGED)


def _drop(spark: SparkSession, folders) -> None:
    for folder in folders:
        paths.delete(spark, folder)

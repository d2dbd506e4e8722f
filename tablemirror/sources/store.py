"""A store of published versions.

    <store>/snapshots/N-<attempt>/   one full snapshot, Parquet
    <store>/history/                 one row per published version, Parquet
    <store>/claims/N                 an empty file: a writer has taken this number

A version exists once its history row does; the row names the snapshot's folder. It is
written last and readers go through it, so a snapshot that is half written, or whose
publication failed, is never seen. Every attempt writes to a folder of its own and deletes
no other: a writer that is refused leaves all published versions as they were. Of two writers
that come to the same version in the same moment, one claims its number and the other is
refused (``versions``), where the storage offers an exclusive create (``paths.create_new``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemirror.errors import (
    EmptyMessageError,
    KeyCheckError,
    NothingChangedError,
    PublishError,
    SchemaError,
    StaleParentError,
)
from tablemirror.functions.digest import digest_bytes, is_wide_type, wide_columns
from tablemirror.operators.diff import (
    ADDED,
    DELETED,
    DIGEST_SUFFIX,
    INLINE,
    MODIFIED,
    change_summary,
    diff,
)
from tablemirror.operators.keys import checked_key_stats
from tablemirror.schemas import check_comparable, check_same_schema, key_list, require_columns
from tablemirror.sources import paths, versions
from tablemirror.sources.ranged import ROW_DIGEST, Version, read_scope

def history(spark: SparkSession, store: str) -> DataFrame:
    """Published versions; empty for a store that has none yet."""
    return versions.rows(spark, store).select(*versions.HISTORY_SCHEMA.names)


def latest_version(spark: SparkSession, store: str) -> int:
    """Newest published version, 0 if there is none."""
    return versions.latest(spark, store)


def read_latest(
    spark: SparkSession,
    store: str,
    schema: T.StructType | None = None,
    with_digests: bool = False,
    scope: str | Sequence[str] | None = None,
    column: str = "path",
) -> DataFrame:
    """The newest version only.

    A store without a version raises, unless ``schema`` is given: then it reads as
    an empty table. ``with_digests=True`` keeps the stored ``__sha256`` columns, for
    ``diff(..., digest=[...])``. ``scope`` keeps the rows under one or several prefixes of
    ``column``; of a ranged version, only files that can hold such rows are read.
    """
    newest = versions.rows(spark, store).agg(F.max(F.struct("version", "folder"))).first()[0]
    if newest and newest["version"]:
        if scope is not None:
            return read_scope(spark, store, scope, column)
        return _read(spark, store, newest["folder"], with_digests)
    if schema is None:
        raise PublishError(f"nothing has been published in {store}")
    return versions.empty(spark, schema)


def publish(
    result: DataFrame,
    store: str,
    message: str,
    author: str,
    parent: int,
    *,
    keys: str | Sequence[str],
    digest: Sequence[str] | None = None,
    cluster: bool = False,
    validate: bool | str | None = None,
    allow_empty: bool = False,
) -> int:
    """Write ``result`` as the version after ``parent``, or nothing; return its number.

    Refused are an empty message, a parent that is not the latest version, a
    schema other than the parent's, a column that cannot be compared, a null or repeated
    key, and a result equal to the parent (``allow_empty=True`` returns the parent's
    number instead).

    Columns in ``digest`` (by default as in ``diff``) get a stored SHA-256, so that
    this and later comparisons of versions read 32 bytes in place of the value.
    ``cluster=True`` range-partitions and sorts by key, which costs a shuffle
    and lets prefix filters on the version skip files and row groups.
    The keys are checked within the comparison with the parent (``validate="inline"``, see
    ``diff``) unless ``validate=True`` asks for a job of its own; a first version has nothing
    to be compared with and always takes that job.
    """
    spark = result.sparkSession
    keys = key_list(keys)
    if not message:
        raise EmptyMessageError("a version needs a message")
    validate = INLINE if validate is None else validate
    if validate not in (True, False, INLINE):
        raise KeyCheckError(f"validate must be True, False or {INLINE!r}, not {validate!r}")
    versions.refuse_stale(spark, store, parent)
    require_columns(result, keys)
    wide = _digest_columns(result, keys, digest)
    check_comparable(result, [c for c in result.columns if c not in keys and c not in wide])
    before = _read(spark, store, versions.folder(spark, store, parent), True) if parent else None
    before = before.drop(ROW_DIGEST) if before is not None else None
    if before is not None:
        check_same_schema(result, _plain(before))

    version = parent + 1
    folder = f"{version}-{uuid.uuid4().hex}"
    where = paths.join(store, "snapshots", folder)
    rows = result.withColumns(
        {c + DIGEST_SUFFIX: digest_bytes(c, result.schema[c].dataType) for c in wide}
    ) if wide else result
    if cluster:
        rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    try:
        rows.write.parquet(where)
        written = spark.read.schema(rows.schema).parquet(where)
        counts = _count_changes(written, before, keys, wide, validate)
        if not any(counts.values()) and not allow_empty:
            raise NothingChangedError(f"nothing changed since version {parent}")
        versions.refuse_stale(spark, store, parent)
    except Exception:
        paths.delete(spark, where)
        raise
    if not any(counts.values()):
        paths.delete(spark, where)
        return parent
    try:
        versions.append(spark, store, version, parent, message, author, counts, folder)
    except StaleParentError:
        paths.delete(spark, where)
        raise
    return version


def _count_changes(
    written: DataFrame,
    before: DataFrame | None,
    keys: list[str],
    wide: list[str],
    validate: bool | str,
) -> dict[str, int]:
    counts = dict.fromkeys((ADDED, MODIFIED, DELETED), 0)
    inline = validate == INLINE and before is not None
    stats = checked_key_stats(keys, result=written) if validate and not inline else None
    if before is None:
        counts[ADDED] = stats["result"].rows if stats else written.count()
        return counts
    # Columns that only the parent holds a digest of are compared by value.
    drop = [c for c in before.columns if c.endswith(DIGEST_SUFFIX) and c not in written.columns]
    changes = diff(
        written, before.drop(*drop), keys, digest=wide, validate=INLINE if inline else False
    )
    try:
        counts.update({r["change"]: r["n"] for r in change_summary(changes).collect()})
    except SparkRuntimeException as error:
        if inline and error.getCondition() == "USER_RAISED_EXCEPTION":
            raise KeyCheckError(error.getMessageParameters()["errorMessage"]) from error
        raise
    return counts


def _digest_columns(
    result: DataFrame, keys: list[str], digest: Sequence[str] | None
) -> list[str]:
    reserved = [c for c in result.columns if c.endswith(DIGEST_SUFFIX)]
    if reserved:
        raise SchemaError(f"reserved column name: {', '.join(reserved)}")
    if digest is None:
        return wide_columns(result, keys)
    require_columns(result, digest)
    for c in digest:
        if c in keys or not is_wide_type(result.schema[c].dataType):
            raise SchemaError(f"column {c} cannot be stored with a digest")
    return list(digest)


def _read(spark: SparkSession, store: str, folder: str, with_digests: bool) -> DataFrame:
    version = Version(spark, store, folder)
    return version.with_digests if with_digests else version.rows


def _plain(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.endswith(DIGEST_SUFFIX)])

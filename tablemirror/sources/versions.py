"""The history of a store: which versions exist, and the folder of each.

A version's number is claimed before its history row is written, by creating the file
``<store>/claims/<version>``, which only one of several writers can. A writer that dies between
claim and row leaves a claim without a version: ``release_claim`` takes it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemirror.errors import PublishError, StaleParentError
from tablemirror.operators.diff import ADDED, DELETED, MODIFIED
from tablemirror.sources import paths

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("parent", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("n_added", T.LongType()),
        T.StructField("n_modified", T.LongType()),
        T.StructField("n_deleted", T.LongType()),
    ]
)
_STORED_SCHEMA = T.StructType([*HISTORY_SCHEMA.fields, T.StructField("folder", T.StringType())])


def rows(spark: SparkSession, store: str) -> DataFrame:
    where = paths.join(store, "history")
    if not paths.exists(spark, where):
        return empty(spark, _STORED_SCHEMA)
    return spark.read.schema(_STORED_SCHEMA).parquet(where)


def latest(spark: SparkSession, store: str) -> int:
    return rows(spark, store).agg(F.max("version")).first()[0] or 0


def folder(spark: SparkSession, store: str, version: int) -> str | None:
    return rows(spark, store).filter(F.col("version") == version).agg(F.max("folder")).first()[0]


def refuse_stale(spark: SparkSession, store: str, parent: int) -> None:
    newest = latest(spark, store)
    if newest != parent:
        raise StaleParentError(f"parent is {parent} but the latest version is {newest}")


def release_claim(spark: SparkSession, store: str, version: int) -> None:
    """Give back the number of a version whose writer is gone and has recorded none."""
    if folder(spark, store, version):
        raise PublishError(f"version {version} has been published")
    paths.delete(spark, paths.join(store, "claims", str(version)))


def append(spark, store, version, parent, message, author, counts, folder) -> None:
    """Claim the version and record it; raise if another writer has claimed it."""
    if not paths.create_new(spark, paths.join(store, "claims", str(version))):
        raise StaleParentError(
            f"another writer has claimed version {version}; if it is gone, release_claim gives it back"
        )
    values = {
        "version": F.lit(version),
        "parent": F.lit(parent),
        "message": F.lit(message),
        "author": F.lit(author),
        "published_at": F.current_timestamp(),
        "n_added": F.lit(counts[ADDED]),
        "n_modified": F.lit(counts[MODIFIED]),
        "n_deleted": F.lit(counts[DELETED]),
        "folder": F.lit(folder),
    }
    row = spark.range(1).select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in _STORED_SCHEMA]
    )
    row.coalesce(1).write.mode("append").parquet(paths.join(store, "history"))


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(0).select(*columns).filter(F.lit(False))

"""What the operators of this subpackage share: words, stored tables, components, text maps.

Every operator reads the two columns it needs by name and makes its own frame of them, so
that further columns of the input, whatever they are called, never clash with its own.
"""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablemirror.workers import ship

#: The words of all contracts: runs of anything but blank, tab, line feed and their kin.
WORD = re.compile("[^\x20\x09-\x0d]+")
#: Runs of letters.
LETTERS = re.compile(r"[^\W\d_]+")
#: Bytes of a batch that are turned into Python objects at a time.
SLICE_BYTES = 4 << 20
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def lower_ascii(text: str | None) -> str:
    """The text with A-Z in lower case and all else as it is; null is empty."""
    return (text or "").encode().translate(_LOWER).decode()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own where none is named.

    A session on a cluster has to name it: a folder of one machine would lose rows there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tablemirror-llm-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` written once to the shared folder and read from there.

    Cuts lineage: what is computed from it survives lost executors without computing ``df``
    again, and row ids given in ``df`` stay as they are. The files go when the JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tablemirror-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    _SCRATCH.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables that ``stored`` has written since the last ``scratch_of`` was left.
_SCRATCH: list[str] = []


def delete_tables(spark: SparkSession, tables: list[str], but_not_of: DataFrame) -> list[str]:
    """Delete tables written by ``stored`` that ``but_not_of`` does not read; return the others."""
    read = but_not_of.inputFiles()
    held = [t for t in tables if any(f"{t.rsplit('/', 1)[1]}/" in f for f in read)]
    for path in set(tables) - set(held):
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    return held


def scratch_of(build: Callable[[], DataFrame]) -> tuple[DataFrame, list[str]]:
    """``build()``, and the tables that were stored meanwhile, which its result may still read."""
    before = len(_SCRATCH)
    made = build()
    tables = _SCRATCH[before:]
    del _SCRATCH[before:]
    return made, tables


def sliced(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in slices of about ``limit`` bytes, one row at least."""
    if not batch.num_rows:
        return
    step = max(1, batch.num_rows * limit // max(batch.nbytes, 1))
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        # rows are uneven: a slice that came out far too large is cut again
        if part.num_rows > 1 and part.nbytes > 2 * limit:
            yield from sliced(part, limit)
        else:
            yield part


def give_back() -> None:
    """Return what a task has freed to the system: its worker goes on to other stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def arrow_map(
    df: DataFrame,
    each: Callable[..., list],
    schema: str,
) -> DataFrame:
    """``each`` gets the columns of some rows as Python lists and returns columns of ``schema``.

    Runs inside tasks, one slice of about ``SLICE_BYTES`` after another, so that the Python
    objects of a whole batch are never held at a time.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ship(df.sparkSession)
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in sliced(batch):
                got = each(*(c.to_pylist() for c in part.columns))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(got, arrow, strict=True)], schema=arrow
                )
                del got
        give_back()

    return df.mapInArrow(batches, schema)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest vertex of each connected component: columns ``v`` and ``component``.

    ``edges`` has two long columns ``a`` and ``b``; self-links are allowed. Large-star and
    small-star rounds: every round each vertex hands its neighbours its smallest one, until
    no edge changes. Each round is three shuffles of the edges and is stored, so lineage stays
    short and the next round reads few files, not one task's worth for each partition of the
    last; the driver keeps a record of every task. Nothing is collected but one checksum a round.
    """
    links = stored(
        edges.filter("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct(),
        "edges",
    )
    before = None
    for _ in range(rounds):
        links = stored(_star(_star(links, large=True), large=False).distinct(), "edges")
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return links.select(F.col("a").alias("v"), F.col("b").alias("component"))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (a > b), some of them repeated, with each vertex's neighbours moved to its smallest
    neighbour."""
    both = links.select("a", "b")
    if large:
        ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
        both = both.select(F.explode(ends).alias("e")).select("e.a", "e.b")
    least = F.least(F.min("b").over(Window.partitionBy("a")), "a")
    joined = both.withColumn("m", least)
    if large:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
            F.col("m").alias("b"),
        )
    return moved.filter("a <> b")

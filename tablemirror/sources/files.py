"""A file tree as a keyed table."""

from __future__ import annotations

import os
import random
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemirror.errors import ScanError
from tablemirror.sources import paths
from tablemirror.workers import ship

LIST, SKIP = "list", "skip"
_ROWS = 8192  # rows of a batch of names
_BYTES = 16 << 20  # bytes of a batch of contents
_TASK_BYTES = 32 << 20  # bytes of contents that a task reads, on average
_READ = 64 << 10  # bytes read at a time in search of the end of a line

#: A folder of more names than this is listed by several tasks, up to ``_PARTS``.
SPLIT = 50_000
_PARTS, _SAMPLE = 64, 4096

FILE, FOLDER, RANGE = "file", "folder", "range"
_FOLDER = "path string, least string, beyond string"
_LISTED = "path string, kind string, modified timestamp, length bigint, least string, beyond string"
_ARROW = pa.schema([
    ("path", pa.string()), ("kind", pa.string()), ("modified", pa.timestamp("us", "UTC")),
    ("length", pa.int64()), ("least", pa.string()), ("beyond", pa.string()),
])


def scan_files(
    spark: SparkSession,
    root: str,
    content: bool = False,
    hidden: str = LIST,
    split: int = SPLIT,
    piece: int | None = None,
) -> DataFrame:
    """One row per file below ``root``: ``path`` relative to it, ``modified``, ``length``.

    ``content=True`` adds the bytes; a file over 2 GB then fails, while listing
    has no such limit. With ``piece`` a file of more than so many bytes comes as several rows, each of
    whole lines with the offset ``start`` of its first byte: a row holds the lines that begin within
    ``piece`` bytes, so that tasks hold little of a large file and share its work. Compare trees with ``compare=["content"]``, since a new
    time stamp alone is no change. Names that begin with a dot or an underscore and empty
    files are rows like all others; empty folders are none. A missing root raises.

    Executors list the tree level by level, one row per folder, so that no list of names
    sits on the driver; the rows of a level are written to the checkpoint folder for the next
    one (in a session without such a folder they are persisted). On local and mounted disks
    names stream by, and a folder of more than ``split`` names is cut into ranges of names, up
    to 64, which are listed by tasks of their own. Elsewhere the storage's client hands over a
    folder as one list, in one task.

    This is Python code over pyarrow's file systems (local, HDFS, S3 and others). A storage that
    it does not know raises ``ScanError`` unless ``hidden="skip"`` is given: then Spark's own
    reader lists the tree, without names that begin with a dot or an underscore and
    without empty files.
    """
    if hidden not in (LIST, SKIP):
        raise ScanError(f"hidden must be {LIST!r} or {SKIP!r}, not {hidden!r}")
    if piece is not None and (not content or hidden == SKIP or piece < 1):
        raise ScanError("pieces of at least one byte need content=True and hidden='list'")
    if not paths.exists(spark, root):
        raise ScanError(f"no such folder: {root}")
    if hidden == SKIP:
        return _by_reader(spark, root, content)
    uri = paths.qualified(spark, root)
    try:
        arrow_fs.FileSystem.from_uri(uri)
    except (OSError, ValueError, pa.ArrowException) as unknown:
        raise ScanError(
            f"{uri} cannot be listed with hidden names; hidden={SKIP!r} scans it without them"
        ) from unknown
    ship(spark)
    level = spark.createDataFrame([("", None, None)], _FOLDER)
    found = []
    while True:
        below = level.mapInArrow(lambda batches: _children(uri, split, batches), _LISTED)
        below = _stored(spark, below)
        found.append(below.filter(F.col("kind") == FILE).select("path", "modified", "length"))
        # a range of names is dealt like a folder of its own
        level = below.filter(F.col("kind") != FILE).select("path", "least", "beyond")
        level = level.repartition("path", "least")
        if level.isEmpty():
            break
    files = reduce(DataFrame.union, found)
    if not content:
        return files
    total = files.agg(F.sum("length")).first()[0] or 0
    # a number of tasks by the bytes to read: by the rows, which are small, Spark would take one
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // _TASK_BYTES))
    own = "path string, modified timestamp, length bigint"
    if piece is None:
        spread = files.repartition(tasks, "path")
        return spread.mapInArrow(lambda batches: _contents(uri, batches), f"{own}, content binary")
    last = F.greatest(F.col("length") - 1, F.lit(0))
    cut = files.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(piece).cast("long"))))
    spread = cut.repartition(tasks, "path", "start")
    return spread.mapInArrow(lambda batches: _pieces(uri, piece, batches), f"{own}, start bigint, content binary")


def _stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The rows, listed once: what a lost executor held is read again, not listed anew."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return df.checkpoint()
    return df.persist()


def _children(
    uri: str, split: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """What lies directly in each folder, or the ranges that a huge one is cut into."""
    files, base = arrow_fs.FileSystem.from_uri(uri)
    base = base.rstrip("/")
    streams = isinstance(files, arrow_fs.LocalFileSystem)
    for batch in batches:
        for folder, least, beyond in zip(*(c.to_pylist() for c in batch.columns)):
            place = f"{base}/{folder}"
            if not streams:
                inside = files.get_file_info(arrow_fs.FileSelector(place))
                for at in range(0, len(inside), _ROWS):
                    yield _listed(folder, inside[at : at + _ROWS])
                continue
            cuts = _cuts(place, split) if beyond is None and least is None else []
            if cuts:
                yield _ranges(folder, cuts)
                continue
            names = _names(place, least, beyond)
            while some := list(islice(names, _ROWS)):
                yield _listed(folder, files.get_file_info([f"{place}{name}" for name in some]))


def _names(place: str, least: str | None, beyond: str | None) -> Iterator[str]:
    """Names in a folder from ``least`` on and before ``beyond``, as the disk hands them out."""
    with os.scandir(place) as entries:
        for entry in entries:
            if (least is None or entry.name >= least) and (beyond is None or entry.name < beyond):
                yield entry.name


def _cuts(place: str, split: int) -> list[str]:
    """Names that cut a folder of more than ``split`` names into ranges of about as many each.

    One pass over the names that keeps an even sample of them.
    """
    held, n, draw = [], 0, random.Random(0)
    for name in _names(place, None, None):
        n += 1
        if len(held) < _SAMPLE:
            held.append(name)
        elif (at := draw.randrange(n)) < _SAMPLE:
            held[at] = name
    parts = min(-(-n // split), _PARTS)
    held.sort()
    return sorted({held[len(held) * i // parts] for i in range(1, parts)})


def _ranges(folder: str, cuts: list[str]) -> pa.RecordBatch:
    n = len(cuts) + 1
    # the first range begins at the empty name, so that it is not taken for the whole folder
    columns = [[folder] * n, [RANGE] * n, [None] * n, [None] * n, ["", *cuts], [*cuts, None]]
    return _batch(columns)


def _listed(folder: str, part: list[arrow_fs.FileInfo]) -> pa.RecordBatch:
    is_folder = [i.type == arrow_fs.FileType.Directory for i in part]
    return _batch([
        [f"{folder}{i.base_name}{'/' if d else ''}" for i, d in zip(part, is_folder)],
        [FOLDER if d else FILE for d in is_folder],
        [i.mtime for i in part],
        [0 if d else i.size for i, d in zip(part, is_folder)],
        [None] * len(part),
        [None] * len(part),
    ])


def _batch(columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW
    )


def _contents(uri: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with the bytes of their files, a bounded number of bytes at a time."""
    files, base = arrow_fs.FileSystem.from_uri(uri)
    base = base.rstrip("/")
    for batch in batches:
        held, size, start = [], 0, 0
        for i, path in enumerate(batch.column(0).to_pylist()):
            with files.open_input_stream(f"{base}/{path}", compression=None) as stream:
                held.append(stream.read())
            size += len(held[-1])
            if size >= _BYTES or i == batch.num_rows - 1:
                rows = batch.slice(start, len(held))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(held, pa.binary())], [*batch.schema.names, "content"]
                )
                held, size, start = [], 0, i + 1


def _pieces(uri: str, piece: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with the lines that begin within ``piece`` bytes from ``start``; none if no line does."""
    files, base = arrow_fs.FileSystem.from_uri(uri)
    base = base.rstrip("/")
    for batch in batches:
        held, size = [], 0
        for i, (path, start) in enumerate(zip(batch["path"].to_pylist(), batch["start"].to_pylist())):
            with files.open_input_file(f"{base}/{path}") as file:
                at, lines = _lines(file, start, piece)
            if lines or not start:
                held.append((i, at, lines))
                size += len(lines)
            if held and (size >= _BYTES or i == batch.num_rows - 1):
                yield _filled(batch, held)
                held, size = [], 0
        if held:
            yield _filled(batch, held)


def _filled(batch: pa.RecordBatch, held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    rows = batch.select(["path", "modified", "length"]).take(pa.array([i for i, _, _ in held], pa.int64()))
    more = [pa.array([at for _, at, _ in held], pa.int64()), pa.array([lines for _, _, lines in held], pa.binary())]
    return pa.RecordBatch.from_arrays([*rows.columns, *more], [*rows.schema.names, "start", "content"])


def _lines(file: pa.NativeFile, start: int, piece: int) -> tuple[int, bytes]:
    """The lines that begin at ``start`` or within ``piece`` bytes from there, and where the first does."""
    begin = _after_line(file, start) if start else 0
    if begin >= start + piece:
        return begin, b""
    end = _after_line(file, start + piece)
    file.seek(begin)
    return begin, file.read(end - begin)


def _after_line(file: pa.NativeFile, at: int) -> int:
    """The first place from ``at`` on where a line begins, or the end of the file."""
    size = file.size()
    at -= 1  # a line feed just before begins one at ``at``
    while at < size:
        file.seek(at)
        some = file.read(_READ)
        if not some:
            break
        found = some.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(some)
    return size


def _by_reader(spark: SparkSession, root: str, content: bool) -> DataFrame:
    base = paths.absolute(spark, root).rstrip("/") + "/"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    files = found.select(
        _below(base, F.col("path")).alias("path"),
        F.col("modificationTime").alias("modified"),
        "length",
        "content",
    )
    return files if content else files.drop("content")


def _below(base: str, location: Column) -> Column:
    """The part of a file's location that follows ``base``, whatever the scheme."""
    path = F.regexp_replace(location, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.substr(path, F.lit(len(base) + 1))

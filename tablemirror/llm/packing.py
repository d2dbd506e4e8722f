"""Packing: concatenate and cut, by two-pass prefix sums (operator 10).

Pass one tokenises every document once, and each task keeps a running total: a row is
``(part, start in part, ids)``, written to the shared folder. Pass two sums the totals of the
parts, whose running sum gives each part its place in one stream of all tokens. The stream
is cut every ``window`` ids; a document that crosses a cut gives one boundary record (piece)
for each sequence that it lies in. Only the last sequence is padded.

Defined results: a null or empty text is the end id alone; repeated rows and null ids are
packed row by row; an empty table gives an empty table. Documents stay whole up to a cut.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablemirror.llm.common import give_back, ship, sliced, stored

WINDOW = 2048
END_ID = 1


class Tokenizer:
    """Ids of a byte-level BPE vocabulary in ``tokenizers`` JSON form.

    Ids are those of the tokenizers library with its defaults and without special tokens put
    around a text. The merges run in tiktoken, which gives the same ids from the same vocabulary
    (the tests hold the two against each other) in a fifth of the CPU time, for texts in which
    no added token of the JSON file (``<|endoftext|>``) is written out. Those texts, and all
    where the JSON file has no rank file beside it, go to the library itself.
    """

    def __init__(self, json_path: str, ranks_path: str | None, pattern: str | None):
        import tokenizers

        own = tokenizers.Tokenizer.from_file(json_path)

        def by_library(text: str) -> list[int]:
            return own.encode(text, add_special_tokens=False).ids

        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
            fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            added = [t.content for t in own.get_added_tokens_decoder().values()]
            self.ids = lambda text: (
                by_library(text) if any(t in text for t in added) else fast.encode_ordinary(text)
            )
        else:
            self.ids = by_library


_LOADED: dict[tuple, Tokenizer] = {}


def tokenizer(*paths) -> Tokenizer:
    """The tokenizer of this Python worker."""
    if paths not in _LOADED:
        _LOADED[paths] = Tokenizer(*paths)
    return _LOADED[paths]


def tokenise(
    docs: DataFrame, json_path: str, ranks_path: str | None = None, pattern: str | None = None,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Stored rows ``doc_id, part, start, n, ids``: little-endian 32-bit ids with the end id,
    and the ids that come before them in the same part."""
    ship(docs.sparkSession)
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {kept.dtypes[0][1]}, part long, start long, n long, ids binary"

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = tokenizer(json_path, ranks_path, pattern).ids
        part, start = TaskContext.get().partitionId(), 0
        for batch in (part_ for whole in rows for part_ in sliced(whole)):
            ids = [
                np.array([*ids_of(t or ""), END_ID], "<u4").tobytes()
                for t in batch.column(1).to_pylist()
            ]
            n = np.array([len(b) // 4 for b in ids], np.int64)
            ends = start + np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(n), part)), pa.array(ends - n),
                 pa.array(n), pa.array(ids, pa.binary())],
                ["doc_id", "part", "start", "n", "ids"],
            )
            start = int(ends[-1]) if len(n) else start
        del ids_of
        _LOADED.clear()  # some 100 MB, which the stages that follow in this worker have no use for
        give_back()

    return stored(kept.mapInArrow(batches, schema), "tokens")


def pack(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces of the tokens that ``tokenise`` has stored.

    ``doc_id, start`` (its document's ids before it)``, length, ids`` (little-endian)``,
    doc_tokens, sequence_id, offset``. One row per part, of which there are as many as tasks
    of the first pass, goes through the running sum.
    """
    totals = tokens.groupBy("part").agg(F.sum("n").alias("_total"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    places = totals.select(
        "part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before")
    )
    # one narrow row per task of the first pass: under 2 MB for a hundred thousand tasks
    placed = tokens.join(F.broadcast(places), "part").withColumn(
        "_at", F.col("_before") + F.col("start")
    )
    last = F.col("_at") + F.col("n") - 1
    cuts = F.sequence(
        F.floor(F.col("_at") / window).cast("long"), F.floor(last / window).cast("long")
    )
    pieces = placed.withColumn("sequence_id", F.explode(cuts))
    first = F.greatest(F.col("_at"), F.col("sequence_id") * window)
    after = F.least(last + 1, (F.col("sequence_id") + 1) * window)
    return pieces.select(
        "doc_id",
        (first - F.col("_at")).alias("start"),
        (after - first).alias("length"),
        F.substring(
            "ids",
            ((first - F.col("_at")) * 4 + 1).cast("int"),
            ((after - first) * 4).cast("int"),
        ).alias("ids"),
        F.col("n").alias("doc_tokens"),
        "sequence_id",
        (first - F.col("sequence_id") * window).alias("offset"),
    )

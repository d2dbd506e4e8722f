"""Exact top-k inner products by block-at-a-time pruning (operator 2).

Vectors are lists of integer weights of terms (dimensions). They are ordered by their
dominant term and cut into document-range blocks, each with its forward index (the weights)
and, for every term, the largest and smallest weight. For a query, the sum of the terms'
largest contributions bounds every score in a block; blocks are scored in the order of their
bounds until the next bound falls below the k-th score found.

On Spark, ranges of vectors meet chunks of queries: the (range, chunk) pairs are the groups,
each of bounded size, and each returns the best k of its range, which are merged per query.

Defined results: rows whose id or vector is null, or whose vector holds null or non-finite
components, take no part; a vector shorter than another counts as padded with zeros;
repeated rows are candidates of their own (only the query's own row is left out), and each
repeated query row has its own k results; equal scores go to the smaller id; an empty table
gives an empty table. Scores are exact while the sums of the
products' sizes stay below 2**53, which float64 holds (components up to some 180,000).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablemirror.llm.common import ship
from tablemirror.llm.sharding import ranked

K = 20
#: Vectors of a block.
BLOCK = 128
#: Vectors of a range and queries of a chunk, at most and at least.
RANGE, CHUNK = (2048, 131072), (512, 8192)


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``id`` and ``v``: floor(64 x) of every component; rows that take no part are left out."""
    x = F.transform(F.col(embedding), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        df.filter(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull())
        .filter(finite)
        .select(
            F.col(vec_id).cast("long").alias("id"),
            F.transform(x, lambda c: F.floor(c * 64).cast("long")).alias("v"),
        )
    )


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width))
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, place] = flat
    return out


class Blocks:
    """The block index of one range of vectors, in the order given."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, size: int = BLOCK):
        self.vectors, self.ids, self.rows, self.size = vectors, ids, rows, size
        starts = np.arange(0, len(ids), size)
        self.high = np.maximum.reduceat(vectors, starts)
        self.low = np.minimum.reduceat(vectors, starts)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int = K) -> tuple[np.ndarray, ...]:
        """Best k ``(scores, ids)`` of each query, ties to the smaller id; unused places have
        the score -inf. ``own`` holds the row of each query, which is no candidate.
        ``self.scored`` counts the blocks that were scored."""
        n = len(queries)
        bound = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        order = np.argsort(-bound, axis=1, kind="stable")
        best = np.full((n, k), -np.inf)
        best_id = np.full((n, k), np.iinfo(np.int64).max)
        live, self.scored = np.arange(n), 0
        for step in range(bound.shape[1]):
            block = order[live, step]
            open_ = bound[live, block] >= best[live, -1]  # an equal bound may win by its id
            live, block = live[open_], block[open_]
            if not len(live):
                break
            self.scored += len(live)
            for b in np.unique(block):
                asked = live[block == b]
                part = slice(b * self.size, (b + 1) * self.size)
                score = queries[asked] @ self.vectors[part].T
                score[self.rows[part][None, :] == own[asked][:, None]] = -np.inf
                all_scores = np.hstack([best[asked], score])
                all_ids = np.hstack([best_id[asked], np.broadcast_to(self.ids[part], score.shape)])
                pick = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
                best[asked] = np.take_along_axis(all_scores, pick, 1)
                best_id[asked] = np.take_along_axis(all_ids, pick, 1)
        return best, best_id


def search(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors`` that ``is_query`` selects.

    ``vectors`` has ``id`` and ``v``; ``is_query`` is a condition on them.
    """
    ship(vectors.sparkSession)
    index = F.array_position(F.transform("v", F.abs), F.array_max(F.transform("v", F.abs)))
    term = F.coalesce(index, F.lit(0)).cast("int")
    weight = F.when(term > 0, F.element_at("v", F.greatest(term, F.lit(1)))).otherwise(0)
    placed = ranked(
        vectors.select("id", "v", term.alias("_term"), weight.alias("_weight")), "_term", "_weight", "id"
    )
    counts = placed.agg(
        F.count("*"), F.sum(F.when(is_query, 1).otherwise(0)), F.max(F.size("v"))
    ).first()
    total, asked, width = counts[0], counts[1] or 0, max(counts[2] or 0, 1)
    per_range = min(max(RANGE[0], -(-total // 24)), RANGE[1])
    per_chunk = min(max(CHUNK[0], asked), CHUNK[1])
    n_ranges, n_chunks = max(1, -(-total // per_range)), max(1, -(-asked // per_chunk))
    candidates = placed.select(
        "rank", "id", "v", F.floor(F.col("rank") / per_range).cast("int").alias("range"),
        F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk"),
    )
    queries = placed.filter(is_query).select(
        "rank", "id", "v", F.explode(F.sequence(F.lit(0), F.lit(n_ranges - 1))).alias("range"),
        F.pmod(F.xxhash64("rank"), F.lit(n_chunks)).cast("int").alias("chunk"),
    )

    def meet(group: pa.Table) -> pa.Table:
        left, right = group.filter(pc.invert(group["asks"])), group.filter(group["asks"])
        out = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            left = left.sort_by("rank")
            blocks = Blocks(
                _matrix(left["v"], width), left["id"].to_numpy(), left["rank"].to_numpy()
            )
            rows, ids = right["rank"].to_numpy(), right["id"].to_numpy()
            asked_for = _matrix(right["v"], width)
            for start in range(0, len(rows), 1024):
                part = slice(start, start + 1024)
                score, found = blocks.search(asked_for[part], rows[part], k)
                hit = score > -np.inf
                out["query_row"].append(np.repeat(rows[part], hit.sum(axis=1)))
                out["query_id"].append(np.repeat(ids[part], hit.sum(axis=1)))
                out["vec_id"].append(found[hit])
                out["score"].append(score[hit].astype(np.int64))
        return pa.table({c: np.concatenate(p) if p else np.array([], np.int64) for c, p in out.items()})

    both = candidates.withColumn("asks", F.lit(False)).unionByName(queries.withColumn("asks", F.lit(True)))
    met = both.groupBy("range", "chunk").applyInArrow(
        meet, "query_row long, query_id long, vec_id long, score long"
    )
    place = F.row_number().over(W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Quality classifier: histogram gradient-boosted trees over document statistics (operator 11).

Every statistic is cut into at most ``BINS`` bins at quantiles of the sample. A tree grows leaf by
leaf, always the one whose best split gains most; the gradient sums of all bins of all statistics
of a leaf come from one ``bincount``, and of two new leaves only the smaller is counted: the
other is its parent less its sibling. The number of trees is the one with the least loss on a part
of the sample that the trees have not seen. The forest is flattened into numpy arrays, and a batch
of documents walks all trees at once, level by level.

Rows weigh as many labels as they stand for, so that scores are shares of label 1 whatever part
of the labels the bound of the sample has cut.

Defined results: a null text is as an empty one, and empty texts are scored by their statistics,
which are all zero; repeated rows get equal scores; of several labels of one document the smallest
counts, labels other than 0 and 1 do not; with labels of one kind only, every score is that label's
share (0.5 without labels); an empty table gives an empty table. Columns other than those named
are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemirror.llm.common import WORD, arrow_map

#: Labelled documents, and rows of them, that the trees are fitted on at most: half of either kind.
MAX_FIT_ROWS = 16384
BINS = 64
TREES, LEAVES, RATE, PENALTY, LEAST_HESSIAN = 200, 12, 0.1, 1.0, 2.0
#: The part of the sample that chooses the number of trees: one row in so many.
HELD_BACK = 5
#: Trees without a better loss after which growing ends.
PATIENCE = 20

STATISTICS = (
    "words", "characters", "word_length", "word_length_spread", "distinct_words", "most_frequent_word",
    "repeated_pairs", "repeated_triples", "longest_word", "lines", "words_a_line", "repeated_lines",
    "closed_lines", "upper_case", "digits", "sentence_marks", "other_marks", "symbols", "beyond_ascii",
    "entropy", "wordless",
)
_CLASS = {
    "upper": bytes(range(65, 91)), "digit": b"0123456789", "sentence": b".,;:?!'\"", "other": b"()[]-_/",
    "symbol": b"#*$%&|<>@\\^`{}~=+",
}
_LETTER = re.compile(r"[^\W\d_]")


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text, in the order of ``STATISTICS``."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    data = np.frombuffer(text.encode(), np.uint8)
    bytes_ = np.bincount(data, minlength=256)
    share = bytes_[bytes_ > 0] / len(data)
    dark = len(data) - bytes_[[9, 10, 11, 12, 13, 32]].sum()
    of = {name: bytes_[list(chars)].sum() / dark for name, chars in _CLASS.items()}
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)

    def repeated(*shifted) -> float:
        found = Counter(zip(*shifted))
        total = sum(found.values())
        return 1 - len(found) / total if total else 0.0

    lines = [x for x in (line.strip(" \t\r\v\f") for line in text.split("\n")) if x]
    return [
        float(n), float(len(text)), float(lengths.mean()), float(lengths.std()),
        len(counts) / n, max(counts.values()) / n,
        repeated(words, words[1:]), repeated(words, words[1:], words[2:]), float(lengths.max()),
        float(len(lines)), n / len(lines), 1 - len(set(lines)) / len(lines),
        sum(x[-1] in ".!?:;\"')" for x in lines) / len(lines),
        of["upper"], of["digit"], of["sentence"], of["other"], of["symbol"],
        bytes_[192:].sum() / dark, float(-(share * np.log2(share)).sum()),
        sum(_LETTER.search(w) is None for w in words) / n,
    ]


# ---------------------------------------------------------------- trees


@dataclass
class Forest:
    """Nodes of all trees in arrays; a leaf is its own child on both sides."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        x = np.asarray(x, float)
        if not len(x):
            return np.empty(0)
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))[:, None]
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(self.depth):
            low = x[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(low, self.left[node], self.right[node])
        total += self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def bin_edges(column: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Values that end a bin: a row is in the first bin whose end is not below it."""
    values = np.unique(column)
    if len(values) > bins:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1), method="lower"))
    return values[:-1]  # the last bin has no end


class _Leaf:
    def __init__(self, node: int, rows: np.ndarray, depth: int, sums: np.ndarray):
        self.node, self.rows, self.depth, self.sums = node, rows, depth, sums
        self.gain, self.feature, self.bin = 0.0, -1, -1


def best_split(sums: np.ndarray, penalty: float = PENALTY, least: float = LEAST_HESSIAN) -> tuple[float, int, int]:
    """Gain, statistic and last left bin of the best split, from ``sums[statistic, bin, (g, h)]``."""
    left = sums.cumsum(axis=1)
    whole = left[:, -1:, :]
    g, h, rest_g, rest_h = left[..., 0], left[..., 1], whole[..., 0] - left[..., 0], whole[..., 1] - left[..., 1]
    gain = g**2 / (h + penalty) + rest_g**2 / (rest_h + penalty) - whole[..., 0] ** 2 / (whole[..., 1] + penalty)
    gain = np.where((h < least) | (rest_h < least), 0.0, gain)
    at = int(gain.argmax())
    return float(gain.flat[at]), at // gain.shape[1], at % gain.shape[1]


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, trees: int = TREES, leaves: int = LEAVES) -> Forest:
    """A boosted forest for 0/1 labels, of the number of trees that fits unseen rows best."""
    rows_, width = x.shape
    weight = np.ones(rows_) if weight is None else weight * (rows_ / weight.sum())
    unseen = np.arange(rows_) % HELD_BACK == HELD_BACK - 1
    if min(y[unseen].sum(), (1 - y[unseen]).sum()) < 8:  # too few rows to choose by
        unseen[:] = False
    edges = [bin_edges(x[:, j]) for j in range(width)]
    size = max(len(e) for e in edges) + 1
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    flat = binned + size * np.arange(width)
    share = np.clip((weight * y).sum() / weight.sum(), 1e-6, 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    margin = np.full(rows_, base)
    nodes: list[list[float]] = []  # statistic, threshold, left, right, value
    roots: list[int] = []
    deepest, best_loss, best_trees = 1, np.inf, 0
    ends: list[int] = []

    def histogram(rows: np.ndarray) -> np.ndarray:
        cells = flat[rows].ravel()
        return np.stack(
            [np.bincount(cells, np.repeat(v[rows], width), width * size).reshape(width, size) for v in (grad, hess)],
            axis=2,
        )

    def leaf(rows: np.ndarray, depth: int, sums: np.ndarray) -> _Leaf:
        g, h = grad[rows].sum(), hess[rows].sum()
        me = len(nodes)
        nodes.append([0, 0.0, me, me, -RATE * g / (h + PENALTY)])
        found = _Leaf(me, rows, depth, sums)
        found.gain, found.feature, found.bin = best_split(sums)
        return found

    seen = np.flatnonzero(~unseen)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
        grad, hess = (p - y) * weight, np.maximum(p * (1 - p), 1e-6) * weight
        root = leaf(seen, 0, histogram(seen))
        roots.append(root.node)
        open_ = [root]
        while len(open_) < leaves:
            top = max(open_, key=lambda k: k.gain)
            if top.gain <= 1e-6:
                break
            open_.remove(top)
            low = binned[top.rows, top.feature] <= top.bin
            parts = [top.rows[low], top.rows[~low]]
            small = int(len(parts[1]) < len(parts[0]))
            sums = histogram(parts[small])
            both = [None, None]
            both[small], both[1 - small] = sums, top.sums - sums
            children = [leaf(r, top.depth + 1, s) for r, s in zip(parts, both, strict=True)]
            nodes[top.node][:4] = [top.feature, edges[top.feature][top.bin], children[0].node, children[1].node]
            deepest = max(deepest, top.depth + 1)
            open_ += children
        ends.append(len(nodes))
        tree = _flat(nodes[root.node :], [0], deepest, 0.0, shift=root.node)
        margin += _margins(tree, x)
        if unseen.any():
            m = np.clip(margin[unseen], -40, 40)
            loss = float((weight[unseen] * (np.logaddexp(0, m) - y[unseen] * m)).sum())
            if loss < best_loss - 1e-9:
                best_loss, best_trees = loss, len(roots)
            elif len(roots) - best_trees >= PATIENCE:
                break
    if unseen.any():
        roots, nodes = roots[:best_trees], nodes[: ends[best_trees - 1]] if best_trees else nodes[:0]
    return _flat(nodes, roots, deepest, base)


def _flat(nodes: list[list[float]], roots: list[int], depth: int, base: float, shift: int = 0) -> Forest:
    table = np.array(nodes, float).reshape(-1, 5)
    left, right = (table[:, k].astype(np.int64) - shift for k in (2, 3))
    return Forest(
        table[:, 0].astype(np.int64), table[:, 1], left, right, table[:, 4], np.array(roots, np.int64), depth, base
    )


def _margins(forest: Forest, x: np.ndarray) -> np.ndarray:
    node = np.full(len(x), forest.roots[0])
    rows = np.arange(len(x))
    for _ in range(forest.depth):
        low = x[rows, forest.feature[node]] <= forest.threshold[node]
        node = np.where(low, forest.left[node], forest.right[node])
    return forest.value[node]


# ---------------------------------------------------------------- operator


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> Forest | float:
    """Trees for ``labels.quality``; a bare share of label 1 where one kind is missing.

    The sample holds the labelled ids with the smallest hashes, at most half of ``max_rows`` of each
    kind, and at most ``max_rows`` rows however often an id is repeated. All else of the labels
    enters through counts, which cover every row.
    """
    named = (
        labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    counts = {r[0]: r[1] for r in named.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return float(next(iter(counts), 0.5))
    half = max_rows // 2
    parts = [
        named.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(half) for q in (0, 1)
    ]
    # bounded by max_rows, hence small enough to broadcast at any size of the corpus
    sample = docs.select("doc_id", "text").join(F.broadcast(parts[0].union(parts[1])), "doc_id")

    def each(ids, texts, quality):
        return [ids, quality, [statistics(t) for t in texts]]

    rows = (
        arrow_map(sample.select(F.xxhash64("doc_id"), "text", F.col("quality").cast("int")), each, "h long, y int, x array<double>")
        .orderBy(F.xxhash64("h", "x"), "h", "x").limit(max_rows).collect()
    )
    y = np.array([r.y for r in rows], float)
    if not len(y) or y.min() == y.max():
        return float(counts[1] / (counts[0] + counts[1]))
    stands_for = np.array([counts[q] / max((y == q).sum(), 1) for q in (0, 1)])
    return grow(np.array([r.x for r in rows]), y, stands_for[y.astype(int)])


def score(docs: DataFrame, forest: Forest | float, *keep: str, text: str = "text") -> DataFrame:
    """Columns ``keep`` and ``score`` of every whole text."""
    kept = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    types = "".join(f"{c} {t}, " for c, t in kept.dtypes[:-1])

    def each(*cols):
        if isinstance(forest, float):
            return [*cols[:-1], [forest] * len(cols[-1])]
        return [*cols[:-1], forest.score(np.array([statistics(t) for t in cols[-1]])).tolist()]

    return arrow_map(kept, each, types + "score double").toDF(*keep, "score")

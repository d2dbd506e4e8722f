"""Quality rules: gradient-boosted trees over document statistics (operator 9).

Trees are grown by Newton boosting on quantile bins of a bounded sample of labelled rows,
with monotonic constraints: more symbols, repeated lines or repeated words never raise the
score. The forest is flattened into numpy node arrays, and every document is scored by
walking all trees level by level for a whole batch at once.

Defined results: a null or empty text has no words and fails the base rule; documents
without an id are scored like all others; repeated rows get equal verdicts; labels that are
null are left out, and of several labels of one document the smallest counts; an empty
table gives an empty table; without labels of both kinds the base rule alone decides.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemirror.llm.common import WORD, arrow_map

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Labelled ids whose documents the trees are fitted on at most; all rows are scored. Where ids are
#: repeated, up to twice as many rows of them.
MAX_FIT_ROWS = 8192
#: Share of good rows of the sample, at most, that may fall below the threshold.
MAX_GOOD_LOST = 0.002

FEATURES = {  # name: sign of the monotonic constraint on the score
    "n_words": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_word_share": -1,
    "mean_word_chars": 0,
    "distinct_word_share": 0,
    "upper_share": 0,
    "digit_share": 0,
    "words_per_line": 0,
    "sentence_end_share": 0,
    "wordless_share": -1,
    "exclaim_share": 0,
}
_UPPER, _DIGIT = re.compile("[A-Z]"), re.compile("[0-9]")
_ALPHA = re.compile(r"[^\W\d_]")

STATS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "features array<double>"
)


def repeated_words(words: list[str]) -> int:
    """Words that lie in a three-word window found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[str, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    size = len(ids)
    pair = code[:-1] * size + code[1:]
    if size >= 1 << 20:  # keep the product of three codes within 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, place, count = np.unique(pair[:-1] * size + code[2:], return_inverse=True, return_counts=True)
    hit = count[place] > 1
    if not hit.any():
        return 0
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= hit
    return int(covered.sum())


def text_stats(text: str | None) -> tuple:
    """The five counts of the contract, then the features of the trees."""
    text = text or ""
    words = WORD.findall(text)
    n, chars = len(words), sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    lines, dup, ended = set(), 0, 0
    n_lines = 0
    for line in text.split("\n"):
        bare = line.strip(" \t\r\v\f")
        if bare:
            n_lines += 1
            ended += bare[-1] in ".!?:;\"')"
            dup += line in lines
            lines.add(line)
    repeat = repeated_words(words)
    w, c, k = max(n, 1), max(chars, 1), max(n_lines, 1)
    features = [
        float(n),
        symbols / w,
        dup / k,
        repeat / w,
        chars / w,
        len(set(words)) / w,
        len(_UPPER.findall(text)) / c,
        len(_DIGIT.findall(text)) / c,
        n / k,
        ended / k,
        sum(_ALPHA.search(x) is None for x in words) / w,
        text.count("!") / w,
    ]
    return n, chars, symbols, dup, repeat, features


def document_stats(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """Columns ``keep`` and the statistics of every whole text."""
    kept = docs.select(*keep, F.col(text).alias("_text"))
    types = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes[:-1])

    def each(*cols):
        return [*cols[:-1], *zip(*map(text_stats, cols[-1]), strict=True)]

    return arrow_map(kept, each, f"{types}, {STATS}" if types else STATS)


# ---------------------------------------------------------------- trees


@dataclass
class Forest:
    """All trees as node arrays of one length; ``left[i] == i`` marks a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float
    cut: float = 0.5

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality for each row of ``x``."""
        rows = np.arange(len(x))[:, None]
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(self.depth):
            low = x[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(low, self.left[node], self.right[node])
        total = self.base + self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def grow(
    x: np.ndarray,
    y: np.ndarray,
    signs: list[int],
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    penalty: float = 1.0,
) -> Forest:
    """Boosted trees for 0/1 labels; rows of the rarer label weigh as much as the others."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    share = y.mean()
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots, margin = [], np.zeros(n)

    def leaf(g, h, low, high):
        return float(np.clip(-g / (h + penalty), low, high))

    def build(rows, level, low, high):
        me = len(nodes)
        g, h = grad[rows].sum(), hess[rows].sum()
        value = leaf(g, h, low, high)
        nodes.append([0, 0.0, me, me, value * rate])
        margin[rows] += 0.0
        best = (1e-6, None)
        if level < depth:
            for j in range(width):
                size = len(edges[j]) + 1
                if size < 2:
                    continue
                gl = np.cumsum(np.bincount(binned[rows, j], grad[rows], size))[:-1]
                hl = np.cumsum(np.bincount(binned[rows, j], hess[rows], size))[:-1]
                wl = np.clip(-gl / (hl + penalty), low, high)
                wr = np.clip(-(g - gl) / (h - hl + penalty), low, high)
                gain = gl**2 / (hl + penalty) + (g - gl) ** 2 / (h - hl + penalty) - g**2 / (h + penalty)
                gain = np.where((hl < 1) | (h - hl < 1) | ((wr - wl) * signs[j] < 0), 0, gain)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (j, k, wl[k], wr[k]))
        if best[1] is None:
            margin[rows] += value * rate
            return me
        j, k, wl, wr = best[1]
        middle = (wl + wr) / 2
        left_range, right_range = (low, high), (low, high)
        if signs[j] > 0:
            left_range, right_range = (low, middle), (middle, high)
        elif signs[j] < 0:
            left_range, right_range = (middle, high), (low, middle)
        inside = binned[rows, j] <= k
        nodes[me][:2] = [j, edges[j][k]]
        nodes[me][2] = build(rows[inside], level + 1, *left_range)
        nodes[me][3] = build(rows[~inside], level + 1, *right_range)
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = (p - y) * weight, np.maximum(p * (1 - p), 1e-6) * weight
        roots.append(build(np.arange(n), 0, -np.inf, np.inf))
    flat = np.array(nodes)
    return Forest(
        flat[:, 0].astype(np.int64), flat[:, 1], flat[:, 2].astype(np.int64),
        flat[:, 3].astype(np.int64), flat[:, 4], np.array(roots), depth, 0.0,
    )


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> Forest | None:
    """Trees for ``labels.quality``, from at most ``max_rows`` labelled documents.

    The sample holds the rows with the smallest hash of their id, half of it for each label
    as far as there are that many. Four folds give the threshold: the highest one, not over
    0.5, that costs no more than MAX_GOOD_LOST of the good rows scored by trees that have
    not seen them.
    """
    named = (
        labels.filter("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    chosen = None
    for q in (0, 1):
        part = named.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows // 2)
        chosen = part if chosen is None else chosen.union(part)
    # bounded by max_rows, hence small enough to broadcast at any size of the corpus
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = (
        document_stats(sample, "doc_id", "quality")
        .select("doc_id", "quality", "features")
        .orderBy(F.xxhash64("doc_id"), "features")
        .limit(2 * max_rows)
        .collect()
    )
    y = np.array([r.quality for r in rows], float)
    if not len(y) or y.min() == y.max():
        return None
    x = np.array([r.features for r in rows])
    signs = list(FEATURES.values())
    fold, seen = np.arange(len(y)) % 4, np.full(len(y), np.nan)
    for k in range(4):
        inside = y[fold != k]
        if len(inside) and inside.min() != inside.max():
            seen[fold == k] = grow(x[fold != k], inside, signs).score(x[fold == k])
    forest = grow(x, y, signs)
    good = seen[(y == 1) & ~np.isnan(seen)]
    if len(good):
        forest.cut = float(min(0.5, np.quantile(good, MAX_GOOD_LOST)))
    return forest


def judge(docs: DataFrame, forest: Forest | None, *keep: str, text: str = "text") -> DataFrame:
    """Columns ``keep``, the statistics, ``base_failed``, ``score`` and ``kept``."""
    kept = docs.select(*keep, F.col(text).alias("_text"))
    types = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes[:-1])
    schema = (
        f"{types}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, score double, kept boolean"
    )

    def each(*cols):
        *counts, features = zip(*map(text_stats, cols[-1]), strict=True)
        failed = [n < MIN_WORDS or 100 * r > 50 * n for n, r in zip(counts[0], counts[4], strict=True)]
        score = np.ones(len(failed)) if forest is None else forest.score(np.array(features))
        cut = 0.0 if forest is None else forest.cut
        return [*cols[:-1], *counts, failed, score, ~np.array(failed) & (score >= cut)]

    return arrow_map(kept, each, schema)


def accepted(docs: DataFrame, forest: Forest | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    numbered = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)])
    judged = judge(numbered, forest, *names, text=names[docs.columns.index(text)])
    return judged.filter("kept").select(*names).toDF(*docs.columns)

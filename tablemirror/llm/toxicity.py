"""Toxicity by compression distance (operator 4).

Two zstandard dictionaries are trained, one on ordinary and one on toxic text. A text is cut
into windows of words; a window that the toxic dictionary compresses to fewer bytes than the
ordinary one is closer to toxic text. Both dictionaries hold the same ordinary content, so that
what is common to all text costs about the same in both and the difference of the lengths comes
from toxic segments. A calibrated logistic scale over thresholds of the window differences gives
the score.

zstandard's trainer picks segments by frequency, and most of toxic text is ordinary. So the toxic
part is trained on what ordinary text does not explain: of the windows of toxic documents only
words stay whose beginning (``BEGINNINGS`` letters), or which with their neighbour, is ``RATIO``
times as common in toxic documents as in ordinary ones, by more than chance: the log-likelihood
ratio of its counts is one that not one of twenty samples would show for any of all the
beginnings, or of all the pairs of words, that were tested. What the dictionary holds is then the
trainer's choice: whole words, stems with their endings, parts of both. Near copies of a document
of the sample bear witness once: a few of one toxic text would else make all its words telling.

Case marks where a word begins: all text is lower-cased, then the first ``MARKED`` letters of each word
are written in capitals, so a beginning does not match the middle of another word.

Defined results: null and empty texts have no window and get the score of a text without
toxic windows; repeated rows get equal scores; of several labels of one document the largest
counts; without labelled documents of both kinds, and only then, every score is the share of
toxic labels (0 if none);
an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemirror.llm.common import LETTERS, arrow_map, ship
from tablemirror.llm.jaccard import shingle_sets

#: Words in a window.
WINDOW = 8
#: Letters at the beginning of a word that are written in capitals.
MARKED = 6
#: Lengths of the beginnings of words that are counted.
BEGINNINGS = (4, 5, 6)
#: Labelled documents of each kind that the dictionaries and the scale are fitted on at most.
MAX_FIT_ROWS = 8192
#: Windows that either part of the dictionaries is trained on at most.
MAX_FIT_WINDOWS = 1 << 15
#: Beginnings and pairs of words that are kept at most, of either.
MAX_TELLING = 4096
RATIO, CHANCE = 3.0, 0.05
#: Pairs of least hashes of which near copies share one: at a Jaccard similarity of 0.8, 0.5, 0.2 of
#: their word 5-grams with a probability of 0.998, 0.82, 0.22.
BANDS = 6
_FACTORS = np.random.default_rng(4).integers(1, 1 << 63, 2 * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ORDINARY_BYTES, TOXIC_BYTES = 2048, 1 << 13
#: Sizes of segments and of the strings they are found by, for the trainer.
SEGMENT, PART = 48, 6
#: The three offsets that stand between the tables and the content of a new dictionary.
_OFFSETS = b"".join(n.to_bytes(4, "little") for n in (1, 4, 8))
#: Greedy search for matches of five bytes and more, in tables that fit windows of some 50
#: bytes; the levels of the library look for longer matches at this size.
SEARCH = {
    "strategy": zstandard.STRATEGY_GREEDY, "min_match": 5, "search_log": 5, "target_length": 32,
}
THRESHOLDS = (1, 2, 3, 4, 6, 8)


def _window(words: list[str]) -> bytes:
    marked = " ".join([w[:MARKED].upper() + w[MARKED:] for w in words])
    return f" {marked} ".encode("utf-8", "replace")


def _cut(text: str | None) -> list[list[str]]:
    words = LETTERS.findall((text or "").lower())
    return [words[i : i + WINDOW] for i in range(0, len(words), WINDOW)]


def windows(text: str | None) -> list[bytes]:
    return [_window(words) for words in _cut(text)]


def _compressor(content: bytes):
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    log = max(13, (len(content) - 1).bit_length())  # a place in the tables for every byte
    how = zstandard.ZstdCompressionParameters(
        write_checksum=False, write_dict_id=False, hash_log=log, chain_log=log, window_log=log + 1, **SEARCH
    )
    held.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=how)


def _lengths(compressor, blocks: list[bytes]) -> np.ndarray:
    packed = compressor.multi_compress_to_buffer(blocks, threads=0)
    return np.fromiter((len(packed[i]) for i in range(len(packed))), np.int64, len(blocks))


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray  # one per feature, the intercept last
    mean: np.ndarray
    scale: np.ndarray

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Per text: the largest differences, their mean, and shares over each threshold."""
        if not hasattr(self, "_pair"):
            self._pair = (
                _compressor(b"\0" * len(self.toxic) + self.ordinary),
                _compressor(self.toxic + self.ordinary),
            )
        out = np.zeros((len(texts), 3 + 2 * len(THRESHOLDS)))
        for start in range(0, len(texts), 256):
            cut = [windows(t) for t in texts[start : start + 256]]
            blocks = [w for ws in cut for w in ws]
            if not blocks:
                continue
            gain = _lengths(self._pair[0], blocks) - _lengths(self._pair[1], blocks)
            at = 0
            for i, ws in enumerate(cut, start):
                if ws:
                    g = np.sort(gain[at : at + len(ws)])[::-1]
                    at += len(ws)
                    over = [(g >= t).sum() for t in THRESHOLDS]
                    out[i] = [
                        g[0], g[:3].mean(), g.mean(),
                        *(min(n, 10) for n in over), *(n / len(ws) for n in over),
                    ]
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = (self.features(texts) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -40, 40)))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_pair"}


def _logistic(
    x: np.ndarray, y: np.ndarray, penalty: float = 4.0, weight: np.ndarray | float = 1.0
) -> np.ndarray:
    """Ridge logistic regression of weighted rows by Newton steps; the intercept is free."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            (x.T * (weight * p * (1 - p) + 1e-9)) @ x + ridge, x.T @ (weight * (p - y)) + ridge @ w
        )
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _named(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of every labelled id."""
    return (
        labels.filter("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )


def _sample(docs: DataFrame, named: DataFrame, max_rows: int) -> DataFrame:
    """``doc_id, text, toxic`` of labelled documents, at most ``max_rows`` ids of each kind."""
    parts = [
        named.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
        for t in (0, 1)
    ]
    # bounded by max_rows, hence small enough to broadcast at any size of the corpus
    rows = docs.select("doc_id", "text").join(F.broadcast(parts[0].union(parts[1])), "doc_id")
    # an id that is repeated counts once, so that the bound holds for rows too
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic"))


def _bands(text: str | None) -> list[int]:
    """Hashes, one of each band, that near copies mostly share; none for a text without words."""
    (shingles,) = shingle_sets([text])
    if not len(shingles):
        return []
    least = np.array([(shingles * f).min() for f in _FACTORS])
    mixed = least[::2] ^ (least[1::2] * _FACTORS[0] >> np.uint64(1))
    return mixed.view(np.int64).tolist()


def _apart(sample: DataFrame) -> DataFrame:
    """``sample`` with one of each group of near copies of a kind: rows that share a band with a
    smaller id of their kind are left out."""
    types = dict(sample.dtypes)

    def each(ids, toxic, texts):
        return [ids, toxic, [_bands(t) for t in texts]]

    marked = arrow_map(
        sample.select("doc_id", "toxic", "text"), each, f"doc_id {types['doc_id']}, toxic int, bands array<long>"
    )
    banded = marked.select("doc_id", "toxic", F.posexplode("bands").alias("place", "band"))
    first = banded.groupBy("toxic", "place", "band").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    copies = banded.join(first.filter("n > 1"), ["toxic", "place", "band"]).filter("doc_id > first")
    return sample.join(copies.select("doc_id").distinct(), "doc_id", "left_anti")


def _beginnings(word: str) -> list[str]:
    return [word[:k] for k in BEGINNINGS if len(word) >= k]


def _pairs(words: list[str]) -> list[str]:
    return [f"{x} {y}" for x, y in zip(words, words[1:])]


def _telling(sample: DataFrame) -> set[str]:
    """Beginnings and pairs of words that are more common in toxic documents than chance allows."""

    def each(texts, toxic):
        counts: dict[str, list[int]] = {}
        for t, y in zip(texts, toxic, strict=True):
            words = LETTERS.findall((t or "").lower())
            for b in {*_pairs(words), *(b for w in set(words) for b in _beginnings(w))}:
                counts.setdefault(b, [0, 0])[y] += 1
        return [list(counts), [c[1] for c in counts.values()], [c[0] for c in counts.values()]]

    counted = (
        arrow_map(sample.select("text", "toxic"), each, "word string, n_toxic long, n_ordinary long")
        .groupBy("word", F.contains("word", F.lit(" ")).alias("pair"))
        .agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_ordinary").alias("n_ordinary"))
    )
    kinds = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    toxic, ordinary = kinds.get(1, 0), kinds.get(0, 0)
    if not toxic or not ordinary:
        return set()
    every, a, b = toxic + ordinary, F.col("n_toxic"), F.col("n_ordinary")

    def part(n, size):  # n log(n / expected), 0 for none
        return F.when(n > 0, n * F.log(n * every / ((a + b) * size))).otherwise(0.0)

    common = a * ordinary >= RATIO * b * toxic
    scored = counted.select("word", "pair", F.when(common, 2 * (part(a, toxic) + part(b, ordinary))).alias("g"))
    # how many of either kind were tested, and those that may pass: chance alone exceeds g
    # with a probability below exp(-g / 2)
    tests = {r["pair"]: r["n"] for r in scored.groupBy("pair").agg(F.count("*").alias("n")).collect()}
    out: set[str] = set()
    for pair, n in tests.items():
        least = float(2 * np.log(n / CHANCE))
        kept = scored.filter((F.col("pair") == pair) & (F.col("g") >= least))
        out |= {r.word for r in kept.orderBy(F.desc("g"), "word").limit(MAX_TELLING).collect()}
    return out


def _left_over(words: list[str], telling: set[str]) -> list[str]:
    """The words that begin or pair as only toxic words do."""
    alone = [not telling.isdisjoint(_beginnings(w)) for w in words]
    both = [not (x or y) and p in telling for x, y, p in zip(alone, alone[1:], _pairs(words))]
    near = [x or y for x, y in zip([False, *both], [*both, False], strict=True)] if words else []
    return [w for w, x, y in zip(words, alone, near, strict=True) if x or y]


def _fit_windows(sample: DataFrame, each) -> list[bytes]:
    found = arrow_map(sample, each, "w binary").filter(F.length("w") > 2)
    # in the order of their hash: zstandard's trainer takes segments from one stretch of the windows after
    # another and ends after some that give nothing new, so that in order of text it misses the last words
    return [bytes(r.w) for r in found.orderBy(F.xxhash64("w"), "w").limit(MAX_FIT_WINDOWS).collect()]


def _plain_windows(sample: DataFrame, toxic: int, telling: set[str]) -> list[bytes]:
    """One window without telling words of each document of a kind, at a place given by its hash."""
    import zlib

    def each(texts):
        cut = [[_window(words) for words in _cut(t) if not _left_over(words, telling)] for t in texts]
        return [[ws[zlib.crc32(ws[0]) % len(ws)] if ws else b"" for ws in cut]]

    return _fit_windows(sample.filter(F.col("toxic") == toxic).select("text"), each)


def _toxic_windows(sample: DataFrame, telling: set[str]) -> list[bytes]:
    """Windows of the toxic documents' words that begin as only toxic words do."""

    def each(texts):
        out = []
        for t in texts:
            words = _left_over(LETTERS.findall((t or "").lower()), telling)
            out += [_window(words[i : i + WINDOW]) for i in range(0, len(words), WINDOW)]
        return [out]

    return _fit_windows(sample.filter("toxic = 1").select("text"), each)


def _trained(blocks: list[bytes], size: int) -> bytes:
    """The content of a dictionary that zstandard has trained on ``blocks``, without its tables."""
    try:
        made = zstandard.train_dictionary(size, blocks, k=SEGMENT, d=PART).as_bytes()
        at = made.find(_OFFSETS)
        return made[at + len(_OFFSETS) :] if at >= 0 else made
    except (zstandard.ZstdError, ValueError):  # too few samples to train on
        return b"".join(blocks)[-size:]


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> Model | float:
    """A model for ``labels.toxic``; a bare share of toxic labels if only one kind is there.

    Three quarters of the sample, without near copies, train the dictionaries, the rest the scale, so
    that the scale is fitted on texts that the dictionaries have not seen. Where one of the two parts
    lacks a kind, the whole sample does both. The rows of the scale weigh as many labels as they
    stand for, so that its intercept does not depend on which kind ``max_rows`` has cut.
    """
    ship(docs.sparkSession)
    named = _named(labels)
    counts = {r[0]: r[1] for r in named.groupBy("toxic").count().collect()}
    sample = _sample(docs, named, max_rows).persist()
    held = [sample]
    try:
        quarter = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 3
        cells = {(r[0], r[1]) for r in sample.select("toxic", quarter).distinct().collect()}
        if len({toxic for toxic, _ in cells}) < 2:
            return float(sample.agg(F.coalesce(F.avg("toxic"), F.lit(0.0))).first()[0])
        whole = len(cells) < 4
        learn, scale = (sample, sample) if whole else (sample.filter(~quarter), sample.filter(quarter))
        learn = _apart(learn).persist()
        held.append(learn)
        telling = _telling(learn)
        left = _toxic_windows(learn, telling) if telling else _plain_windows(learn, 1, telling)
        common = _trained(_plain_windows(learn, 0, telling), ORDINARY_BYTES) or b"\0" * 8
        special = _trained(left, TOXIC_BYTES) or b"\0" * 8
        width = 3 + 2 * len(THRESHOLDS)
        model = Model(common, special, np.zeros(width + 1), np.zeros(width), np.ones(width))

        def each(texts, labels_):
            return [labels_, [f.tolist() for f in model.features(texts)]]

        rows = arrow_map(
            scale.select("text", "toxic"), each, "toxic int, f array<double>"
        ).collect()
    finally:
        for table in held:
            table.unpersist()
    y = np.array([r.toxic for r in rows], float)
    x = np.array([r.f for r in rows])
    order = np.lexsort(np.column_stack([y, x]).T)
    x, y = x[order], y[order]
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    stands_for = [counts[k] / min(counts[k], max_rows) for k in (0, 1)]
    weight = np.where(y == 1, stands_for[1], stands_for[0])
    weight *= weight.sum() / (weight**2).sum()  # uneven weights tell as much as fewer even ones
    model.weights = _logistic((x - model.mean) / model.scale, y, weight=weight)
    return model


def score(docs: DataFrame, model: Model | float, *keep: str, text: str = "text") -> DataFrame:
    """Columns ``keep`` and ``score`` of every whole text."""
    kept = docs.select(*keep, F.col(text).alias("_text"))
    types = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes[:-1])

    def each(*cols):
        if isinstance(model, float):
            return [*cols[:-1], [model] * len(cols[-1])]
        return [*cols[:-1], model.score(cols[-1]).tolist()]

    return arrow_map(kept, each, f"{types}, score double" if types else "score double")

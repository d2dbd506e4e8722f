"""Language of every word by a linear-chain conditional random field (operator 5).

Each word has features: its character bigrams and trigrams, its affixes, and itself if it is
in the lexicon of the fitted sample. Their weights give one score per language, learned
transitions tie neighbouring words, and forward-backward gives each word's probabilities,
so that code-switched text is labelled word by word. A document's language is the one with
the largest sum of word probabilities.

Words are runs of letters; a run of more than ``MAX_CHARS`` (scripts without spaces, unbroken
text) is consecutive words of ``MAX_CHARS`` letters and a last one of the rest, in fitting and
labelling alike. Chains are runs of at most ``CHAIN`` words of a text; every word of the whole
text is in one.
Features are hashed into a table of ``SLOTS`` rows. The sample is bounded: from each learned
language some ``DOCS_PER_LANGUAGE`` documents, chosen by the hash of their id, one run of
words from each at a place given by its hash; a part of the runs is spliced from two
documents, which shows the transitions what a switch looks like.

Defined results: null and letterless texts are ``und`` with score 0; without learned
languages every text is; repeated rows get equal results; documents with a null language
are labelled but not learned from; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemirror.llm.common import LETTERS, arrow_map

CHAIN = 128
SLOTS = 1 << 17
DOCS_PER_LANGUAGE = 1500
RUN = 24  # words of a run in the sample
MAX_CHARS = 24  # letters of a word at most; longer runs of letters are several words
SPLICED = 0.3  # share of runs made of two documents
LEXICON_COUNT = 3

_WORD = re.compile(f"(?:{LETTERS.pattern.removesuffix('+')}){{1,{MAX_CHARS}}}")


def words_of(text: str | None) -> list[str]:
    """The words of a text in lower case; together they are all its letters."""
    return _WORD.findall(text.lower()) if text else []


def word_features(words: list[str]) -> np.ndarray:
    """Slots of each word's features, one row per word; 0 pads (its weights stay 0)."""
    cut = [f"^{w}$" for w in words]
    width = MAX_CHARS + 2
    codes = np.zeros((len(cut), width), np.uint64)
    sizes = np.fromiter(map(len, cut), np.int64, len(cut))
    flat = np.frombuffer("".join(cut).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    row = np.repeat(np.arange(len(cut)), sizes)
    codes[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    m1, m2, m3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)

    def slot(h, salt):
        h = (h ^ np.uint64(salt)) * m1
        h = (h ^ (h >> np.uint64(29))) * m2
        return ((h >> np.uint64(32)) % np.uint64(SLOTS - 1)).astype(np.int64) + 1

    two = codes[:, :-1] * m2 + codes[:, 1:] * m3
    three = two[:, :-1] * m1 + codes[:, 2:]
    place = np.arange(width)
    bigram = np.where(place[None, :-1] + 2 <= sizes[:, None], slot(two, 2), 0)
    trigram = np.where(place[None, :-2] + 3 <= sizes[:, None], slot(three, 3), 0)
    index = np.arange(len(cut))
    whole = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(cut))
    prefix = slot(three[:, 0] * m1 + codes[:, 3], 5)
    end = np.maximum(sizes - 4, 0)
    suffix = slot(three[index, np.minimum(end, width - 3)] * m1 + codes[index, np.maximum(sizes - 1, 0)], 7)
    return np.hstack([bigram, trigram, prefix[:, None], suffix[:, None], slot(whole, 11)[:, None]])


def forward_backward(
    scores: np.ndarray, sizes: np.ndarray, transitions: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Word and pair probabilities of chains padded to one length.

    ``scores`` is (chains, words, languages) with chains in order of falling ``sizes``.
    Returns the word probabilities and the expected count of each transition.
    """
    n, length, labels = scores.shape
    move = np.exp(transitions)
    local = np.exp(scores - scores.max(axis=2, keepdims=True))
    alpha, beta = np.zeros_like(local), np.ones_like(local)
    first = np.exp(start) * local[:, 0]
    alpha[:, 0] = first / first.sum(axis=1, keepdims=True)
    live = [int(np.searchsorted(-sizes, -t, "left")) for t in range(length + 1)]  # chains longer than t
    for t in range(1, length):
        a = live[t]
        step = (alpha[:a, t - 1] @ move) * local[:a, t]
        alpha[:a, t] = step / step.sum(axis=1, keepdims=True)
    pairs = np.zeros((labels, labels))
    for t in range(length - 2, -1, -1):
        a = live[t + 1]
        ahead = local[:a, t + 1] * beta[:a, t + 1]
        back = ahead @ move.T
        joint = alpha[:a, t]
        total = (joint * back).sum(axis=1, keepdims=True)
        pairs += (joint / total).T @ ahead * move
        beta[:a, t] = back / back.sum(axis=1, keepdims=True)
    word = alpha * beta
    return word / np.maximum(word.sum(axis=2, keepdims=True), 1e-300), pairs


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # SLOTS x languages; row 0 stays 0
    transitions: np.ndarray
    start: np.ndarray

    def word_scores(self, words: list[str]) -> np.ndarray:
        out = np.empty((len(words), len(self.languages)), np.float32)
        for i in range(0, len(words), 8192):
            out[i : i + 8192] = self.weights[word_features(words[i : i + 8192])].sum(axis=1)
        return out

    def label(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[list[str]]]:
        """Word probabilities of each text, and its words (lower case)."""
        split = [words_of(t) for t in texts]
        ids: dict[str, int] = {}
        codes = [np.fromiter((ids.setdefault(w, len(ids)) for w in s), np.int64, len(s)) for s in split]
        if not ids:
            return [np.zeros((0, len(self.languages)))] * len(texts), split
        per_word = self.word_scores(list(ids))
        chains = [c[i : i + CHAIN] for c in codes for i in range(0, len(c), CHAIN)]
        sizes = np.fromiter(map(len, chains), np.int64, len(chains))
        order = np.argsort(-sizes, kind="stable")
        found: list = [None] * len(chains)
        for at in range(0, len(order), 2048):
            part = order[at : at + 2048]
            length = sizes[part]
            filled = np.zeros((len(part), int(length[0])), np.int64)
            inside = np.arange(filled.shape[1])[None, :] < length[:, None]
            filled[inside] = np.concatenate([chains[i] for i in part])
            scores = per_word[filled].astype(float)
            word, _ = forward_backward(scores, length, self.transitions, self.start)
            for i, w, n in zip(part, word, length, strict=True):
                found[i] = w[:n]
        out, next_one = [], 0
        for c in codes:
            count = -(-len(c) // CHAIN)
            own = found[next_one : next_one + count]
            next_one += count
            out.append(np.concatenate(own) if own else np.zeros((0, len(self.languages))))
        return out, split


def _fit_chains(runs: list[list[str]], tags: list[np.ndarray], languages: list[str], epochs: int = 6) -> Model:
    """Weights by stochastic gradient steps (Adagrad) on the chains' log-likelihood."""
    rng = np.random.default_rng(5)
    counts: dict[str, int] = {}
    for r in runs:
        for w in r:
            counts[w] = counts.get(w, 0) + 1
    words = list(counts)
    at = {w: i for i, w in enumerate(words)}
    slots = word_features(words)
    slots[np.fromiter(counts.values(), np.int64, len(words)) < LEXICON_COUNT, -1] = 0  # not in the lexicon
    k = len(languages)
    model = Model(languages, np.zeros((SLOTS, k)), np.eye(k), np.zeros(k))
    seen, seen_move, seen_start = np.full((SLOTS, k), 1e-6), np.full((k, k), 1e-6), np.full(k, 1e-6)
    order = np.arange(len(runs))
    for epoch in range(epochs):
        rng.shuffle(order)
        rate = 0.3 / (1 + epoch)
        for begin in range(0, len(order), 128):
            part = order[begin : begin + 128]
            part = part[np.argsort([-len(runs[i]) for i in part], kind="stable")]
            sizes = np.array([len(runs[i]) for i in part])
            length = int(sizes[0])
            ids, gold = np.zeros((len(part), length), np.int64), np.full((len(part), length), -1)
            for j, i in enumerate(part):
                ids[j, : len(runs[i])] = [at[w] for w in runs[i]]
                gold[j, : len(runs[i])] = tags[i]
            scores = model.weights[slots[ids]].sum(axis=2)
            word, pairs = forward_backward(scores, sizes, model.transitions, model.start)
            inside = gold >= 0
            push = -word[inside]
            push[np.arange(len(push)), gold[inside]] += 1
            grad = np.zeros_like(model.weights)
            used = slots[ids[inside]]
            np.add.at(grad, used.ravel(), np.repeat(push, used.shape[1], axis=0))
            rows = np.unique(used)
            rows = rows[rows > 0]
            g = grad[rows] - 1e-3 * model.weights[rows]
            seen[rows] += g * g
            model.weights[rows] += rate * g / np.sqrt(seen[rows])
            both = (gold[:, :-1] >= 0) & (gold[:, 1:] >= 0)
            true = np.zeros((k, k))
            np.add.at(true, (gold[:, :-1][both], gold[:, 1:][both]), 1)
            g = true - pairs - 1e-2 * model.transitions
            seen_move += g * g
            model.transitions += rate * g / np.sqrt(seen_move)
            g = np.bincount(gold[:, 0], minlength=k) - word[:, 0].sum(axis=0)
            seen_start += g * g
            model.start += rate * g / np.sqrt(seen_start)
    model.weights[0] = 0
    model.weights = model.weights.astype(np.float32)
    return model


def fit(docs: DataFrame, learn: F.Column, per_language: int = DOCS_PER_LANGUAGE) -> Model | None:
    """A model from the documents for which ``learn`` holds and that have a language.

    ``docs`` has ``doc_id``, ``text`` and ``lang``. The counts of the languages decide which
    hashes are taken, so that the sample comes out of one scan without a shuffle of texts.
    """
    named = docs.filter(learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    counts = {r[0]: r[1] for r in named.groupBy("lang").count().collect()}
    if not counts:
        return None
    languages = sorted(counts)
    # a share of the hash's range for each language: about per_language documents of it
    share = F.create_map(*[x for lang in languages for x in (
        F.lit(lang), F.lit(min(1.0, per_language / counts[lang])))])
    place = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    picked = named.filter(place < share[F.col("lang")]).select("doc_id", "text", "lang")

    def each(ids, texts, langs):
        runs = []
        for i, t in zip(ids, texts, strict=True):
            words = words_of(t)
            start = zlib.crc32(str(i).encode()) % max(1, len(words) - RUN + 1)
            runs.append(words[start : start + RUN])
        return [ids, langs, runs]

    # ids that are repeated do not unbound the sample
    most = 2 * per_language * len(languages)
    found = arrow_map(picked, each, "doc_id long, lang string, run array<string>")
    rows = found.orderBy(F.xxhash64("doc_id", "run"), "doc_id", "lang", "run").limit(most).collect()
    rows = sorted((r.doc_id, r.lang, r.run) for r in rows if r.run)
    if not rows:
        return None
    rng = np.random.default_rng(11)
    rng.shuffle(rows)
    runs, tags = [], []
    half = RUN // 2
    for i, (_, lang, run) in enumerate(rows):
        mark = np.full(len(run), languages.index(lang))
        if rng.random() < SPLICED:
            _, other, more = rows[(i * 7 + 1) % len(rows)]
            run, mark = run[:half] + more[:half], np.concatenate(
                [mark[:half], np.full(len(more[:half]), languages.index(other))]
            )
        runs.append(run)
        tags.append(mark)
    return _fit_chains(runs, tags, languages)


def predict(docs: DataFrame, model: Model | None, *keep: str, text: str = "text") -> DataFrame:
    """Columns ``keep``, ``lang_pred`` and ``score`` (mean probability of that language)."""
    kept = docs.select(*keep, F.col(text).alias("_text"))
    types = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes[:-1])
    columns = "lang_pred string, score double"

    def each(*cols):
        texts = cols[-1]
        if model is None:
            return [*cols[:-1], ["und"] * len(texts), [0.0] * len(texts)]
        langs, scores = [], []
        for start in range(0, len(texts), 512):
            part = texts[start : start + 512]
            for t, p in zip(part, model.label(part)[0], strict=True):
                if not len(p) or not any(map(str.isalpha, t)):
                    langs.append("und")
                    scores.append(0.0)
                    continue
                mean = p.mean(axis=0)
                best = int(mean.argmax())
                langs.append(model.languages[best])
                scores.append(float(min(1.0, mean[best])))
        return [*cols[:-1], langs, scores]

    return arrow_map(kept, each, f"{types}, {columns}" if types else columns)

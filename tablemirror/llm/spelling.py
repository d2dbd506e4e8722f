"""Spelling variant grouping by dense prefix-suffix tiling (operator 12).

Two words are near if one inserted, deleted or replaced code point leads from one to the other,
that is, if their common prefix and their common suffix together reach the length of the longer
one less one. That test runs on padded matrices of code points, block against block.

Blocks hold only words that can be near at all. A pair whose shorter word has m code points
first differs at one place c of 0..m. If c lies in a window [a, b), both words share their first a
and their last m - b code points. So a word goes, for each half of 0..m, to the block of what it
then shares, once as the shorter word (m is its length) and once as the longer (m is one less).
A block with more than ``BLOCK`` words does not gather: its window is halved and its words
go to smaller blocks, until the window is one place and words agree in all but that. Each pair has
one c and one window, so it is found exactly once, and nothing is capped.

Defined results: null and empty texts have no words; a null id counts as an empty one in the
checksum of its words; repeated rows count again; ties of the most frequent near word go to the
least in code-point order; an empty table gives an empty table. Columns other than the two
that are named are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemirror.llm.common import lower_ascii, ship, sliced, stored

RUN = re.compile("[a-zÀ-ÿ]+")  # of lower-cased text
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A run loses a code point if this divides its checksum.
NOISE = 199
#: How many times as frequent as a word its form is, at least.
RATIO = 5
#: Words of a block, at most, unless its window is a single place.
BLOCK = 256
#: Words that a task counts before it hands them on.
WORDS = 200_000
#: Bytes of one tile of comparisons.
TILE_BYTES = 1 << 22


# ---------------------------------------------------------------- words


def words_of(doc_id, text: str | None, noise: int = NOISE, least: int = LEAST_LENGTH) -> Counter:
    """The words of a document, some of which lose a code point, with their counts."""
    found: Counter = Counter()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(lower_ascii(text))).items():
        if len(run) < least:
            continue
        h = zlib.crc32(run.encode(), start)
        if h % noise == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < least:
                continue
        found[run] += n
    return found


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` of all words that occur ``LEAST_COUNT`` times and more."""
    ship(docs.sparkSession)

    def rows(found: Counter) -> Iterator[pa.RecordBatch]:
        words = list(found)
        for at in range(0, len(words), 1 << 16):
            part = words[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), pa.array([found[w] for w in part], pa.int64())], ["word", "n"]
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for part in sliced(batch):
                for i, t in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    for word, n in words_of(i, t).items():
                        found[word] += n
                    if len(found) >= WORDS:
                        yield from rows(found)
                        found = Counter()
        yield from rows(found)

    counted = docs.select(F.col(doc_id), F.col(text)).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


# ---------------------------------------------------------------- blocks


def _window(low: Column, high: Column, longer: Column) -> Column:
    """The place of a word in the block of a window: what it shares if c lies in it."""
    word, m = F.col("word"), F.col("m")
    tail = F.greatest(m - high, F.lit(0))
    shared = F.struct(
        m.alias("m"), low.alias("a"), high.alias("b"),
        F.substring(word, F.lit(1), low).alias("head"),
        F.substring(word, F.char_length(word) - tail + 1, tail).alias("tail"),
    )
    # a hash that two blocks share only puts them side by side: pairs are made of rows
    # with equal windows, and tested as a whole
    return F.struct(
        F.xxhash64(shared).alias("block"), m.alias("m"), low.alias("a"), high.alias("b"),
        longer.alias("longer"), word.alias("word"), F.col("n").alias("n"),
    )


def _halves(rows: DataFrame) -> DataFrame:
    """The rows in both halves of their window [a, b)."""
    a, b = F.col("a"), F.col("b")
    middle = F.floor((a + b) / 2).cast("int")
    return rows.select(
        F.inline(F.array(_window(a, middle, F.col("longer")), _window(middle, b, F.col("longer"))))
    )


def _first_blocks(words: DataFrame) -> DataFrame:
    length = F.char_length("word")
    both = words.select(
        "word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("longer")
    ).withColumn("m", length - F.col("longer").cast("int"))
    return _halves(both.select("word", "n", "longer", "m", F.lit(0).alias("a"), (F.col("m") + 1).alias("b")))


def _matrix(words: list[str], width: int) -> np.ndarray:
    """Code points of the words, a row each, padded with zeros behind."""
    return np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)


def tile(left: list[str], right: list[str], longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix and common suffix lengths of every word of ``left`` with every of ``right``,
    words of at most ``longest`` code points; equal words have ``longest`` for both."""

    def shared(x: list[str], y: list[str]) -> np.ndarray:
        equal = _matrix(x, longest)[:, None, :] == _matrix(y, longest)[None]
        return np.where(equal.all(axis=2), longest, equal.argmin(axis=2))

    backward = [[w[::-1] for w in side] for side in (left, right)]
    return shared(left, right), shared(*backward)


def near_in_block(words: list[str], longer: list[bool], m: int, a: int, b: int) -> Iterator[tuple[int, int]]:
    """Pairs of places of near words, of which the shorter has m points and which differ first
    in [a, b)."""
    short = [i for i, x in enumerate(longer) if not x]
    long_ = [i for i, x in enumerate(longer) if x]
    side = max(1, int(math.sqrt(TILE_BYTES / (m + 2))))
    for size, others in ((m, short), (m + 1, long_)):
        for x in range(0, len(short), side):
            rows = short[x : x + side]
            for y in range(x if others is short else 0, len(others), side):
                columns = others[y : y + side]
                prefix, suffix = tile([words[i] for i in rows], [words[j] for j in columns], size)
                near = (prefix + suffix >= size - 1) & (prefix < size) & (prefix >= a) & (prefix < b)
                if others is short and x == y:
                    near = np.triu(near, 1)
                for i, j in np.argwhere(near).tolist():
                    yield rows[i], columns[j]


def _near_words(blocks: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best``: per word and slice of blocks, the count of its near words and
    the most frequent of them. Rows of a block are next to each other."""
    ship(blocks.sparkSession)
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def found(best: dict) -> pa.RecordBatch:
        rows = [(w, k, n, b) for w, (k, n, b) in best.items()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )

    def note(best: dict, word: str, other: str, n: int) -> None:
        old = best.get(word)
        if old is None:
            best[word] = (1, n, other)
        elif (-n, other) < (-old[1], old[2]):
            best[word] = (old[0] + 1, n, other)
        else:
            best[word] = (old[0] + 1, *old[1:])

    def one(rows: list[tuple], best: dict) -> None:
        # rows of one hash; those of one window are the block
        kinds: dict[tuple, list] = {}
        for row in rows:
            kinds.setdefault(row[1:4], []).append(row)
        for (m, a, b), block in kinds.items():
            words, counts = [r[5] for r in block], [r[6] for r in block]
            for i, j in near_in_block(words, [r[4] for r in block], m, a, b):
                note(best, words[i], words[j], counts[j])
                note(best, words[j], words[i], counts[i])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        best: dict = {}
        for batch in batches:
            for part in sliced(batch):
                for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if held and row[0] != held[0][0]:
                        one(held, best)
                        held = []
                        if len(best) >= WORDS:
                            yield found(best)
                            best = {}
                    held.append(row)
        if held:
            one(held, best)
        yield found(best)

    return blocks.mapInArrow(task, "word string, n_near long, best_n long, best string")


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n_near, best_n, best`` of the words (``word, n``, distinct) that have near ones."""
    columns = ["block", "m", "a", "b", "longer", "word", "n"]
    rows = stored(_first_blocks(words), "blocks")
    parts = []
    while True:
        sizes = rows.groupBy("block").agg(
            F.count("*").alias("size"), F.count_if(~F.col("longer")).alias("short"), F.min(F.col("b") - F.col("a")).alias("width")
        )
        some = stored(sizes.filter("size > 1 and short > 0"), "block-sizes")
        fits = (F.col("size") <= block) | (F.col("width") <= 1)
        ready = rows.join(some.filter(fits).select("block"), "block", "left_semi").select(*columns)
        parts.append(_near_words(ready.repartition("block").sortWithinPartitions("block")))
        hot = some.filter(~fits).select("block")
        if hot.isEmpty():
            break
        rows = stored(_halves(rows.join(hot, "block", "left_semi").filter("b - a > 1")), "blocks")
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    first = F.min(F.struct((-F.col("best_n")).alias("order"), F.col("best").alias("best")))
    return every.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first")).select(
        "word", "n_near", (-F.col("first.order")).alias("best_n"), F.col("first.best").alias("best")
    )


def _roots(forms: DataFrame, longest: int) -> DataFrame:
    """``word, root``: the end of each word's chain of forms, by doubling the steps."""
    up = forms.select("word", F.col("form").alias("root"))
    steps = 1
    while steps < longest:
        up = stored(up, "roots")
        higher = up.select(F.col("word").alias("root"), F.col("root").alias("higher"))
        up = up.join(higher, "root", "left").select("word", F.coalesce("higher", "root").alias("root"))
        steps *= 2
    return up


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the whole texts."""
    words = stored(count_words(docs, doc_id, text), "words")
    near = words.join(near_words(words, block), "word", "left")
    formed = F.coalesce(F.col("best_n") >= RATIO * F.col("n"), F.lit(False))
    judged = stored(
        near.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    # a form is RATIO times as frequent as its word, which bounds the length of a chain
    most = words.agg(F.max("n")).first()[0] or 1
    longest = max(1, math.ceil(math.log(max(most / LEAST_COUNT, 1), RATIO)) + 1)
    roots = _roots(judged.filter("form is not null"), longest)
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

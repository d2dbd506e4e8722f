"""Documents that operators trip over, and plain versions of what operators should do."""

from __future__ import annotations

import random
import re

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^ \t-\r]+")
#: Names that operators use inside.
CLASHING = ["key", "v", "n", "bits", "kept", "score", "_text", "start", "rank", "part", "c0", "whole", "runs"]


def rows(seed: int = 3) -> list[tuple]:
    """(doc_id, text): nulls, empty and long texts, ties, copies, near copies, repeated rows."""
    rng = random.Random(seed)

    def words(n):
        return [rng.choice("abcdefgh") + rng.choice("aeiou") + str(rng.randrange(60)) for _ in range(n)]

    base, passage = words(300), " ".join(words(90))
    near = [base[:k] + ["changed"] + base[k + 1 :] for k in (20, 150, 280)]
    texts = [
        None, "", " \n\t ", "one", "ONE", "one two three four", "One two three four five",
        " ".join(base), " ".join(base), *[" ".join(w) for w in near], " ".join(base).upper(),
        " ".join(words(40)) + " " + passage + " " + " ".join(words(70)),
        " ".join(words(60)) + " " + passage + " " + " ".join(words(30)),
        " ".join(words(4000)), "x" * 30000, "ab " * 4000, "é" * 900, "line of text\n" * 200,
        "a@b.cd, 10.0.0.1 +49 (30) 123-4567 4111 1111 1111 1111", " ".join(words(55)),
    ]
    out = [(i, t) for i, t in enumerate(texts)]
    return [*out, (7, texts[7]), (None, texts[9]), (None, None), (21, "other text of a repeated id")]


def documents(spark: SparkSession, pairs=None, clashing: bool = True):
    pairs = rows() if pairs is None else pairs
    full = [(i, t, "en" if i is None or i % 2 else None, None if i == 3 else f"s{(i or 0) % 3}", len(t or "")) for i, t in pairs]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(1) for c in CLASHING}) if clashing else df


def table(spark: SparkSession, tmp_path, name: str, df) -> str:
    """Store ``df`` as a table of a data folder and return the folder."""
    df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def same_rows(got, want) -> None:
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


class Groups:
    """Union-find."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def tie(self, i: int, j: int) -> None:
        i, j = self.top(i), self.top(j)
        self.up[max(i, j)] = min(i, j)


def shingles(text: str | None) -> frozenset:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) >= 5:
        return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    return frozenset([tuple(words)]) if words else frozenset()


def jaccard_groups(texts: list) -> tuple[list[frozenset], list[int]]:
    sets = [shingles(t) for t in texts]
    groups = Groups(len(sets))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                groups.tie(i, j)
    return sets, [groups.top(i) for i in range(len(sets))]


def without_passages(texts: list, words: int = 51, length: int = 400) -> list[str]:
    """The texts without repeated strings of ``length`` bytes and repeated runs of ``words`` words,
    both judged on the input, the blanks within a run of words included."""
    contents = [(t or "").encode() for t in texts]
    places = [[m.span() for m in re.finditer(WORD.pattern.encode(), c)] for c in contents]
    gone = [bytearray(g) for g in repeated_bytes(contents, length)]
    seen: dict[tuple, list] = {}
    for d, (c, found) in enumerate(zip(contents, places)):
        run = [c[a:b] for a, b in found]
        for k in range(len(run) - words + 1):
            seen.setdefault(tuple(run[k : k + words]), []).append((d, k))
    for where in seen.values():
        if len(where) > 1:
            for d, k in where:
                low, high = places[d][k][0], places[d][k + words - 1][1]
                gone[d][low:high] = b"\1" * (high - low)
    return [bytes(b for b, g in zip(c, mark) if not g).decode("utf-8", "ignore") for c, mark in zip(contents, gone)]


def passage_words(texts: list, words: int = 51) -> list[tuple[int, int]]:
    """Words covered by runs of ``words`` words that start anywhere else too, and maximal runs of them."""
    runs = [WORD.findall(t or "") for t in texts]
    seen: dict[tuple, list] = {}
    for d, run in enumerate(runs):
        for k in range(len(run) - words + 1):
            seen.setdefault(tuple(run[k : k + words]), []).append((d, k))
    covered = [bytearray(len(run)) for run in runs]
    for where in seen.values():
        for d, k in where if len(where) > 1 else ():
            covered[d][k : k + words] = b"\1" * words
    return [(sum(c), len(re.findall(b"\1+", c))) for c in covered]


def repeated_bytes(contents: list[bytes], length: int) -> list[bytes]:
    """A one for each byte that a repeated string of ``length`` bytes covers."""
    seen: dict[bytes, int] = {}
    for c in contents:
        for s in range(len(c) - length + 1):
            w = c[s : s + length]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for c in contents:
        gone = bytearray(len(c))
        for s in range(len(c) - length + 1):
            if seen[c[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        out.append(bytes(gone))
    return out


def without_repeats(texts: list, length: int = 400) -> list[tuple[bytes, int, int]]:
    """Kept bytes, removed bytes and removed runs of each text."""
    contents = [(t or "").encode() for t in texts]
    out = []
    for c, gone in zip(contents, repeated_bytes(contents, length), strict=True):
        kept = bytes(b for b, g in zip(c, gone) if not g)
        out.append((kept, sum(gone), len(re.findall(b"\1+", gone))))
    return out

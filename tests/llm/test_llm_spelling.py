"""Operator 12 against a plain version that compares every two words."""

import random
import re
import zlib
from collections import Counter

import pytest

import awkward
from tablemirror.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    counts = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    forms, out = {}, []
    for w, n in words.items():
        others = sorted((-m, v) for v, m in words.items() if near(w, v))
        best = others[0] if others else (0, None)
        forms[w] = (best[1], -best[0]) if -best[0] >= 5 * n else (None, None)
        out.append([w, n, len(others)])
    for row in out:
        root = row[0]
        while forms[root][0]:
            root = forms[root][0]
        row[1:] = [forms[row[0]][0], root, row[1], row[2], forms[row[0]][1]]
    return [tuple(r) for r in out]


def documents(spark, rows):
    return awkward.documents(spark, rows).withColumns(
        {c: spelling.F.lit(1) for c in ["word", "block", "m", "a", "b", "longer", "size"]}
    )


@pytest.fixture
def texts():
    """Chains of variants, doubled letters, accents, and a block that many words share."""
    rng, out = random.Random(5), []
    for base in ("garden", "window", "aaaaaa", "élèveèé", "mother×÷", "abcabcabc"):
        out += [base] * 700
        for _ in range(40):
            k, c = rng.randrange(len(base) + 1), rng.choice("abcdeé")
            v = rng.choice([base[:k] + c + base[k:], base[:k] + base[k + 1 :], base[:k] + c + base[k + 1 :]])
            out += [v] * rng.choice([3, 5, 6, 30, 140])
            w = v[: len(v) // 2] + "x" + v[len(v) // 2 :]
            out += [w] * rng.choice([5, 6, 28])
    out += [f"shared{a}{b}tail" for a in "abcdefghij" for b in "klmnopqrst" for _ in range(5)]
    rng.shuffle(out)
    lines = [" ".join(out[i : i + 37]) for i in range(0, len(out), 37)]
    return [(i if i % 9 else None, t.upper() if i % 5 == 1 else t) for i, t in enumerate(lines)]


@pytest.mark.parametrize("block", [4, 40, 256])
def test_variants_at_any_size_of_a_block(spark, texts, block):
    got = spelling.variants(documents(spark, texts), block=block)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain(texts)
    assert any(r[1] and r[2] != r[1] for r in want)  # a chain of two steps
    awkward.same_rows(got.collect(), want)


def test_tiles_of_one_row(spark, texts, monkeypatch):
    words = sorted({w for _, t in texts for w in t.lower().split()})[:60] + ["a" * 9, "a" * 10]
    for m in {len(w) for w in words}:
        both = [w for w in words if len(w) in (m, m + 1)]
        longer = [len(w) > m for w in both]
        want = {frozenset((x, y)) for x in both for y in both if near(x, y) and m in (len(x), len(y))}
        want = {p for p in want if min(map(len, p)) == m}
        for tile in (1, 1 << 22):
            monkeypatch.setattr(spelling, "TILE_BYTES", tile)
            got = [frozenset((both[i], both[j])) for i, j in spelling.near_in_block(both, longer, m, 0, m + 1)]
            assert len(got) == len(set(got)) and set(got) == want


def test_very_long_words_and_awkward_documents(spark):
    long = "ab" * 3000
    rows = [(k, f"{long} {long[:-1]} {long}") for k in range(6)] + awkward.rows()
    awkward.same_rows(spelling.variants(documents(spark, rows)).collect(), plain(rows))


def test_empty_tables(spark):
    assert spelling.variants(documents(spark, [])).count() == 0
    assert spelling.variants(documents(spark, [(1, None), (2, "short words")])).count() == 0

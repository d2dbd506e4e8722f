"""Repeated passages of a number of words, for the further columns of operator 8.

A window of ``n`` words repeats if the same words, with any blanks between them, also start
anywhere else in the corpus, same text included. It is found as ``suffixes`` finds windows of
bytes: its anchor is the GRAM words of least hash in it, and the windows of one anchor are its
context, so only contexts with equal grams are compared. Here every word is 64 bits, so windows
are compared by hashes that are made for all places at once.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablemirror.llm.common import WORD, arrow_map

#: Words of the gram that anchors a window.
GRAM = 8
#: Different contexts that a gram may have in one comparison; 10 MB or so. Windows of more go to the tasks of their hashes.
GROUP = 1 << 14
_BYTES = 1 << 22  # of text whose words are found together
_WORDS = 1 << 18  # windows that are hashed together
_SHORT = 16  # bytes of a word that is hashed without a Python call

_BLANK = np.array([not re.match(WORD.pattern.encode(), bytes([b])) for b in range(256)])
_AFTER = re.compile(rb"[\x20\x09-\x0d]")
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_PLACE = np.uint64((1 << 24) - 1)
_BASE, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD
    return h ^ (h >> np.uint64(29))


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places where the words of ``data`` start and end, and their hashes."""
    found, at = [], 0
    while at < len(data):
        cut = _AFTER.search(data, at + _BYTES)
        end = cut.start() if cut else len(data)
        starts, ends, hashes = _words_of(data[at:end])
        found.append((at + starts, at + ends, hashes))
        at = end
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts, ends, hashes = zip(*found, strict=True)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def _words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    padded = b" " + data + b" " * 17
    blank = _BLANK[np.frombuffer(padded, np.uint8)]
    edges = np.flatnonzero(blank[1:] != blank[:-1])  # place of ``data``, for there is one byte more
    starts, ends = edges[::2], edges[1::2]
    size = ends - starts
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    head = eight[starts + 1] & _MASK[np.minimum(size, 8)]
    tail = eight[starts + 9] & _MASK[np.clip(size - 8, 0, 8)]
    hashes = _mixed(_mixed(head + size.astype(np.uint64) * _BASE) + tail)
    for i in np.flatnonzero(size > _SHORT).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]])
    return starts, ends, hashes


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` hashes from each place on."""
    level, size, at, out = hashes, 1, 0, None
    while True:
        if n & size:
            part = level[at : at + len(hashes) - n + 1]
            out = part if out is None else _mixed(out * _BASE + part)
            at += size
        if 2 * size > n:
            return out
        level = _mixed(level[:-size] * _BASE + level[size:])
        size *= 2


def _joined(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Starts and ends of the words of all texts within their own, hashes, the text of each word,
    and the first word of each text, or where it would stand."""
    starts, ends, hashes = hashed_words(b" ".join(texts))
    begin = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    owner = np.searchsorted(begin, starts, "right") - 1
    return starts - begin[owner], ends - begin[owner], hashes, owner, np.searchsorted(starts, begin)


def anchors(texts: list[bytes], n: int) -> list[np.ndarray]:
    """``text, low, high, at, gram, d1, d2, start, size``: windows from word ``low`` to word ``high``
    have their anchor at word ``at``; their words are ``size`` bytes from ``start`` on.

    No context has a window twice, and its windows overlap, so the first, the last and their
    distance, which ``d1`` and ``d2`` are made of, tell contexts apart.
    """
    starts, ends, hashes, owner, base = _joined(texts) if texts else [np.zeros(0, np.int64)] * 5
    rows = []
    for begin in range(0, len(hashes) - n + 1, _WORDS):
        own = hashes[begin : begin + _WORDS + n - 1]
        text = owner[begin : begin + len(own)]
        windows, grams = run_hashes(own, n), run_hashes(own, GRAM)
        low = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        span, size = n - GRAM + 1, 1
        while 2 * size <= span:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < span:
            low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
        within = np.flatnonzero(text[: len(low)] == text[n - 1 :])  # windows of one text
        place = (low[within] & _PLACE).astype(np.int64)
        edge = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else place
        first, last = within[edge], within[np.r_[edge[1:], len(within)] - 1] if len(edge) else within
        at, of = place[edge], text[first]
        word = begin - base[of]
        d2 = _mixed(windows[last] + (last - first).astype(np.uint64) * _BASE)
        start = starts[begin + first]
        rows.append(
            [of, first + word, last + word, at + word, grams[at].view(np.int64), windows[first].view(np.int64),
             d2.view(np.int64), start, ends[begin + last + n - 1] - start]
        )
    return [np.concatenate(c) for c in zip(*rows, strict=True)] if rows else [np.zeros(0, np.int64)] * 9


def _windows(contexts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows that lie in one context, and its number."""
    _, _, hashes, owner, _ = _joined(contexts)
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    within = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :])
    return run_hashes(hashes, n)[within], owner[within]


def repeated_starts(contexts: list[bytes], n: int) -> list[np.ndarray]:
    """For each context, whether each of its windows is found at another place of the contexts."""
    windows, owner = _windows(contexts, n)
    order = np.argsort(windows)
    same = windows[order][1:] == windows[order][:-1]
    hit = np.zeros(len(windows), bool)
    hit[order] = np.r_[False, same] | np.r_[same, False] if len(windows) else False
    return np.split(hit, np.searchsorted(owner, np.arange(1, len(contexts))))


def repeated_windows(contexts: DataFrame, n: int) -> DataFrame:
    """``key, low, high``: windows of ``contexts`` (``key, low, context``) that occur twice, one by one."""

    def each(keys, lows, contents):
        windows, owner = _windows(contents, n)
        counts = np.bincount(owner, minlength=len(contents))
        lows = np.repeat(lows, counts) + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        return [windows.view(np.int64), [keys[i] for i in owner.tolist()], lows.astype(np.int32)]

    every = arrow_map(contexts.select("key", "low", "context"), each, "window long, key binary, low int")
    counted = every.withColumn("n", F.count("*").over(Window.partitionBy("window")))
    return counted.filter("n > 1").select("key", "low", F.col("low").alias("high"))

"""Removal of long repeated passages by suffix arrays (operator 8).

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else in the
corpus. Sorting every suffix of the corpus in one order is not needed for that:

1. Anchors. Of the 64-byte grams in a window of LENGTH bytes, the one with the least hash
   (leftmost of equals) is the window's anchor. Equal windows have equal anchors at the same
   place, so only windows whose anchors are the same gram have to be compared. Neighbouring
   windows mostly share an anchor: about one anchor per 170 bytes is shuffled, as digests,
   no text.
2. Contexts. The bytes of all windows of one anchor are its context. Equal contexts are
   counted before anything else, within a slice of texts already: where one occurs twice, all
   its windows repeat.
3. Suffix arrays. Only grams with several different contexts are left. One copy of each such
   context goes to the task of its gram; contexts are strung together into blocks, whose
   suffix array is built by two-stage sorting: suffixes smaller than their successors are
   sorted directly, the others are induced by scanning the buckets of first bytes; adjacent
   common prefixes of LENGTH bytes or more mark the windows.
4. A gram with more than ``GROUP`` different contexts gathers in no task. Its contexts are
   split by where their windows start into runs of ``FINE`` windows, and the bytes that all
   windows of a run share, nearly LENGTH of them, become the run's gram: back to step 2 with
   far more selective grams. A gram that is still hot is split into single windows, of which
   equal ones are counted.

On request the same passes find repeated passages of so many words, which may have any number of
bytes: ``passages`` makes their anchors and compares their contexts.

A window belongs to one anchor, hence to one context, and has all its bytes there alone, so
a common prefix of LENGTH bytes always means two different places.

Defined results: null is as empty; texts shorter than LENGTH keep all bytes; repeated rows
are copies of each other, so texts of LENGTH bytes and more go entirely; an empty table
gives an empty table. Results belong to contents, so null or repeated ids do not matter.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablemirror.llm import passages
from tablemirror.llm.common import WORD, arrow_map, give_back, ship, stored

LENGTH = 400
#: Words of a passage that ``without_passages`` removes too and op8 counts, at any number of bytes.
WORDS = 51
GRAM = 64
#: Different contexts that a gram may have in a suffix array; about 0.4 MB.
GROUP = 512
#: Windows of a run into which the contexts of hotter grams are split.
FINE = 16
#: Bytes that are strung together for one suffix array, at least.
BLOCK_BYTES = 1 << 18
_PIECE = 1 << 20  # bytes of text that are hashed together

_PLACE = np.uint64((1 << 24) - 1)
_TABLE = np.random.default_rng(8).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


# ---------------------------------------------------------------- anchors


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place on."""
    h, step, power = _TABLE[data], 1, _BASE
    while step < GRAM:
        h = h[:-step] * np.uint64(power) + h[step:]
        step, power = 2 * step, power * power % (1 << 64)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _anchors_of(pieces: list[tuple[int, int, bytes]], length: int) -> Iterator[tuple]:
    """``(document, first start, last start, anchor's place, gram hash, context digest)`` of the pieces
    ``(document, offset, bytes)``, each at least ``length`` bytes long."""
    joined = b"".join(p for _, _, p in pieces)
    data = np.frombuffer(joined, np.uint8)
    grams = gram_hashes(data)
    low = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    span, size = length - GRAM + 1, 1
    while 2 * size <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < span:
        low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
    owner = (low & _PLACE).astype(np.int64)
    at = 0
    for doc, offset, piece in pieces:
        own = owner[at : at + len(piece) - length + 1]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        last = np.r_[first[1:], len(own)] - 1
        place, gram = own[first] - at, grams[own[first]].view(np.int64)
        for a, b, p, g in zip(first.tolist(), last.tolist(), place.tolist(), gram.tolist(), strict=True):
            yield doc, offset + a, offset + b, offset + p, g, xxhash.xxh3_128_digest(piece[a : b + length])
        at += len(piece)


def _folded(rows: list[np.ndarray], keys: np.ndarray) -> list[np.ndarray]:
    """``words, gram, d1, d2, text, low, high, at, start, size`` and ``times``: the rows with one row for each
    context, found so many times. Where the others lie is known to repeat: runs of their windows follow, each
    a gram of its own, with 0 times. A text that goes on repeating itself has a context at every word."""
    of_words, grams, d1, d2, text, low, high, _, _, _ = rows
    order = np.lexsort((low, text, d2, d1, grams, of_words))
    ids = np.stack([of_words[order], grams[order], d1[order], d2[order]])
    head = np.flatnonzero(np.r_[True, (ids[:, 1:] != ids[:, :-1]).any(0)]) if len(order) else order
    times = np.diff(np.r_[head, len(order)])
    again = np.delete(order, head)
    again = again[np.lexsort((low[again], text[again], of_words[again]))]
    w, t, a, b = of_words[again], text[again], low[again], high[again]
    new = np.r_[True, (w[1:] != w[:-1]) | (t[1:] != t[:-1]) | (a[1:] > b[:-1] + 1)][: len(again)]
    begin = np.flatnonzero(new)
    end = np.r_[begin[1:], len(again)][: len(begin)] - 1
    w, t, a, b, none = w[begin], t[begin], a[begin], b[end], np.zeros(len(begin), np.int64)
    own = (keys[t].astype(np.uint64) + a.astype(np.uint64) * np.uint64(_BASE) + t.astype(np.uint64) * _TABLE[0]).view(np.int64)
    runs = [w, own, none, none, t, a, b, none, none, none]
    kept = order[head]
    return [np.concatenate([x[kept], y]) for x, y in zip(rows, runs, strict=True)] + [np.r_[times, none]]


def anchors(texts: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """Rows ``words, gram, d1, d2, key, low, high, at, start, size, times`` of ``texts``, which has ``key``
    and ``bytes``.

    Windows that start from ``low`` to ``high`` have their anchor at ``at``; ``d1`` and ``d2`` are the
    digest of their context, the ``size`` bytes from ``start`` on. With ``words``, windows of so many
    words follow, where ``low``, ``high`` and ``at`` count words. ``times`` is as ``_folded`` says.
    """

    def each(keys, contents):
        rows: list[tuple] = []
        pieces, held = [], 0

        def flush():
            nonlocal pieces, held
            if pieces:
                rows.extend(_anchors_of(pieces, length))
            pieces, held = [], 0

        for i, content in enumerate(contents):
            n = len(content or b"")
            for start in range(0, n - length + 1, _PIECE):  # long texts in overlapping pieces
                piece = content[start : start + _PIECE + length - 1]
                pieces.append((i, start, piece))
                held += len(piece)
                if held >= _PIECE:
                    flush()
        flush()
        docs, low, high, at, grams, digests = zip(*rows, strict=True) if rows else [()] * 6
        halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        docs, low, high, at, grams = (np.array(x, np.int64) for x in (docs, low, high, at, grams))
        found = [np.zeros(len(rows), np.int64), grams, halves[:, 0], halves[:, 1], docs, low, high, at, low, high - low + length]
        if words:
            docs, low, high, at, *gram, start, size = passages.anchors(contents, words)
            more = [np.ones(len(docs), np.int64), *gram, docs, low, high, at, start, size]
            found = [np.concatenate(x) for x in zip(found, more, strict=True)]
        heads = np.array([int.from_bytes(k[:8], "big") for k in keys], np.uint64)
        of_words, grams, d1, d2, docs, *rest = _folded(found, heads)
        return [of_words.astype(bool), grams, d1, d2, [keys[i] for i in docs.tolist()], *rest]

    return arrow_map(
        texts.select("key", "bytes"), each,
        "words boolean, gram long, d1 long, d2 long, key binary, low int, high int, at int, start int, size int, "
        "times long",
    )


def finer(contexts: DataFrame, width: int, length: int = LENGTH) -> DataFrame:
    """Contexts ``key, at, start, low, high, context`` split by windows into runs of ``width``.

    ``context`` begins at ``start`` of its text; the windows from ``low`` to ``high`` are in
    question. Rows are those of ``anchors`` but for ``size``, none folded; ``start`` is that of the
    given context. The gram of a run is a hash of the bytes that all its possible windows share. A
    window's run depends on its distance to its anchor alone, so equal windows fall into equal runs.
    """

    def each(keys, ats, starts, lows, highs, contents):
        out: list[list] = [[], [], [], [], [], [], [], []]
        for key, at, start, low, high, content in zip(keys, ats, starts, lows, highs, contents, strict=True):
            for run in range((at - high) // width, (at - low) // width + 1):
                first, last = max(low, at - width * run - width + 1), min(high, at - width * run)
                core = at - width * run - start  # where all windows of the run have begun
                shared = content[core : core + length - width + 1]
                gram = xxhash.xxh3_64_intdigest(shared, run) - (1 << 63)
                d1, d2 = struct.unpack("=qq", xxhash.xxh3_128_digest(content[first - start : last - start + length]))
                for column, value in zip(out, (gram, d1, d2, key, first, last, at, start), strict=True):
                    column.append(value)
        return out

    rows = arrow_map(
        contexts.select("key", "at", "start", "low", "high", "context"), each,
        "gram long, d1 long, d2 long, key binary, low int, high int, at int, start int",
    )
    return rows.withColumn("words", F.lit(False)).withColumn("times", F.lit(1))


# ---------------------------------------------------------------- suffix arrays


def suffix_array(data: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Places of ``data`` in the order of the first ``depth`` bytes from them, by two stages."""
    n = len(data)
    raw = data.tobytes()
    differs = np.flatnonzero(data[1:] != data[:-1])
    smaller = np.zeros(n, bool)  # than its successor; the last suffix is larger than the empty one
    if len(differs):
        run_end = np.searchsorted(differs, np.arange(n))
        known = run_end < len(differs)
        end = differs[run_end[known]]
        smaller[known] = data[end] < data[end + 1]
    places = np.flatnonzero(smaller)
    # stage one: direct sort, one bucket of two bytes after another, so that only the suffixes of
    # a bucket are held as strings at a time
    pair = data[places].astype(np.int64) << 8 | data[places + 1]
    by_pair = np.argsort(pair, kind="stable")
    ends = np.flatnonzero(np.r_[np.diff(pair[by_pair]) != 0, True]) + 1 if len(places) else []
    direct, begin = np.empty(len(places), np.int64), 0
    for end in ends:
        bucket = places[by_pair[begin:end]]
        if end - begin > 1:
            bucket = sorted(bucket.tolist(), key=lambda i: raw[i : i + depth])
        direct[begin:end] = bucket
        begin = end
    cuts = np.searchsorted(data[direct], np.arange(257)) if len(direct) else np.zeros(257, int)
    # stage two: each bucket in turn hands its larger predecessors to theirs, in order
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[data[n - 1]].append(np.array([n - 1]))
    out = []

    def hand_on(found: np.ndarray, bucket: int) -> np.ndarray:
        before = found[found > 0] - 1
        before = before[~smaller[before]]
        first = data[before]
        same = before[first == bucket]
        rest, first = before[first != bucket], first[first != bucket]
        if len(rest):
            order = np.argsort(first, kind="stable")
            rest, first = rest[order], first[order]
            edges = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
            for c, part in zip(first[edges], np.split(rest, edges[1:]), strict=True):
                waiting[c].append(part)
        return same

    for c in range(256):
        front = np.concatenate(waiting[c]) if waiting[c] else np.array([], np.int64)
        while len(front):
            out.append(front)
            front = hand_on(front, c)
        own = direct[cuts[c] : cuts[c + 1]]
        if len(own):
            out.append(own)
            hand_on(own, c)
    return np.concatenate(out)


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Equal leading bytes, up to ``depth``, of each suffix and the one before it in ``order``."""
    padded = np.concatenate([data, np.zeros(depth + 8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    words = np.ascontiguousarray(words[: len(data) + depth]).view(">u8").ravel()
    left, right = order[:-1], order[1:]
    found = np.zeros(len(order), np.int64)
    live = np.arange(len(left))
    for k in range(0, depth, 8):
        a, b = words[left[live] + k], words[right[live] + k]
        same = a == b
        odd = (a[~same] ^ b[~same]).astype(np.uint64)
        zeros = np.zeros(len(odd), np.int64)
        for byte in range(1, 8):
            zeros += odd < np.uint64(1 << (64 - 8 * byte))
        found[live[~same] + 1] = k + zeros
        live = live[same]
    found[live + 1] = depth
    return np.minimum(found, depth)


def repeated_starts(contexts: list[bytes], owned: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each context, whether the window from each of its first ``owned`` places on is
    found at another place of the contexts. 0xFF, which no UTF-8 text holds, parts them."""
    data = np.frombuffer(b"\xff".join(contexts) + b"\xff", np.uint8)
    order = suffix_array(data, length)
    long_enough = common_prefixes(data, order, length) >= length
    hit = np.zeros(len(data), bool)
    hit[order] = long_enough
    hit[order[:-1]] |= long_enough[1:]
    out, at = [], 0
    for context, n in zip(contexts, owned, strict=True):
        out.append(hit[at : at + n])
        at += len(context) + 1
    return out


def _runs(hit: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    return zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True)


def mark(contexts: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """``words, key, low, high``: runs of repeated windows of contexts that lie in order of their
    gram; the rows of a gram are never parted. Contexts found more than once (``n``) have been
    marked by that and only bear witness."""
    ship(contexts.sparkSession)
    arrow = pa.schema([("words", pa.bool_()), ("key", pa.binary()), ("low", pa.int32()), ("high", pa.int32())])

    def block(rows: list[dict]) -> pa.RecordBatch:
        marks = []
        for kind in (False, True):
            own = [r for r in rows if r["words"] == kind]
            texts = [r["context"] for r in own]
            if not own:
                continue
            if kind:
                hits = passages.repeated_starts(texts, words)
            else:
                hits = repeated_starts(texts, [r["high"] - r["low"] + 1 for r in own], length)
            marks += [
                (kind, r["key"], r["low"] + a, r["low"] + b)
                for r, hit in zip(own, hits, strict=True) if r["n"] == 1
                for a, b in _runs(hit)
            ]
        columns = list(zip(*marks, strict=True)) if marks else [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
        )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    if size >= BLOCK_BYTES and row["gram"] != last:
                        yield block(held)
                        held, size = [], 0
                    held.append(row)
                    size += len(row["context"])
                    last = row["gram"]
        if held:
            yield block(held)
        held = []
        give_back()

    return contexts.mapInArrow(blocks, "words boolean, key binary, low int, high int")


# ---------------------------------------------------------------- operator


_SPAN = ["words", "key", "low", "high"]
_CONTEXT = ["words", "gram", "d1", "d2"]


def _grams(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans of the rows whose context occurs twice, and one row for each context of the grams
    that have several, with the counts ``n`` of the context and ``different`` of the gram.

    One shuffle and one sort serve all counts.
    """
    same, gram = Window.partitionBy(*_CONTEXT), Window.partitionBy(*_CONTEXT[:2])
    counted = (
        rows.repartition("gram")
        .withColumn("nth", F.row_number().over(same.orderBy("key", "low")))
        .withColumn("n", F.sum("times").over(same))
        .withColumn("different", F.sum(((F.col("nth") == 1) & (F.col("times") > 0)).cast("int")).over(gram))
    )
    repeated = stored(counted.filter("n > 1 or different > 1 or times = 0"), "grams")
    spans = repeated.filter("n > 1 or times = 0").select(*_SPAN).distinct()
    return spans, repeated.filter("nth = 1 and times > 0 and different > 1")


def _hot() -> Column:
    return F.col("different") > F.when(F.col("words"), passages.GROUP).otherwise(GROUP)


def _in_order(contexts: DataFrame) -> DataFrame:
    """Contexts of grams few enough to be compared at once, each gram in one task."""
    few = contexts.filter(~_hot()).select("words", "gram", "key", "low", "high", "n", "context")
    return few.repartition("gram").sortWithinPartitions("gram")


def repeated_spans(texts: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """``words, key, low, high``: runs of window starts that repeat. ``texts`` has one row per
    document with ``key`` (a digest of the content) and ``bytes``. With ``words``, runs of windows
    of so many words too, counted in words, where the column ``words`` is true."""
    least = min(length, 2 * words - 1) if words else length
    long_ones = texts.filter(F.length("bytes") >= least)
    whole, known = _grams(anchors(long_ones, length, words))
    one_text = long_ones.groupBy("key").agg(F.any_value("bytes").alias("bytes"))
    contexts = stored(
        known.join(one_text, "key")
        .select(*known.columns, F.substring("bytes", F.col("start") + 1, F.col("size")).alias("context")),
        "contexts",
    )
    near = mark(_in_order(contexts), length, words)

    # hot grams: their contexts again, by runs of windows, then by single windows
    hot = contexts.filter(_hot() & ~F.col("words"))
    run_copies, run_grams = _grams(finer(hot, FINE, length))
    sources = hot.select("key", "start", F.col("context").alias("bytes")).dropDuplicates(["key", "start"])
    size = F.col("high") - F.col("low") + length
    run_contexts = run_grams.join(sources, ["key", "start"]).select(
        *run_grams.columns, F.substring("bytes", F.col("low") - F.col("start") + 1, size).alias("context")
    )
    run_near = mark(_in_order(run_contexts), length)
    still_hot = run_contexts.filter(_hot()).withColumn("start", F.col("low"))
    window_copies, _ = _grams(finer(still_hot, 1, length))
    spans = whole.union(near).union(run_copies).union(run_near).union(window_copies)
    if words:
        hot_words = contexts.filter(_hot() & F.col("words"))
        spans = spans.union(passages.repeated_windows(hot_words, words).select(F.lit(True).alias("words"), *_SPAN[1:]))
    # stored, so that two searches and the texts are not one plan, whose tasks the driver holds at a time
    return stored(spans, "spans")


def _cut(content: bytes | None, runs: list | None, length: int) -> tuple[bytes, int, int]:
    """What is left, and the number of maximal removed runs and of removed bytes."""
    content = content or b""
    kept, done, removed, n = [], 0, 0, 0
    for low, high in sorted((r["low"], r["high"]) for r in runs or ()):
        end = high + length
        if low > done or not n:
            n += 1
            kept.append(content[done:low])
            removed += end - low
            done = end
        elif end > done:
            removed += end - done
            done = end
    kept.append(content[done:])
    return b"".join(kept), n, removed


def _with_runs(docs: DataFrame, text: str, length: int, words: int | None = None) -> DataFrame:
    content = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    keyed = docs.withColumn("bytes", content).withColumn("key", F.unhex(F.md5("bytes")))
    spans = repeated_spans(keyed.select("key", "bytes"), length, words)
    run = F.struct("low", "high")
    per_key = spans.groupBy("key").agg(
        F.collect_list(F.when(~F.col("words"), run)).alias("runs"),
        F.collect_list(F.when(F.col("words"), run)).alias("word_runs"),
    )
    return keyed.join(per_key, "key", "left")


def removal(
    docs: DataFrame, *keep: str, text: str = "text", length: int = LENGTH, words: int | None = None
) -> DataFrame:
    """Columns ``keep``, ``n_bytes, n_removed, n_spans, kept_sha256`` of every whole text.

    With ``words``, two further columns: ``n_passage_words``, the words covered by a run of so many
    words that also starts anywhere else, and ``n_passages``, the maximal runs of these. They are
    judged on the input too and remove nothing.
    """
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    joined = _with_runs(own, "_text", length, words)
    names = [f"c{i}" for i in range(len(keep))]
    types = "".join(f"{c} {t}, " for c, t in own.dtypes[:-1])

    def each(*cols):
        *kept_cols, contents, runs, word_runs = cols
        kept, n, removed = zip(*(_cut(b, r, length) for b, r in zip(contents, runs, strict=True)), strict=True)
        out = [
            *kept_cols, [len(b or b"") for b in contents], removed, n,
            [hashlib.sha256(k).hexdigest() for k in kept],
        ]
        if words:
            _, n, covered = zip(*(_cut(None, r, words) for r in word_runs), strict=True)
            out += [covered, n]
        return out

    further = ["n_passage_words", "n_passages"] if words else []
    out = arrow_map(
        joined.select(*names, "bytes", "runs", "word_runs"), each,
        types + ", ".join(["n_bytes long, n_removed long, n_spans long, kept_sha256 string", *(f"{c} long" for c in further)]),
    )
    return out.toDF(*keep, "n_bytes", "n_removed", "n_spans", "kept_sha256", *further)


def without_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes gone from the text; all rows and columns stay.

    A character that loses some of its bytes goes entirely; null stays null.
    """
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    at = docs.columns.index(text)
    joined = _with_runs(own, f"c{at}", length)
    names = [f"c{i}" for i in range(len(docs.columns))]
    types = "".join(f"{c} {t}, " for c, t in own.dtypes)

    def each(*cols):
        left = [
            None if old is None else _cut(b, r, length)[0].decode("utf-8", "ignore") if r else old
            for old, b, r in zip(cols[at], cols[-2], cols[-1], strict=True)
        ]
        return [*cols[:at], left, *cols[at + 1 : -2]]

    return arrow_map(joined.select(*names, "bytes", "runs"), each, types.rstrip(", ")).toDF(*docs.columns)


_WORD = re.compile(WORD.pattern.encode())
_UNIT = 8  # bytes that stand for a word


def _encoded(keyed: DataFrame, words: int) -> DataFrame:
    """``key`` and ``bytes`` of texts of so many words: the hash of each word, one after another."""

    def each(keys, contents):
        out_keys, out = [], []
        for k, c in zip(keys, contents, strict=True):
            found = _WORD.findall(c)
            if len(found) >= words:
                out_keys.append(k)
                out.append(b"".join([xxhash.xxh3_64_digest(w) for w in found]))
        return [out_keys, out]

    return arrow_map(keyed.select("key", "bytes"), each, "key binary, bytes binary")


def _ranges(content: bytes, runs: list, word_runs: list, length: int, words: int) -> list[dict]:
    """Ranges of bytes to cut, from runs of byte windows and runs of windows of encoded words."""
    out = [{"low": r["low"], "high": r["high"] + length} for r in runs]
    places = [m.span() for m in _WORD.finditer(content)] if word_runs else []
    for r in word_runs:
        first, last = -(-r["low"] // _UNIT), r["high"] // _UNIT
        if first <= last:
            out.append({"low": places[first][0], "high": places[last + words - 1][1]})
    return out


def without_passages(
    docs: DataFrame, text: str = "text", words: int = WORDS, length: int = LENGTH
) -> DataFrame:
    """As ``without_repeats``, and passages of ``words`` words that repeat go as well.

    Those may have any number of bytes and any blanks between their words. The same search
    runs a second time, over texts in which each word is ``_UNIT`` bytes of its hash, so that a
    passage of ``words`` words is a string of one length; both results are cut out together.
    """
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    at = docs.columns.index(text)
    joined = _with_runs(own, f"c{at}", length).drop("word_runs")
    keyed = own.select(F.coalesce(F.col(f"c{at}").cast("binary"), F.lit(b"")).alias("bytes"))
    encoded = _encoded(keyed.withColumn("key", F.unhex(F.md5("bytes"))), words)
    per_key = (
        repeated_spans(encoded, words * _UNIT)
        .groupBy("key")
        .agg(F.collect_list(F.struct("low", "high")).alias("word_runs"))
    )
    names = [f"c{i}" for i in range(len(docs.columns))]
    types = "".join(f"{c} {t}, " for c, t in own.dtypes)

    def each(*cols):
        left = [
            _cut(b, _ranges(b, r or [], w or [], length, words), 0)[0].decode("utf-8", "ignore") if r or w else old
            for old, b, r, w in zip(cols[at], *cols[-3:], strict=True)
        ]
        return [*cols[:at], left, *cols[at + 1 : -3]]

    every = joined.join(per_key, "key", "left").select(*names, "bytes", "runs", "word_runs")
    return arrow_map(every, each, types.rstrip(", ")).toDF(*docs.columns)

"""Source divergence audit with late strings (operator 13).

How far do the sources of a language lie apart, term by term and in total? Terms are counted
in tasks, and from then on a term is its 64-bit digest: every shuffle of counts carries
numbers of fixed width. Text comes back by a join, for the terms that are reported alone.

1. One pass over the texts counts occurrences and documents of each term of each (lang, source)
   group, combined inside the task. A task hands out a term's text once, on the first of its rows.
2. A dictionary of the digests holds the least and the greatest text of each. Where these
   differ, several terms share the digest: only such digests are counted once more, by text, and
   each of their terms gets a number (``part``) of its own. So results are exact at any width
   of the digest.
3. ``audit`` smooths the counts of the kept terms to integers p and sums f = (p - q)**2 div q.
   Most terms are absent from most groups, so a pair of groups is never compared term by term:
   the sum for two groups is that of all-absent terms, plus what each group's own terms change
   (by distinct p, a few thousand rows a group), plus what the terms of both change (summed in
   numpy within the partitions that hold a term's groups together, and handed on as one row for
   each pair of groups and slice).

Defined results: null texts, languages and sources are as empty ones; every row is a document
of its own, repeated rows and ids included; a group without terms and a language without kept
terms have their rows with value 0; ties go by text; an empty table gives an empty table.
Columns other than these three are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablemirror.llm.common import lower_ascii, ship, sliced, stored

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
#: Documents of a language that a kept term occurs in, at least.
LEAST_DOCS = 3
SCALE = 1_000_000_000
#: Terms reported for each group, at most.
TOP = 200
#: (group, term) cells that a task counts before it hands them on.
CELLS = 400_000
#: Rows whose pairs of groups are summed at a time; a term's rows stay together.
CHUNK = 1 << 16

_COUNTED = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("digest", pa.int64()),
    ("n", pa.int64()), ("docs", pa.int64()), ("term", pa.string()),
])


def digest_of(term: str, bits: int = 64) -> int:
    return (xxhash.xxh3_64_intdigest(term.encode()) >> (64 - bits)) - (1 << (bits - 1))


def count_terms(docs: DataFrame, bits: int = 64, named: bool = False) -> DataFrame:
    """``lang, source, digest, n, docs, term``: counts of a task, one row or more for each term
    of a group. ``term`` is given once for each digest and term (``named``: on every row)."""
    ship(docs.sparkSession)

    def rows(cells: dict) -> Iterator[pa.RecordBatch]:
        digests: dict[str, int] = {}
        for (lang, source), (n, held) in cells.items():
            terms = list(n)
            new = []
            for t in terms:
                first = t not in digests
                if first:
                    digests[t] = digest_of(t, bits)
                new.append(t if first or named else None)
            for at in range(0, len(terms), CHUNK):
                part = terms[at : at + CHUNK]
                columns = [
                    [lang] * len(part), [source] * len(part), [digests[t] for t in part],
                    [n[t] for t in part], [held[t] for t in part], new[at : at + CHUNK],
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _COUNTED, strict=True)], schema=_COUNTED
                )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for part in sliced(batch):
                for lang, source, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    words = TERM.findall(lower_ascii(text))
                    if not words:
                        continue
                    n, held = cells.setdefault((lang, source), (Counter(), Counter()))
                    size -= len(n)
                    n.update(words)
                    held.update(set(words))
                    size += len(n)
                    if size >= CELLS:
                        yield from rows(cells)
                        cells, size = {}, 0
        yield from rows(cells)

    return _named(docs).mapInArrow(
        count, "lang string, source string, digest long, n long, docs long, term string"
    )


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")], "text")


def _groups(docs: DataFrame) -> DataFrame:
    """``lang, source, lid, gid``: a number for every language and every group."""
    found = _named(docs).select("lang", "source").distinct().select(
        "lang", "source", F.monotonically_increasing_id().alias("gid")
    )
    found = stored(found, "groups")
    least = found.groupBy("lang").agg(F.min("gid").alias("lid"))
    return stored(found.join(least, "lang"), "group-ids")


def _cells(docs: DataFrame, groups: DataFrame, bits: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Counts ``lid, gid, n, docs`` with the columns that stand for a term, the dictionary of these
    columns with ``term``, and their names: ``digest``, and ``part`` only where digests are shared."""
    counted = stored(count_terms(docs, bits), "terms")
    texts = stored(
        counted.filter("term is not null").groupBy("digest")
        .agg(F.min("term").alias("term"), F.max("term").alias("greatest")),
        "dictionary",
    )
    shared = texts.filter("term <> greatest").select("digest")

    def numbered(rows: DataFrame, *key) -> DataFrame:
        return rows.join(groups, ["lang", "source"]).select("lid", "gid", *key, "n", "docs")

    if shared.isEmpty():
        return numbered(counted, "digest"), texts.select("digest", "term"), ["digest"]
    again = stored(count_terms(docs, bits, named=True).join(shared, "digest", "left_semi"), "shared-digests")
    place = F.row_number().over(Window.partitionBy("digest").orderBy("term"))
    parts = stored(again.select("digest", "term").distinct().select("digest", "term", place.alias("part")), "parts")
    alone, whole = counted.join(shared, "digest", "left_anti"), F.lit(0).alias("part")
    cells = numbered(alone, "digest", whole).union(numbered(again.join(parts, ["digest", "term"]), "digest", "part"))
    known = texts.filter("term = greatest").select("digest", whole, "term")
    return cells, known.union(parts.select("digest", "part", "term")), ["digest", "part"]


def _p(n, total, size) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + size)), exact; null where there is no term."""
    n, total, size = (F.col(x) if isinstance(x, str) else x for x in (n, total, size))
    share = (n + 1).cast("decimal(20,0)") * SCALE
    return F.lit(1) + F.call_function("div", share, F.nullif(total + size, F.lit(0)).cast("decimal(20,0)"))


def _f(p, q) -> Column:
    p, q = (F.col(x) if isinstance(x, str) else x for x in (p, q))
    return F.call_function("div", (p - q) * (p - q), q)


def _meetings(rows: DataFrame) -> DataFrame:
    """``a, b, value``: what terms that both groups hold change in the sum of a against b.

    Rows are ``gid, p, absent`` and the columns that stand for a term, whose rows come together.
    """

    def f(p, q):
        return (p - q) * (p - q) // q

    def pairs(gid, p, absent, *key) -> Iterator[pa.RecordBatch]:
        codes, code = np.unique(gid, return_inverse=True)
        size = len(codes)
        new = np.logical_or.reduce([k[1:] != k[:-1] for k in key])
        term = np.r_[0, np.cumsum(new)]
        keys, values = [], []
        dense = np.zeros(size * size, np.int64) if size <= 1024 else None
        for step in range(1, int(np.bincount(term).max())):
            left = np.flatnonzero(term[step:] == term[:-step])
            for i, j in ((left, left + step), (left + step, left)):
                key = code[i] * size + code[j]
                value = f(p[i], p[j]) - f(p[i], absent[j]) - f(absent[i], p[j]) + f(absent[i], absent[j])
                if dense is not None:
                    np.add.at(dense, key, value)
                else:
                    some, place = np.unique(key, return_inverse=True)
                    total = np.zeros(len(some), np.int64)
                    np.add.at(total, place, value)
                    keys.append(some)
                    values.append(total)
        if dense is not None:
            keys, values = [np.flatnonzero(dense)], [dense[dense != 0]]
        for key, value in zip(keys, values, strict=True):
            if len(key):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes[key // size]), pa.array(codes[key % size]), pa.array(value)],
                    ["a", "b", "value"],
                )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            more = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = more if held is None else [np.concatenate(x) for x in zip(held, more, strict=True)]
            if len(held[0]) < CHUNK:
                continue
            same = np.logical_and.reduce([k == k[-1] for k in held[3:]])
            cut = int(same.argmax())  # where the last term begins
            if cut:
                yield from pairs(*(c[:cut] for c in held))
                held = [c[cut:] for c in held]
        if held is not None and len(held[0]):
            yield from pairs(*held)

    return rows.mapInArrow(task, "a long, b long, value long")


def _pair_values(kept: DataFrame, stats: DataFrame, key: list[str]) -> DataFrame:
    """``a, b, value`` for all ordered pairs of groups of a language, from terms ``kept``
    (``key``, ``gid, p, absent``); ``absent`` is a group's p of a term it lacks."""
    ordered = kept.select("gid", "p", "absent", *key).repartition(*key).sortWithinPartitions(*key)
    both = _meetings(ordered)
    own = kept.groupBy("lid", F.col("gid").alias("g"), "p", F.col("absent").alias("g0")).agg(
        F.count("*").cast("decimal(20,0)").alias("m")
    )
    other = stats.select("lid", F.col("gid").alias("h"), F.col("absent").alias("h0"), "size")
    sided = own.join(other.drop("size"), "lid").filter("g <> h")
    here = F.struct(F.col("g").alias("a"), F.col("h").alias("b"), (F.col("m") * (_f("p", "h0") - _f("g0", "h0"))).alias("value"))
    there = F.struct(F.col("h").alias("a"), F.col("g").alias("b"), (F.col("m") * (_f("h0", "p") - _f("h0", "g0"))).alias("value"))
    changes = sided.select(F.inline(F.array(here, there)))
    summed = (
        both.withColumn("value", F.col("value").cast("decimal(38,0)"))
        .union(changes.withColumn("value", F.col("value").cast("decimal(38,0)")))
        .groupBy("a", "b").agg(F.sum("value").alias("change"))
    )
    mine = other.select("lid", F.col("h").alias("a"), F.col("h0").alias("a0"))
    every = mine.join(other.withColumnRenamed("h", "b"), "lid").filter("a <> b")
    base = F.coalesce(F.col("size").cast("decimal(20,0)") * _f("a0", "h0"), F.lit(0))
    value = (base + F.coalesce("change", F.lit(0))).cast("long")
    return every.join(summed, ["a", "b"], "left").select("a", "b", value.alias("value"))


def audit(docs: DataFrame, top: int = TOP, least: int = LEAST_DOCS, bits: int = 64) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every (lang, source) group of ``docs``.

    Part ``pair`` ranks all other sources of the language by their distance, part ``term`` the
    ``top`` terms that the group has more of than its language. ``bits`` narrows the digests
    (tests force collisions so).
    """
    groups = _groups(docs)
    cells, dictionary, names = _cells(docs, groups, bits)
    key = ["lid", *names]
    # one shuffle for the counts of groups and of languages
    per_group = cells.repartition(*key).groupBy(*key, "gid").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy(*key)
    kept = per_group.select(
        *key, "gid", "n",
        F.sum("n").over(term).alias("lang_n"),
        F.sum("docs").over(term).alias("lang_docs"),
        (F.min("gid").over(term) == F.col("gid")).alias("head"),
    )
    kept = stored(kept.filter(F.col("lang_docs") >= least).drop("lang_docs"), "kept-terms")

    total = kept.groupBy("gid").agg(F.sum("n").alias("total"))
    per_lang = kept.groupBy("lid").agg(F.count_if("head").alias("size"), F.sum("n").alias("lang_total"))
    filled = groups.join(total, "gid", "left").join(per_lang, "lid", "left").fillna(0)
    stats = stored(filled.withColumn("absent", _p(F.lit(0), "total", "size")), "group-totals")

    known = kept.join(stats.drop("lid"), "gid").select(
        *key, "gid", "absent",
        _p("n", "total", "size").alias("p"),
        _p("lang_n", "lang_total", "size").alias("q"),
    )
    most = F.desc("value")
    name = stats.select("gid", "lang", "source")
    pair = (
        _pair_values(known, stats.select("lid", "gid", "absent", "size"), key)
        .join(name.withColumnRenamed("gid", "a"), "a")
        .join(name.select(F.col("gid").alias("b"), F.col("source").alias("item")), "b")
        .withColumn("rank", F.row_number().over(Window.partitionBy("a").orderBy(most, "item")))
    )
    # ties at the last rank are kept until their text can order them
    first = known.filter("p > q").select("gid", *names, _f("p", "q").alias("value"))
    first = first.withColumn("place", F.rank().over(Window.partitionBy("gid").orderBy(most)))
    chosen = first.filter(F.col("place") <= top).join(dictionary, names)
    ranked = chosen.withColumn("rank", F.row_number().over(Window.partitionBy("gid").orderBy(most, "term")))
    terms = ranked.filter(F.col("rank") <= top).join(name, "gid")

    def out(rows: DataFrame, part: str, item: str) -> DataFrame:
        return rows.select(
            "lang", "source", F.lit(part).alias("part"), F.col(item).alias("item"), "value",
            F.col("rank").cast("int").alias("rank"),
        )

    return out(pair, "pair", "item").union(out(terms, "term", "term"))

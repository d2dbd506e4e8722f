"""Personal data and information-theoretic sanitisation (operator 3).

Protected entities are e-mail addresses, IP addresses, card and phone numbers. A term near
an entity reveals it as far as the corpus says so: with ``N`` distinct texts, of which
``c(t)`` hold the term, ``c(e)`` the entity and ``c(t, e)`` both (the term within ``reach``
words of the entity), the disclosure is

    PMI(t; e) / IC(e) = log(P(e | t) N / c(e)) / log(N / c(e)),
    P(e | t) = (c(t, e) + m c(e) / N) / (c(t) + m),

where ``m`` texts (``PRIOR``) in which the entity is as common as anywhere stand for what is
not known of a rare term. No count of texts is too small: a term that occurs once, beside an
entity that occurs once, has 1 - log(1 + m) / log(N), and the more texts confirm a term the
closer it gets to 1. Terms at or over ``threshold`` become further spans of kind ``term``:
numbers and capitalised words are generalised to ``[NUMBER]`` and ``[NAME]``, others are
removed. They are marked wherever they stand in the whole text of every document that holds
the entity; ``reach`` is for counting only. Words of one character are terms like others;
words inside a base span are none. Documents that hold the term but not the entity stay as
they are: what is protected is the entity of a document, which these do not have, and the
threshold leaves few of them.

Secrets, such as keys and tokens, are protected too: runs of at least ``SECRET_LENGTH`` letters
and digits, some of both, that carry ``SECRET_BITS`` bits or more by the entropy of their own
characters. They become spans of kind ``secret`` outside the base spans, which stay as they
are. No terms are gathered for them: a secret names nobody, and is safe once it is masked.
Documents with neither an entity nor a secret are never touched.

Defined results: null is as empty and has no span; repeated rows and null ids are judged row
by row, but equal texts count once in all counts; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from math import log2

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemirror.llm.common import arrow_map, stored

KINDS = ("email", "ip", "card", "phone", "term", "secret")
#: Words on each side of an entity that may reveal it.
REACH = 8
#: Texts that stand for what is not known of a term.
PRIOR = 0.5
#: Disclosure from which a term is generalised or removed.
THRESHOLD = 0.9
#: Characters, and bits of information, that make a run of letters and digits a secret.
SECRET_LENGTH, SECRET_BITS = 20, 64
#: Groups of equal texts whose counts are broadcast at most (about 32 bytes each).
BROADCAST_GROUPS = 1 << 22

_LOCAL_CHAR = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile("[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile("[^0-9]")
_TERM = re.compile(r"\w+")
_RUN = re.compile("[A-Za-z0-9]{%d,}" % SECRET_LENGTH)


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @ so that time stays linear."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHAR:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            free = domain.end()
        else:
            free = at + 1  # no later match can begin before this @
        at = text.find("@", max(at + 1, free))
    return out


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of all entities, in that order; kinds by their place in KINDS."""
    spans = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p[-4:]) < 256 for p in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def _bits(token: str) -> float:
    """Length by the entropy of the token's own characters."""
    return sum(n * log2(len(token) / n) for n in Counter(token).values())


def secret_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of all secrets that no base span touches, in order."""
    kind, out, at, reach = KINDS.index("secret"), [], 0, 0
    for m in _RUN.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][2])
            at += 1
        token = m[0]
        if reach <= m.start() and not token.isalpha() and not token.isdigit() and _bits(token) >= SECRET_BITS:
            out.append((m.start(), kind, m.end()))
    return out


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _free_words(text: str, spans: list) -> tuple[list[tuple[int, int]], list[bool]]:
    """Places of all words, and which of them lie outside all base spans."""
    covered: list[list[int]] = []  # base spans, those that overlap as one
    for start, _, end in spans:
        if covered and start < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    words, free, at = [m.span() for m in _TERM.finditer(text)], [], 0
    for a, b in words:
        while at < len(covered) and covered[at][1] <= a:
            at += 1
        free.append(at == len(covered) or covered[at][0] >= b)
    return words, free


def _entity(text: str, span: tuple[int, int, int]) -> int:
    start, kind, end = span
    value = text[start:end]
    if kind:
        value = _DIGITS.sub(" " if kind == 1 else "", value)
    return _hash(f"{KINDS[kind]}:{value.lower()}")


def _terms_near(text: str, spans: list, reach: int) -> tuple[list[int], set[tuple[int, int]], set[int]]:
    """Entities, pairs ``(term, entity)`` within reach, and all terms of the text."""
    words, free = _free_words(text, spans)
    terms = [_hash(text[a:b].lower()) if f else None for (a, b), f in zip(words, free, strict=True)]
    starts, ends = [a for a, _ in words], [b for _, b in words]
    held, near = set(), set()
    for span in spans:
        entity = _entity(text, span)
        held.add(entity)
        before, after = bisect_right(ends, span[0]), bisect_left(starts, span[2])
        for t in (*terms[max(0, before - reach) : before], *terms[after : after + reach]):
            if t is not None:
                near.add((t, entity))
    return sorted(held), near, {t for t in terms if t is not None}


_SPANS = "array<struct<start:int,kind:int,end:int>>"


def entities(docs: DataFrame, *keep: str, text: str = "text", reach: int = REACH) -> DataFrame:
    """Stored rows: ``_row``, columns ``keep``, ``base`` spans, ``kept_safe`` (base spans and
    secrets), entities ``held``, ``near`` pairs, of rows that have an entity all ``terms``, and of
    rows that have a span the text (``_held_text``).

    ``_row`` is an id of the row that stays as it is, since the rows are stored.
    """
    kept = docs.select(*keep, F.col(text).alias("_text"))
    types = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes[:-1])
    schema = (
        (types + ", " if types else "")
        + f"base {_SPANS}, kept_safe {_SPANS}, held array<long>, "
        + "near array<struct<term:long,entity:long>>, terms array<long>, _held_text string"
    )
    names = ("start", "kind", "end"), ("term", "entity")

    def each(*cols):
        base, safe, held, near, terms, texts = [], [], [], [], [], []
        for t in cols[-1]:
            spans = base_spans(t) if t else []
            every = sorted(spans + secret_spans(t, spans)) if t else []
            base.append([dict(zip(names[0], s, strict=True)) for s in spans])
            safe.append([dict(zip(names[0], s, strict=True)) for s in every])
            found = _terms_near(t, spans, reach) if spans else ([], (), ())
            held.append(found[0])
            near.append([dict(zip(names[1], p, strict=True)) for p in sorted(found[1])])
            terms.append(sorted(found[2]))
            texts.append(t if every else None)
        return [*cols[:-1], base, safe, held, near, terms, texts]

    found = arrow_map(kept, each, schema)
    return stored(found.withColumn("_row", F.monotonically_increasing_id()), "entities")


def weighed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_weight``: one over the number of rows with the same text.

    Sums of it count distinct texts. Only texts that occur again are listed and joined.
    """
    same = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    groups = docs.select(same.alias("_same")).groupBy("_same").agg(F.count("*").alias("_copies"))
    again = stored(groups.filter("_copies > 1"), "copies")
    few = again.count() <= BROADCAST_GROUPS
    joined = docs.withColumn("_same", same).join(F.broadcast(again) if few else again, "_same", "left")
    return joined.withColumn("_weight", 1 / F.coalesce("_copies", F.lit(1))).drop("_same", "_copies")


def _texts() -> F.Column:
    """Number of distinct texts."""
    return F.round(F.sum("_weight"))


def _term_counts(docs: DataFrame, text: str) -> DataFrame:
    """Distinct texts that hold each term; counted within a batch before anything is shuffled."""

    def each(texts, weights):
        counts: dict[str, float] = {}
        for t, n in zip(texts, weights, strict=True):
            for w in {w.lower() for w in _TERM.findall(t or "")}:
                counts[w] = counts.get(w, 0.0) + n
        return [[_hash(w) for w in counts], list(counts.values())]

    batches = arrow_map(docs.select(F.col(text).alias("_text"), "_weight"), each, "term long, _weight double")
    return batches.groupBy("term").agg(_texts().alias("c_t"))


def revealing(
    docs: DataFrame, found: DataFrame, text: str = "text",
    prior: float = PRIOR, threshold: float = THRESHOLD,
) -> DataFrame:
    """Pairs ``term, entity, disclosure`` at or over the threshold.

    Counts are over all distinct texts, by the ``_weight`` of the rows of ``docs`` and
    ``found``. A pair is counted once per text where it is found.
    """
    pairs = found.select("_weight", F.explode("near").alias("p")).select("_weight", "p.*")
    together = pairs.groupBy("term", "entity").agg(_texts().alias("c_te"))
    per_entity = (
        found.select("_weight", F.explode("held").alias("entity"))
        .groupBy("entity")
        .agg(_texts().alias("c_e"))
    )
    total = F.lit(float(found.agg(F.coalesce(_texts(), F.lit(0.0))).first()[0]))
    known = together.join(per_entity, "entity").join(_term_counts(docs, text), "term")
    ic = F.log(total / F.col("c_e"))
    p_e = (F.col("c_te") + prior * F.col("c_e") / total) / (F.col("c_t") + prior)
    pmi = F.log(p_e * total / F.col("c_e"))
    return (
        known.withColumn("disclosure", F.when(ic > 0, pmi / ic).otherwise(0.0))
        .filter(F.col("disclosure") >= threshold)
        .select("term", "entity", "disclosure")
    )


def revealed(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """``_row`` and ``marked``: the terms of each row that reveal an entity that it holds.

    The terms of rows with an entity meet the pairs by term, of which few reveal anything;
    joined by entity, one entity of many documents would meet all its terms in each of them.
    """
    pairs = stored(pairs.select("term", "entity"), "revealing")
    terms = found.filter(F.size("base") > 0).select("_row", F.explode("terms").alias("term"))
    held = found.select("_row", F.explode("held").alias("entity"))
    hits = terms.join(pairs, "term").join(held, ["_row", "entity"], "left_semi")
    return hits.groupBy("_row").agg(F.collect_set("term").alias("marked"))


def _all_spans(text: str | None, safe: list, marked: list | None) -> list[tuple[int, int, int]]:
    """Base spans, secrets, and every occurrence of the marked terms outside them, in order."""
    spans = [(s["start"], s["kind"], s["end"]) for s in safe]
    if not marked:
        return spans
    wanted, kind = set(marked), KINDS.index("term")
    words, free = _free_words(text, spans)
    return sorted(spans + [
        (a, kind, b) for (a, b), f in zip(words, free, strict=True) if f and _hash(text[a:b].lower()) in wanted
    ])


def spans(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """Columns ``keep``, ``base`` and ``spans``: entities, and these with secrets and revealing terms."""
    docs = weighed(docs, text)
    found = entities(docs, *keep, "_weight", text=text)
    marked = revealed(found, revealing(docs, found, text))
    touched = F.size("kept_safe") > 0
    own = [f"c{i}" for i in range(len(keep))]
    joined = (
        found.filter(touched).join(marked, "_row", "left")
        .select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, own, strict=True)], "base", "kept_safe", "_held_text", "marked")
    )
    kinds = "".join(f"{c} {t}, " for c, t in joined.select(*own).dtypes)
    names = ("start", "kind", "end")

    def each(*cols):
        every = [
            [dict(zip(names, s, strict=True)) for s in _all_spans(t, b, m)]
            for b, t, m in zip(*cols[-3:], strict=True)
        ]
        return [*cols[:-3], every]

    done = arrow_map(joined, each, f"{kinds}base {_SPANS}, spans {_SPANS}").toDF(*keep, "base", "spans")
    return done.union(found.filter(~touched).select(*keep, "base", F.col("base").alias("spans")))


def span_text(column: str) -> F.Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(column, lambda s: F.concat_ws(
        ":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _masked(text: str, marks: list[tuple[int, int, int]]) -> str:
    out, done = [], 0
    for start, k, end in marks:
        if start < done:  # inside or across a span that is masked already
            done = max(done, end)
            continue
        out.append(text[done:start])
        kind = KINDS[k]
        if kind != "term":
            out.append(f"[{kind.upper()}]")
        elif text[start].isdigit():
            out.append("[NUMBER]")
        elif text[start].isupper():
            out.append("[NAME]")
        done = end
    return "".join(out) + text[done:]


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with entities replaced by their kind, revealing terms generalised or removed.

    All columns and rows stay. Only rows with an entity or a secret go through the join with the terms.
    """
    others = [c for c in docs.columns if c != text]
    own = [f"c{i}" for i in range(len(others))]
    renamed = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(others, own, strict=True)], F.col(text).alias("whole")
    )
    renamed = weighed(renamed, "whole")
    found = entities(renamed, *own, "whole", "_weight", text="whole")
    marked = revealed(found, revealing(renamed, found, "whole"))
    touched = F.size("kept_safe") > 0
    joined = found.filter(touched).join(marked, "_row", "left").select(*own, "whole", "kept_safe", "marked")
    kinds = "".join(f"{c} {t}, " for c, t in joined.select(*own).dtypes)

    def each(*cols):
        return [*cols[:-3], [_masked(t, _all_spans(t, b, m)) for t, b, m in zip(*cols[-3:], strict=True)]]

    masked = arrow_map(joined, each, f"{kinds}whole string")
    every = masked.union(found.filter(~touched).select(*own, "whole"))
    place = dict(zip(others, own, strict=True)) | {text: "whole"}
    return every.select(*[F.col(place[c]).alias(c) for c in docs.columns])

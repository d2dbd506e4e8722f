"""N-gram Jaccard join by signature trees (operator 1).

Two documents link when their sets of word 5-grams have a Jaccard similarity of 0.8 or more;
the result is the connected component of each document. The work is on distinct sets
(classes), each known by a hash of its sorted shingle hashes:

1. Order. Any fixed order of the shingles gives exact prefixes: two linked sets share a
   shingle among the first ``n - ceil(0.8 n) + 1`` of each. Shingles go by hash, except that
   those found in ``HOT_DOCS`` documents or more come last, so that a passage which many
   documents share is no meeting place. Of these the ``MAX_HOT`` most frequent are listed, a
   list of bounded size that goes to every task; any list gives whole results.
2. Stars. Classes that share a prefix shingle are compared with one of them only, then those
   still apart with a few of the largest component that they meet. Verified links are joined
   to components at once. A group of thousands of near copies is linked by a few
   comparisons for each member, not by all its pairs.
3. Trees. Where classes of different components still share a prefix shingle, each group is
   dealt to blocks of bounded size, and each pair of blocks builds signature trees: leaves
   are classes in order of size, a node holds the OR of its leaves' bitmaps, their range of
   sizes and their component if it is one. Two trees are traversed together from the top; a
   pair of nodes is pruned if sizes or the largest possible overlap rule out a link, or if all
   its leaves are of one component. Surviving pairs of leaves are verified by their sets.
   Most groups hold a few classes, whose tree is one node over its leaves: their pairs of
   leaves are made for all such groups of a batch at once, and since documents mostly meet
   in several groups, the distinct pairs fetch their bitmaps once for the same bound.

Shingles are 64-bit hashes: sizes and links are exact but for their collisions. Sets are made
anew from the texts of the classes in question, not stored.

Defined results: null, empty and wordless texts have no shingle and are their own component;
a text of fewer than five words is one shingle; equal sets link; a null id counts only where
no other id is in its component; repeated rows share a component; an empty table gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablemirror.llm.common import arrow_map, components, give_back, ship, stored

WORDS = 5
#: Documents from which a shingle is hot, and hot shingles that are listed at most (8 MB).
HOT_DOCS, MAX_HOT = 24, 1_000_000
#: Members of the largest component that a class still apart is compared with, by round.
STARS = (1, 4, 4)
#: Classes of one block of a group.
BLOCK = 1024
#: Children of a node.
FAN = 8
#: First shared shingles of a class by which a pair that is found in several groups comes once.
FIRSTS = 4
#: Bytes of ids up to which the documents to verify are found by a broadcast.
BROADCAST_BYTES = 32 << 20
_PIECE = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TABLE = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def links(overlap, a, b):
    """100 * intersection >= 80 * union, in whole numbers."""
    return 9 * overlap >= 4 * (a + b)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        piece, size = [], 0
        while at < len(texts) and (not piece or size < _PIECE):
            piece.append((texts[at] or "").encode("utf-8", "surrogatepass"))
            size += len(piece[-1])
            at += 1
        out.extend(_sets_of(piece))
    return out


def _sets_of(contents: list[bytes]) -> Iterator[np.ndarray]:
    data = _LOWER[np.frombuffer(b"\n".join(contents) + b"\n", np.uint8)]
    word = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(np.r_[False, word].astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    sizes = ends - starts
    ends_of_texts = np.cumsum([len(c) + 1 for c in contents])
    upto = np.searchsorted(starts, ends_of_texts)
    if len(starts):
        first = np.cumsum(sizes) - sizes
        powers = np.multiply.accumulate(np.full(int(sizes.max()) + 1, _STEP))
        inside = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
        hashes = _mix(np.add.reduceat(_TABLE[data[word]] * powers[inside], first) + sizes.astype(np.uint64))
        grams = hashes[: max(len(hashes) - WORDS + 1, 0)].copy()
        for k in range(1, WORDS):
            grams = grams * _STEP + hashes[k : k + len(grams)]
        grams = _mix(grams)
    before = 0
    for end in upto.tolist():
        n = end - before
        if n >= WORDS:
            yield np.unique(grams[before : end - WORDS + 1])
        elif n:
            total = np.array([n], np.uint64)  # the count keeps a short text apart from a gram
            for k in range(before, end):
                total = total * _STEP + hashes[k : k + 1]
            yield _mix(total * np.uint64(3))
        else:
            yield np.array([], np.uint64)
        before = end


def prefix_length(n: int) -> int:
    return n - -(-4 * n // 5) + 1


def _bits(n: int) -> int:
    """Size of the bitmap of a set: a power of two, four times the set or more."""
    return max(512, 1 << max(4 * n - 1, 1).bit_length())


def bitmap(tokens: np.ndarray) -> np.ndarray:
    size = _bits(len(tokens))
    words = np.zeros(size // 8, np.uint8)
    place = (tokens & np.uint64(size - 1)).astype(np.int64)
    np.bitwise_or.at(words, place >> 3, (1 << (place & 7)).astype(np.uint8))
    return words


# ---------------------------------------------------------------- passes over the texts


def hot_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles of HOT_DOCS documents or more, the most frequent MAX_HOT of them.

    Counted over all documents, copies within a batch once. What a batch of thousands of
    documents holds less than three times is not handed on, so a count may be too low; the
    order of the shingles decides where classes meet, never which are found.
    """

    def each(texts):
        distinct = {s.tobytes(): s for s in shingle_sets(texts) if len(s)}
        if not distinct:
            return [[], []]
        found, n = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
        return [found[n > 2].view(np.int64).tolist(), n[n > 2].tolist()]

    counted = arrow_map(docs.select("text"), each, "token long, n long")
    hot = counted.groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= HOT_DOCS)
    listed = hot.orderBy(F.desc("n"), "token").limit(MAX_HOT).select("token").toArrow()
    return np.sort(listed["token"].to_numpy().view(np.uint64))


def sketches(docs: DataFrame, hot: np.ndarray, *keep: str) -> DataFrame:
    """Stored rows: ``keep``, ``key`` (digest of the text), ``n``, class ``v``, ``prefix`` and
    ``bits`` (8-byte shingles and bitmap). ``docs`` has ``text``."""
    own = docs.select(*keep, F.md5(F.col("text").cast("binary")).alias("key"), "text")
    types = ", ".join(f"`{c}` {t}" for c, t in own.dtypes[:-1])

    def each(*cols):
        n, v, prefixes, maps = [], [], [], []
        for s in shingle_sets(cols[-1]):
            n.append(len(s))
            if not len(s):
                v.append(None)
                prefixes.append(None)
                maps.append(None)
                continue
            v.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63))
            take = prefix_length(len(s))
            if len(hot):
                at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
                is_hot = hot[at] == s
                chosen = s[~is_hot][:take]
                if len(chosen) < take:
                    chosen = np.concatenate([chosen, s[is_hot][: take - len(chosen)]])
            else:
                chosen = s[:take]
            prefixes.append(chosen.view(np.int64).tolist())
            maps.append(bitmap(s).tobytes())
        return [*cols[:-1], n, v, prefixes, maps]

    return stored(
        arrow_map(own, each, f"{types}, n long, v long, prefix array<long>, bits binary"), "sketches"
    )


def _verified(pairs: DataFrame, docs: DataFrame, sketched: DataFrame) -> DataFrame:
    """Stored links ``a, b`` among the pairs ``a, b`` of classes."""
    asked = stored(pairs, "pairs")
    wanted = asked.select(F.col("a").alias("v")).union(asked.select(F.col("b").alias("v"))).distinct()
    keys = stored(
        sketched.select("v", "key").join(wanted, "v", "left_semi").groupBy("v").agg(F.min("key").alias("key")),
        "wanted",
    )
    size = 40 * keys.count()
    texts = docs.select(F.md5(F.col("text").cast("binary")).alias("key"), "text")
    small = F.broadcast(keys) if size <= BROADCAST_BYTES else keys
    chosen = texts.join(small, "key").groupBy("v").agg(F.any_value("text").alias("text"))

    def each(v, contents):
        return [v, [s.tobytes() for s in shingle_sets(contents)]]

    sets = stored(arrow_map(chosen, each, "v long, tokens binary"), "sets")

    def compare(a, b, left, right):
        out = []
        for x, y in zip(left, right, strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            same = len(x) + len(y) - len(np.union1d(x, y))
            out.append(bool(links(same, len(x), len(y))))
        return [a, b, out]

    both = asked.join(
        sets.select(F.col("v").alias("a"), F.col("tokens").alias("left")), "a"
    ).join(sets.select(F.col("v").alias("b"), F.col("tokens").alias("right")), "b")
    told = arrow_map(both.select("a", "b", "left", "right"), compare, "a long, b long, linked boolean")
    return stored(told.filter("linked").select("a", "b"), "links")


# ---------------------------------------------------------------- trees


class Tree:
    """Levels of nodes over classes in order of size; level 0 holds the leaves."""

    def __init__(self, n: np.ndarray, component: np.ndarray, bits: np.ndarray):
        excess = n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(n, n, excess, component, np.ones(len(n), bool), bits)]
        while len(self.levels[-1][0]) > FAN:
            low, high, excess, component, one, bits = self.levels[-1]
            at = np.arange(0, len(low), FAN)
            least, most = np.minimum.reduceat(component, at), np.maximum.reduceat(component, at)
            self.levels.append((
                np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                np.maximum.reduceat(excess, at), least,
                np.logical_and.reduceat(one, at) & (least == most),
                np.bitwise_or.reduceat(bits, at, axis=0),
            ))


def traverse(left: Tree, right: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of the two trees that may link and are of different components.

    For one tree against itself each pair comes once, the smaller place first.
    """
    level = max(len(left.levels), len(right.levels)) - 1

    def nodes(tree, level):
        return tree.levels[min(level, len(tree.levels) - 1)]

    i, j = (
        g.ravel() for g in np.meshgrid(
            np.arange(len(nodes(left, level)[0])), np.arange(len(nodes(right, level)[0])), indexing="ij"
        )
    )
    while True:
        a, b = nodes(left, level), nodes(right, level)
        if left is right:
            fit = i < j if level == 0 else i <= j
            i, j = i[fit], j[fit]
        # a link needs sizes within 4 : 5 of each other and overlap of 4/9 of both sizes
        fit = (5 * a[1][i] >= 4 * b[0][j]) & (5 * b[1][j] >= 4 * a[0][i])
        fit &= ~(a[4][i] & b[4][j] & (a[3][i] == b[3][j]))
        i, j = i[fit], j[fit]
        kept = []
        for at in range(0, len(i), 16384):
            x, y = i[at : at + 16384], j[at : at + 16384]
            shared = np.bitwise_count(a[5][x] & b[5][y]).sum(axis=1, dtype=np.int64)
            bound = shared + np.minimum(a[2][x], b[2][y])
            kept.append(links(bound, a[0][x], b[0][y]))
        if kept:
            keep = np.concatenate(kept)
            i, j = i[keep], j[keep]
        if level == 0 or not len(i):
            return i, j
        level -= 1
        for tree, side in ((left, 0), (right, 1)):
            if level < len(tree.levels) - 1:  # this tree is as high as the level that was left
                place = (i, j)[side]
                child = place[:, None] * FAN + np.arange(FAN)
                fits = (child < len(tree.levels[level][0])).ravel()
                i, j = (
                    child.ravel() if s == side else np.repeat((i, j)[s], FAN) for s in (0, 1)
                )
                i, j = i[fits], j[fits]


def candidate_pairs(v, component, n, bits, block, firsts=None, token=0) -> list[tuple[int, int]]:
    """Pairs of classes of one group that may link. With two blocks, only pairs across.

    ``firsts`` holds the first shingles at which each class meets others: a pair that shares one
    below ``token`` is found in the group of that shingle and left out here.
    """
    v, component, n = (np.array(x, np.int64) for x in (v, component, n))
    if firsts is not None:
        early = np.full((len(v), FIRSTS), np.iinfo(np.int64).max)
        for r, f in enumerate(firsts):
            early[r, : len(f)] = f
    block = np.array(block)
    sizes = np.array([len(b) for b in bits])
    across = len(np.unique(block)) > 1
    out = []

    def tree(rows, width):
        rows = rows[np.lexsort((component[rows], n[rows]))]
        flat = np.stack([np.frombuffer(bits[r], np.uint8) for r in rows])
        while flat.shape[1] > width:  # a bitmap of half the size is the OR of its halves
            flat = flat[:, : flat.shape[1] // 2] | flat[:, flat.shape[1] // 2 :]
        return rows, Tree(n[rows], component[rows], np.ascontiguousarray(flat).view(np.uint64))

    def pair(one, other):
        (rows, t), (more, u) = one, other
        i, j = traverse(t, u)
        i, j = rows[i], more[j]
        if firsts is not None and len(i):
            known = np.zeros(len(i), bool)
            for a in range(FIRSTS):
                mine = early[i, a]
                known |= (mine < token) & (early[j] == mine[:, None]).any(axis=1)
            i, j = i[~known], j[~known]
        out.append((v[i], v[j]))

    for width in np.unique(sizes):
        near = [np.flatnonzero(sizes == w) for w in (width, 2 * width)]
        if across:
            for a in (0, 1):
                for b in (0, 1):
                    left = near[a][block[near[a]] == block.min()]
                    right = near[b][block[near[b]] != block.min()]
                    if not (a and b) and len(left) and len(right):
                        pair(tree(left, width), tree(right, width))
        else:
            mine = tree(near[0], width)
            pair(mine, mine)
            if len(near[1]):
                pair(mine, tree(near[1], width))
    found = [np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1) for a, b in out if len(a)]
    return np.unique(np.concatenate(found), axis=0).tolist() if found else []


def leaf_pairs(token, v, component, n) -> np.ndarray:
    """Distinct pairs of rows that lie in one run of equal tokens and may link by their sizes
    and components; the rows lie in order of their tokens."""
    token, v, component, n = (np.asarray(x, np.int64) for x in (token, v, component, n))
    found = [np.zeros((0, 2), np.int64)]
    for step in range(1, FAN):
        i = np.flatnonzero(token[step:] == token[:-step])
        j = i + step
        if not len(i):
            break
        fit = (component[i] != component[j]) & (5 * n[i] >= 4 * n[j]) & (5 * n[j] >= 4 * n[i])
        i, j = i[fit], j[fit]
        found.append(np.stack([np.minimum(v[i], v[j]), np.maximum(v[i], v[j])], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def _leaf_pairs(groups: DataFrame) -> DataFrame:
    """Distinct pairs ``a, b`` of the groups of FAN rows at most, whose rows lie together."""
    ship(groups.sparkSession)

    def pairs(batches):
        rest = None  # the last group of a batch may go on in the next
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is not None:
                columns = [np.concatenate(c) for c in zip(rest, columns, strict=True)]
            keep = int(np.searchsorted(columns[0], columns[0][-1])) if len(columns[0]) else 0
            if keep:
                yield out(leaf_pairs(*(c[:keep] for c in columns)))
            rest = [c[keep:] for c in columns]
        if rest is not None:
            yield out(leaf_pairs(*rest))
        rest = None
        give_back()

    def out(found):
        return pa.RecordBatch.from_arrays([pa.array(found[:, k]) for k in (0, 1)], ["a", "b"])

    return groups.select("token", "v", "component", "n").mapInArrow(pairs, "a long, b long").distinct()


def _tree_pairs(groups: DataFrame) -> DataFrame:
    """Distinct pairs ``a, b`` from rows ``token, left, right, v, component, n, bits, block, firsts``
    of which those of one token and pair of blocks (left, right) lie together."""
    ship(groups.sparkSession)

    def blocks(batches):
        held, last = [], None

        def done():
            columns = ([r[c] for r in held] for c in ("v", "component", "n", "bits", "block", "firsts"))
            pairs = candidate_pairs(*columns, token=held[0]["token"])
            a, b = zip(*pairs, strict=True) if pairs else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for row in batch.slice(at, 512).to_pylist():
                    group = (row["token"], row["left"], row["right"])
                    if group != last and len(held) > 1:
                        yield done()
                    if group != last:
                        held = []
                    held.append(row)
                    last = group
        if len(held) > 1:
            yield done()
        held = []
        give_back()

    return groups.mapInArrow(blocks, "a long, b long").distinct()


# ---------------------------------------------------------------- operator


def _may_link(a, b):
    """Condition on the sizes of two classes."""
    return (5 * F.col(a) >= 4 * F.col(b)) & (5 * F.col(b) >= 4 * F.col(a))


def _star_pairs(shared: DataFrame, centres: int, turn: int) -> DataFrame:
    """Pairs ``a, b`` of each class with a member of the largest component of each group it is
    in, if that is another one. There are ``centres`` rules by which members are chosen, one for
    each group, so a class meets some ``centres`` members of a component."""
    rule = F.xxhash64("v", F.pmod("token", F.lit(centres)), F.lit(turn))
    me = F.struct("size", "component", rule.alias("rule"), "v", "n")
    sizes = shared.select("v", "component").distinct().groupBy("component").agg(F.count("*").alias("size"))
    # windows, not joins of a table with its own groups: fewer stages and tasks for the driver to hold
    sized = shared.join(sizes, "component").withColumn("m", F.max(me).over(Window.partitionBy("token")))
    met = sized.filter((F.col("component") != F.col("m.component")) & _may_link("n", "m.n"))
    return met.select(F.least("v", "m.v").alias("a"), F.greatest("v", "m.v").alias("b")).distinct()


def _bounded(pairs: DataFrame, maps: DataFrame) -> DataFrame:
    """Pairs ``a, b`` whose bitmaps allow a link."""
    joined = pairs.select("a", "b").join(
        maps.select(F.col("v").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("left")), "a"
    ).join(maps.select(F.col("v").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("right")), "b")

    def each(a, b, n_a, n_b, left, right):
        keep = []
        for n, m, x, y in zip(n_a, n_b, left, right, strict=True):
            x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
            while len(x) > len(y):
                x = x[: len(x) // 2] | x[len(x) // 2 :]
            while len(y) > len(x):
                y = y[: len(y) // 2] | y[len(y) // 2 :]
            p, q, both = (int(np.bitwise_count(z).sum()) for z in (x, y, x & y))
            keep.append(bool(links(both + min(n - p, m - q), n, m)))
        return [a, b, keep]

    told = arrow_map(joined.select("a", "b", "n_a", "n_b", "left", "right"), each, "a long, b long, may boolean")
    return told.filter("may").select("a", "b")


def _across(shared: DataFrame) -> DataFrame:
    """The rows of groups in which two components meet, with the size of the group."""
    token = Window.partitionBy("token")
    met = (
        shared.withColumn("low", F.min("component").over(token))
        .withColumn("high", F.max("component").over(token))
        .withColumn("members", F.count("*").over(token))
    )
    return met.filter("low <> high").drop("low", "high")


def _renamed(shared: DataFrame, joined: DataFrame) -> DataFrame:
    """``shared`` with the components of ``joined`` (``v, component``)."""
    new = joined.select("v", F.col("component").alias("now"))
    return shared.join(new, "v", "left").withColumn(
        "component", F.coalesce("now", "component")
    ).drop("now")


def _stars(joined: DataFrame) -> DataFrame:
    """Components as links ``a, b`` that join them in one round."""
    return joined.select(F.col("v").alias("a"), F.col("component").alias("b"))


def classes(docs: DataFrame, *keep: str) -> tuple[DataFrame, DataFrame]:
    """Sketched rows of ``docs`` (which has ``text``), and ``v, component`` of linked classes."""
    sketched = sketches(docs, hot_shingles(docs), *keep)
    tokens = sketched.filter("v is not null").select("v", "n", F.explode("prefix").alias("token"))
    # copies meet in min and max before the shuffle; most shingles are of one class only
    shared_tokens = (
        tokens.groupBy("token").agg(F.min("v").alias("low"), F.max("v").alias("high"))
        .filter("low <> high").select("token")
    )
    shared = stored(
        tokens.join(shared_tokens, "token", "left_semi").distinct().withColumn("component", F.col("v")), "shared"
    )
    maps = stored(
        sketched.filter("v is not null").select("v", "n", "bits")
        .join(shared.select("v").distinct(), "v", "left_semi")
        .groupBy("v").agg(F.any_value("n").alias("n"), F.any_value("bits").alias("bits")),
        "bitmaps",
    )
    joined = None
    for turn, centres in enumerate(STARS):
        some = _verified(_bounded(_star_pairs(shared, centres, turn), maps), docs, sketched)
        joined = components(some if joined is None else some.union(_stars(joined)))
        shared = stored(_across(_renamed(shared, joined)).drop("members"), "shared")
    met = stored(_across(shared), "groups")
    small = met.filter(F.col("members") <= FAN).repartition("token").sortWithinPartitions("token")
    few = _bounded(_leaf_pairs(small), maps)
    firsts = met.groupBy("v").agg(F.slice(F.sort_array(F.collect_list("token")), 1, FIRSTS).alias("firsts"))
    met = met.filter(F.col("members") > FAN)
    parts = F.greatest(F.lit(1), F.ceil(F.col("members") / BLOCK)).cast("int")
    dealt = met.withColumn("parts", parts).withColumn(
        "block", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int")
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    groups = (
        dealt.withColumn("left", F.least("block", "other"))
        .withColumn("right", F.greatest("block", "other"))
        .join(maps.select("v", "bits").join(firsts, "v"), "v")
        .select("token", "left", "right", "v", "component", "n", "bits", "block", "firsts")
        .repartition("token", "left", "right")
        .sortWithinPartitions("token", "left", "right")
    )
    late = _verified(_tree_pairs(groups).union(few).distinct(), docs, sketched)
    return sketched, components(late.union(_stars(joined)))


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    own = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    sketched, joined = classes(own, "id")
    per_class = sketched.filter("v is not null").groupBy("v").agg(F.min("id").alias("least"))
    placed = per_class.join(joined, "v", "left").withColumn("component", F.coalesce("component", "v"))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "component").select("v", "component_id")
    return sketched.select("id", "n", "v").join(named, "v", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("v").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (an id before
    null), then the smallest digest of its text; of equal rows one. Rows without a shingle
    all stay."""
    own = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    sketched, joined = classes(own, "id")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    per_class = sketched.filter("v is not null").groupBy("v").agg(F.min(order).alias("first"))
    placed = per_class.join(joined, "v", "left").withColumn("component", F.coalesce("component", "v"))

    def mark(digest, identity):
        return F.concat(digest, F.lit(":"), F.coalesce(F.col(identity).cast("string"), F.lit("null")))

    # one key for the join and for the rows that are equal in it: texts are shuffled once
    chosen = placed.groupBy("component").agg(F.min("first").alias("first")).select(
        mark(F.col("first.key"), "first.id").alias("_mark")
    )
    names = [f"c{i}" for i in range(len(docs.columns))]
    numbered = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)],
        mark(F.md5(F.col(text).cast("binary")), f"`{doc_id}`").alias("_mark"),
    )
    wordless = F.coalesce(~F.col(names[docs.columns.index(text)]).rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    kept = numbered.filter(~wordless).join(chosen, "_mark", "left_semi").dropDuplicates(["_mark"])
    return kept.select(*names).union(numbered.filter(wordless).select(*names)).toDF(*docs.columns)

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import awkward
from tablemirror.llm import jaccard
from tablemirror.llm.common import components


def expected(pairs):
    sets, top = awkward.jaccard_groups([t for _, t in pairs])
    ids = {}
    for (i, _), g in zip(pairs, top):
        if i is not None:
            ids[g] = min(ids.get(g, i), i)
    return [(i, len(s), ids.get(g) if s else i) for (i, _), s, g in zip(pairs, sets, top)]


def test_awkward_documents(spark):
    pairs = awkward.rows()
    got = jaccard.join(awkward.documents(spark, pairs)).collect()
    awkward.same_rows(got, expected(pairs))


def test_one_row_of_each_group_stays(spark):
    pairs = awkward.rows()
    docs = awkward.documents(spark, pairs)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    sets, top = awkward.jaccard_groups([t for _, t in pairs])
    got = [(r.doc_id, r.text) for r in kept.collect()]
    wordless = [p for p, s in zip(pairs, sets) if not s]
    assert len(got) == len(wordless) + len({g for g, s in zip(top, sets) if s})
    for i, t in got:
        if awkward.shingles(t):
            g = top[[p for p in pairs].index((i, t))]
            ids = [p[0] for p, other in zip(pairs, top) if other == g and p[0] is not None]
            assert i == (min(ids) if ids else None)


def test_groups_of_near_copies_dealt_to_several_blocks(spark, monkeypatch):
    """Chains of ever more changed texts: neighbours link, the ends do not."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    base = [f"w{i}" for i in range(120)]
    pairs = []
    for family in range(3):
        for step in range(14):
            text = [f"f{family}{w}" for w in base]
            text[: 2 * step] = [f"x{family}{k}" for k in range(2 * step)]
            pairs.append((len(pairs), " ".join(text)))
    got = jaccard.join(awkward.documents(spark, pairs)).collect()
    awkward.same_rows(got, expected(pairs))


def test_empty_table(spark):
    docs = awkward.documents(spark).limit(0)
    assert jaccard.join(docs).collect() == []
    assert jaccard.one_of_each(docs).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 40), st.integers(0, 3))
def test_traversal_loses_no_pair(seed, count, parts):
    rng = np.random.default_rng(seed)
    pool = rng.integers(1, 1 << 63, 80).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, rng.integers(1, 70))) for _ in range(count)]
    component = rng.integers(0, 1 + count // (parts + 1), count)
    bits = [jaccard.bitmap(s).tobytes() for s in sets]
    block = rng.integers(0, 2, count)
    sizes = [len(s) for s in sets]
    for blocks in (np.zeros(count, int), block):
        got = {tuple(p) for p in jaccard.candidate_pairs(np.arange(count), component, sizes, bits, blocks)}
        for i in range(count):
            for j in range(i):
                same = len(np.intersect1d(sets[i], sets[j]))
                linked = jaccard.links(same, sizes[i], sizes[j]) and component[i] != component[j]
                if linked and (len(set(blocks)) == 1 or blocks[i] != blocks[j]):
                    assert (j, i) in got


@given(st.lists(st.text(alphabet="aB \n\té1", max_size=40), max_size=6))
@settings(max_examples=100, deadline=None)
def test_sizes_of_sets(texts):
    assert [len(s) for s in jaccard.shingle_sets(texts)] == [len(awkward.shingles(t)) for t in texts]


@pytest.mark.parametrize("shape", ["chain", "star", "none"])
def test_components(spark, shape):
    edges = {
        "chain": [(i, i + 1) for i in range(40)] + [(100, 101)],
        "star": [(50, i) for i in range(60, 90)],
        "none": [],
    }[shape]
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = awkward.Groups(200)
    for a, b in edges:
        groups.tie(a, b)
    used = {x for e in edges for x in e}
    assert got == {(x, groups.top(x)) for x in used if groups.top(x) != x}


def test_rounds_of_components_run_few_tasks(spark):
    """The driver keeps a record of every task; edges that fit one file are no reason for many."""
    n, edges = 40, [(50, i) for i in range(60, 90)]
    partitions, context = spark.conf.get("spark.sql.shuffle.partitions"), spark.sparkContext
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", n)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    context.setJobGroup("components", "tasks of components")
    try:
        got = components(spark.createDataFrame(edges, "a long, b long")).collect()
        told = context.statusTracker()
        stages = {s for j in told.getJobIdsForGroup("components") for s in told.getJobInfo(j).stageIds}
        infos = [told.getStageInfo(s) for s in stages]
        tasks = sum(i.numCompletedTasks for i in infos if i)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    assert {tuple(r) for r in got} == {(i, 50) for i in range(60, 90)}
    assert tasks < 10 * n  # a shuffle of all edges, then two rounds of three

"""Operator 11: flattened arrays against a plain walk, splits against all splits, held-out accuracy."""

import zlib

import numpy as np
import pytest

import awkward
from tablemirror.llm import boosting, queries


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    good, bad = (y == 1).sum(), (y == 0).sum()
    return (rank[y == 1].sum() - good * (good + 1) / 2) / (good * bad)


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(size=600), rng.integers(0, 4, 600), np.zeros(600), rng.exponential(size=600)])
    return x, ((x[:, 0] > 0) ^ (x[:, 1] == 2)).astype(float)


def test_arrays_against_a_plain_walk(sample):
    forest = boosting.grow(*sample, trees=30)

    def walk(row):
        total = forest.base
        for node in forest.roots:
            while forest.left[node] != node:
                low = row[forest.feature[node]] <= forest.threshold[node]
                node = forest.left[node] if low else forest.right[node]
            total += forest.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(forest.score(sample[0]), [walk(r) for r in sample[0]], atol=1e-12)
    assert ((forest.score(sample[0]) >= 0.5) == sample[1]).mean() > 0.97
    assert len(forest.score(np.empty((0, 4)))) == 0


def test_the_best_split_of_all(sample):
    x, y = sample
    g, h = 0.5 - y, np.full(len(y), 0.25)
    edges = [boosting.bin_edges(x[:, j]) for j in range(x.shape[1])]
    size = max(map(len, edges)) + 1
    sums = np.zeros((x.shape[1], size, 2))
    for j, e in enumerate(edges):
        for i, k in enumerate(np.searchsorted(e, x[:, j], "left")):
            sums[j, k] += g[i], h[i]
    gain, j, k = boosting.best_split(sums)

    def plain(j, edge):
        low = x[:, j] <= edge
        part = lambda m: g[m].sum() ** 2 / (h[m].sum() + boosting.PENALTY)
        if min(h[low].sum(), h[~low].sum()) < boosting.LEAST_HESSIAN:
            return 0
        return part(low) + part(~low) - part(low | True)

    every = {(j, k): plain(j, edge) for j, e in enumerate(edges) for k, edge in enumerate(e)}
    assert np.isclose(gain, max(every.values())) and np.isclose(every[j, k], gain)


def test_bins_of_few_and_many_values():
    assert list(boosting.bin_edges(np.array([3.0, 1, 1, 2]))) == [1, 2]
    assert len(boosting.bin_edges(np.zeros(5))) == 0
    assert len(boosting.bin_edges(np.arange(1000.0))) <= boosting.BINS


def test_statistics_of_a_text():
    got = dict(zip(boosting.STATISTICS, boosting.statistics("One two.\n\nOne two.\n#3 é"), strict=True))
    assert got["words"] == 6 and got["lines"] == 3 and got["words_a_line"] == 2
    assert got["repeated_lines"] == pytest.approx(1 / 3) and got["closed_lines"] == pytest.approx(2 / 3)
    assert got["distinct_words"] == pytest.approx(4 / 6) and got["wordless"] == pytest.approx(1 / 6)
    assert got["repeated_pairs"] == pytest.approx(1 / 5) and got["longest_word"] == 4
    assert boosting.statistics(None) == boosting.statistics(" \n") == [0.0] * len(boosting.STATISTICS)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_held_out_accuracy(spark, sf):
    sf = f"/root/testdata/{sf}"
    rows = queries.op11_quality_boost(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    y = np.array([labels[r.doc_id] for r in held])
    assert auc(y, np.array([r.score for r in held])) > 0.98
    hit = np.array([r.predicted for r in held])
    assert (hit[y == 1] == 1).mean() > 0.98 and (hit[y == 0] == 0).mean() > 0.9


def test_held_out_labels_are_not_read(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    folder = awkward.table(spark, tmp_path, "documents", docs)
    turned = labels.withColumn(
        "quality", boosting.F.when(queries._fold(4) == 2, 1 - boosting.F.col("quality")).otherwise(boosting.F.col("quality"))
    )
    awkward.table(spark, tmp_path, "labels", turned)
    got = queries.op11_quality_boost(spark, folder).collect()
    awkward.same_rows(got, queries.op11_quality_boost(spark, "/root/testdata/sf0.001").collect())


def test_missing_labels_and_awkward_documents(spark):
    docs = awkward.documents(spark)
    schema = "doc_id long, quality int, toxic int"
    none = spark.createDataFrame([(None, 1, 0), (3, None, 0), (4, 7, 0)], schema)
    for labels, want in ((none, 0.5), (spark.createDataFrame([(7, 1, 0), (8, 1, 0)], schema), 1.0)):
        assert boosting.fit(docs, labels) == want
        got = boosting.score(docs, want, "doc_id", "score", "c0")
        assert {r[-1] for r in got.collect()} == {want} and got.count() == docs.count()
    both = spark.createDataFrame([(i, int(i > 6), 0) for i in range(22)] + [(7, 0, 0)], schema)
    forest = boosting.fit(docs, both)
    assert boosting.score(docs, forest, "doc_id").count() == docs.count()
    assert boosting.score(docs.filter("false"), forest, "doc_id").count() == 0


def test_a_repeated_id_does_not_unbound_the_sample(spark):
    docs = awkward.documents(spark, [(i % 4, f"text number {i} of some words") for i in range(400)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(4)], "doc_id long, quality int, toxic int")
    seen = []
    grow = boosting.grow
    try:
        boosting.grow = lambda x, *a, **k: seen.append(len(x)) or grow(x, *a, **k)
        boosting.fit(docs, labels, max_rows=40)
    finally:
        boosting.grow = grow
    assert seen == [40]

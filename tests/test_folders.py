from collections import Counter

import pytest
from pyspark.errors import PySparkException

import tablemirror as tm
from tablemirror.errors import SchemaError


def plain(rows):
    out = Counter()
    for path, change in rows:
        if path is None:
            out[None, change] += 1
            continue
        steps = path.split("/")[:-1]
        for n in range(len(steps) + 1):
            out["".join(s + "/" for s in steps[:n]), change] += 1
    return dict(out)


ROWS = [
    ("top", "added"), ("a/b", "added"), ("a/b/c", "deleted"), ("a/b/d", "added"), ("a//x", "added"),
    ("/rooted", "deleted"), ("", "added"), (None, "added"), (None, None), ("a/b", None), ("only/folders/here/f", "added"),
    ("日本/ü/f", "modified"), ("./f", "added"), ("a/", "added"), ("a/b", "added"),
]


def summed(df):
    rows = df.collect()
    out = {(r.folder, r.change): r.n for r in rows}
    assert len(out) == len(rows)
    return out


def test_every_folder_counts_what_lies_below(spark):
    df = spark.createDataFrame(ROWS, "path string, change string")
    assert summed(tm.folder_summary(df)) == plain(ROWS)
    assert summed(tm.folder_summary(df, depth=50)) == plain(ROWS)


def test_one_very_deep_path_among_shallow_ones(spark):
    rows = [(f"a/{i}", "added") for i in range(50)]
    rows += [("/".join(map(str, range(n))), "deleted") for n in (1, 2, 41, 70, 130)]
    df = spark.createDataFrame(rows, "path string, change string")
    got = tm.folder_summary(df)
    assert summed(got) == plain(rows)
    # counting, then a step for each doubling of the depth (129 folders)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 + 8


def test_a_folder_summary_of_nothing(spark):
    assert tm.folder_summary(spark.createDataFrame([], "path string, change string")).collect() == []


def test_a_path_deeper_than_said_is_an_error(spark):
    df = spark.createDataFrame([("a/b/c/d", "added")], "path string, change string")
    with pytest.raises(PySparkException, match="deeper than 2"):
        tm.folder_summary(df, depth=2).collect()


def test_refused_columns(spark):
    df = spark.createDataFrame([("a", "b", 1)], "path string, folder string, n int")
    for by in ("folder", "n", "absent"):
        with pytest.raises(SchemaError):
            tm.folder_summary(df, by=by)
    assert summed(tm.folder_summary(df.withColumnRenamed("folder", "change"))) == {("", "b"): 1}

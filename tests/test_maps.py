import pytest
from pyspark.sql import functions as F

import tablemirror as tm
from tablemirror.errors import SchemaError

SCHEMA = "k int, m map<string,string>, deep map<int,struct<x:double,more:map<string,array<string>>>>"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def entries(*pairs):
    return dict(pairs)


ONE = [
    (1, entries(("a", "1"), ("b", None)), {1: (0.0, {"x": ["p", None], "y": []})}),
    (2, {}, None), (3, None, {}), (4, {"a": "b"}, {2: None}), (5, {"a": 'x","b":"y'}, {3: (1.5, None)}),
]


def test_the_order_of_entries_is_no_change(spark):
    turned = [
        (1, entries(("b", None), ("a", "1")), {1: (-0.0, {"y": [], "x": ["p", None]})}), *ONE[1:],
    ]
    one = table(spark, ONE)
    other = table(spark, turned).withColumn(
        "m", F.when(F.col("m").isNotNull(), F.map_from_entries(F.reverse(F.map_entries("m"))))
    )
    assert tm.diff(other, one, "k").count() == 0
    assert tm.scope_digest(other).first() == tm.scope_digest(one).first()
    assert tm.make_patch(other, one, "k").count() == 0


def test_changes_within_maps(spark):
    rows = [
        (1, entries(("a", "1"), ("b", "")), ONE[0][2]),  # null and empty text
        (2, None, None),  # empty and null map
        (3, None, None),
        (4, {"a": "b", "c": "d"}, {2: None}),
        (5, entries(("a", "x"), ("b", "y")), {3: (1.5, None)}),  # text that looks like an entry
    ]
    changes = tm.diff(table(spark, rows), table(spark, ONE), "k", keep_unchanged=True)
    assert {r.change for r in changes.collect()} == {"modified"}
    deep = [(1, ONE[0][1], {1: (0.0, {"x": ["p", ""], "y": []})}), *ONE[1:]]
    assert [tuple(r) for r in tm.diff(table(spark, deep), table(spark, ONE), "k").collect()] == [(1, "modified")]


@pytest.mark.parametrize("how", [tm.publish, tm.publish_ranged])
def test_versions_with_maps(spark, tmp_path, how):
    store = str(tmp_path / "s")
    how(table(spark, ONE), store, "m", "ann", 0, keys="k")
    two = [(1, {"n": "w"}, None), *ONE[1:]]
    how(table(spark, two), store, "m", "ann", 1, keys="k")
    latest = tm.read_latest(spark, store)
    assert sorted(map(repr, latest.collect())) == sorted(map(repr, table(spark, two).collect()))
    assert tm.history(spark, store).filter("version = 2").first().n_modified == 1
    assert [tuple(r) for r in tm.diff_versions(spark, store, 1, 2, keys="k").collect()] == [(1, "modified")]


def test_by_value_maps_are_refused(spark):
    with pytest.raises(SchemaError):
        tm.diff(table(spark, ONE), table(spark, ONE), "k", digest=[])

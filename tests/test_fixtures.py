"""The counts in FIXTURES.md, at every scale."""

import pytest
from pyspark.sql import functions as F

import tablemirror as tm
from trees import RULES, document_trees

COMPARE = ["lang", "text"]
EXPECTED = {
    "0.001": {
        "rows": (163, 126),
        "diff": {"added": 60, "deleted": 23, "modified": 11, "unchanged": 92},
        "scope": 8,
        "upsert": 186,
        "mirror": 129,
        "plan": 134,
        "plan_diff": {"added": 15, "deleted": 7, "modified": 3, "unchanged": 116},
        "duplicates": 1161,
    },
    "0.01": {
        "rows": (814, 632),
        "diff": {"added": 300, "deleted": 118, "modified": 61, "unchanged": 453},
        "scope": 43,
        "upsert": 932,
        "mirror": 652,
        "plan": 679,
        "plan_diff": {"added": 84, "deleted": 37, "modified": 14, "unchanged": 581},
        "duplicates": 11785,
    },
    "0.1": {
        "rows": (8143, 6332),
        "diff": {"added": 3000, "deleted": 1189, "modified": 629, "unchanged": 4514},
        "scope": 428,
        "upsert": 9332,
        "mirror": 6522,
        "plan": 6807,
        "plan_diff": {"added": 856, "deleted": 381, "modified": 118, "unchanged": 5833},
        "duplicates": 118144,
    },
}


def counted(changes):
    return {r["change"]: r["n"] for r in tm.change_summary(changes).collect()}


@pytest.mark.parametrize("sf", EXPECTED)
def test_document_trees(spark, sf):
    want = EXPECTED[sf]
    src, tgt = document_trees(spark, sf)
    assert (src.count(), tgt.count()) == want["rows"]
    for digest in ((), ("text",)):
        changes = tm.diff(src, tgt, "path", COMPARE, keep_unchanged=True, digest=digest)
        assert counted(changes) == want["diff"]
    assert tm.in_scope(src, "src1/").count() == want["scope"]
    assert tm.upsert(src, tgt, "path").count() == want["upsert"]
    assert tm.mirror(src, tgt, ["src1/", "src8/", "src9/"]).count() == want["mirror"]
    result = tm.run_plan(src, tgt, "path", RULES)
    assert result.count() == want["plan"]
    assert counted(tm.diff(result, tgt, "path", COMPARE, keep_unchanged=True)) == want["plan_diff"]
    named = ("src1/1", "src2/2", "src3/3", "src7/7", "src14/14")
    names = spark.createDataFrame([(p,) for p in named], "path string")
    missing = {r["path"] for r in tm.missing_required(src, names).collect()}
    assert missing == {"src7/7", "src14/14"}
    present = spark.createDataFrame([(f"src{i}/{i}",) for i in range(1, 6)], "path string")
    assert tm.select_required(src, present).count() == 5
    lines = spark.read.parquet(f"/root/testdata/sf{sf}/lineitem.parquet")
    assert tm.duplicate_keys(lines, ["l_orderkey", "l_linenumber"]).count() == want["duplicates"]


def test_counts_by_scope(spark):
    src, tgt = document_trees(spark, "0.01")
    changes = tm.diff(src, tgt, "path", COMPARE, keep_unchanged=True)
    rows = tm.change_summary(changes, by=tm.scope_of().alias("scope")).collect()
    got = {(r["scope"], r["change"]): r["n"] for r in rows}

    def scope(name):
        kinds = ("added", "deleted", "modified", "unchanged")
        return tuple(got.get((name, k), 0) for k in kinds)

    assert scope("src1") == (14, 4, 5, 24)
    assert scope("src2") == (13, 4, 4, 26)
    assert scope("src3") == (14, 4, 5, 24)
    assert scope("src8") == (43, 0, 0, 0)
    assert scope("src9") == (0, 33, 0, 0)


def test_orders(spark):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    raised = F.when(F.col("o_orderkey") % 11 == 0, F.col("o_totalprice") + 1)
    src = orders.filter("o_orderkey % 7 <> 0").withColumn(
        "o_totalprice", raised.otherwise(F.col("o_totalprice"))
    )
    tgt = orders.filter("o_orderkey % 5 <> 0")
    changes = tm.diff(
        src, tgt, "o_orderkey", ["o_orderstatus", "o_totalprice"], keep_unchanged=True
    )
    assert counted(changes) == {
        "added": 2571, "deleted": 1714, "modified": 935, "unchanged": 9351
    }

"""Equality and digests of awkward values."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

import tablemirror as tm
from tablemirror.errors import MissingKeysError, SchemaError
from tablemirror.operators.keys import BROADCAST_SETTING
from trees import changes_of


def pair(spark, dtype, left, right):
    return (spark.createDataFrame([("p", v)], f"path string, v {dtype}") for v in (left, right))


@pytest.mark.parametrize(
    ("dtype", "left", "right", "same"),
    [
        ("double", 0.0, -0.0, True),
        ("double", math.nan, math.nan, True),
        ("double", 1.0, None, False),
        ("string", None, None, True),
        ("string", "", None, False),
        ("string", "a", "a ", False),
        ("string", "é", "é", False),
        ("binary", b"", None, False),
        ("binary", b"\x00", b"\x00\x00", False),
        ("binary", b"\xff", b"\xff", True),
        ("array<float>", [1.0, 2.0], [2.0, 1.0], False),
        ("array<float>", [1.0, None], [1.0, None], True),
        ("struct<a:int,b:string>", (1, None), (1, None), True),
        ("struct<a:int,b:string>", (1, None), (1, ""), False),
    ],
)
def test_content_equality(spark, dtype, left, right, same):
    s, t = pair(spark, dtype, left, right)
    assert changes_of(tm.diff(s, t, "path", keep_unchanged=True)) == {
        "p": "unchanged" if same else "modified"
    }


@pytest.mark.parametrize("value", ["", "x", "日本", None])
def test_one_column_digest(spark, value):
    df = spark.createDataFrame([("p", value)], "path string, v string")
    want = None if value is None else hashlib.sha256(value.encode()).hexdigest()
    assert tm.row_digest(df, "v").first()["digest"] == want
    bytes_too = df.withColumn("v", F.col("v").cast("binary"))
    assert tm.row_digest(bytes_too, "v").first()["digest"] == want


def test_several_columns_do_not_run_together(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a", None), (None, "a"), ("", None), (None, None), ("-", "-")]
    df = spark.createDataFrame(rows, "x string, y string")
    digests = [r["digest"] for r in tm.row_digest(df, ["x", "y"]).collect()]
    assert None not in digests
    assert len(set(digests)) == len(rows)


@pytest.mark.parametrize(
    ("dtype", "left", "right"),
    [("double", 0.0, -0.0), ("float", 0.0, -0.0), ("double", math.nan, -math.nan)],
)
def test_equal_numbers_share_a_digest(spark, dtype, left, right):
    df = spark.createDataFrame([(left,), (right,)], f"v {dtype}")
    assert tm.row_digest(df, "v").select("digest").distinct().count() == 1


def test_repeated_hour_has_two_digests(spark):
    df = spark.sql(
        "select timestamp_seconds(v) as v from values (1761438600), (1761442200) t(v)"
    )  # 02:30 twice in Berlin, 26 October 2025
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert tm.row_digest(df, "v").select("digest").distinct().count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_other_simple_types_have_a_digest(spark):
    df = spark.sql(
        "select 1 as i, true as b, date'2024-02-29' as d, 1.50bd as n, "
        "timestamp_ntz'2024-01-01 00:00:00' as t"
    )
    assert tm.row_digest(df, df.columns).first()["digest"]


def test_no_digest_of_nested_columns(spark):
    df = spark.sql("select array('x') as v")
    with pytest.raises(SchemaError):
        tm.row_digest(df, "v")
    with pytest.raises(SchemaError):
        tm.row_digest(df, [])


def test_two_key_columns(spark):
    schema = "a int, b string, v string"
    s = spark.createDataFrame([(1, "x", "1"), (1, "y", "2"), (2, "x", "3")], schema)
    t = spark.createDataFrame([(1, "x", "1"), (1, "y", "9"), (3, "x", "3")], schema)
    got = {(r["a"], r["b"]): r["change"] for r in tm.diff(s, t, ["a", "b"]).collect()}
    assert got == {(1, "y"): "modified", (2, "x"): "added", (3, "x"): "deleted"}


def test_tables_of_keys_only(spark):
    s = spark.createDataFrame([(1,), (2,)], "id int")
    t = spark.createDataFrame([(2,), (3,)], "id int")
    got = {r["id"]: r["change"] for r in tm.diff(s, t, "id", keep_unchanged=True).collect()}
    assert got == {1: "added", 2: "unchanged", 3: "deleted"}


def test_a_column_that_looks_like_a_digest_is_content(spark):
    schema = "path string, text string, text__sha256 binary"
    s = spark.createDataFrame([("p", "x", b"1")], schema)
    t = spark.createDataFrame([("p", "x", b"2")], schema)
    assert changes_of(tm.diff(s, t, "path")) == {"p": "modified"}
    assert changes_of(tm.diff(s, t, "path", compare=["text"])) == {}


def test_summary_by_columns(spark):
    changes = spark.createDataFrame(
        [("a/1", "added"), ("a/2", "added"), ("b/1", "deleted")], "path string, change string"
    )
    by_scope = tm.change_summary(changes, by=tm.scope_of().alias("scope"))
    assert sorted(map(tuple, by_scope.collect())) == [("a", "added", 2), ("b", "deleted", 1)]
    assert tm.change_summary(changes, by="path").count() == 3
    assert tm.change_summary(changes).columns == ["change", "n"]


def test_key_columns_with_common_names(spark):
    keys = ["n", "side", "rows", "bad", "width", "hit"]
    s = spark.range(3).select(*[F.col("id").alias(k) for k in keys], F.lit("v").alias("s_0"))
    t = s.filter("n > 0").withColumn("s_0", F.concat("s_0", F.col("n").cast("string")))
    got = {r["n"]: r["change"] for r in tm.diff(s, t, keys).collect()}
    assert got == {0: "added", 1: "modified", 2: "modified"}
    spark.conf.set(BROADCAST_SETTING, "-1")
    try:
        assert tm.upsert(s, t, keys).count() == 3
    finally:
        spark.conf.unset(BROADCAST_SETTING)
    with pytest.raises(SchemaError):
        tm.diff(s.withColumnRenamed("n", "change"), t.withColumnRenamed("n", "change"), "change")


def test_required_rows_by_two_columns(spark):
    talks = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    opening = talks.filter("turn = 0").select("turn", "conv_id")
    assert tm.select_required(talks, opening).count() == opening.count()
    later = opening.withColumn("turn", F.lit(999).cast("bigint"))
    assert tm.missing_required(talks, later).count() == opening.count()
    with pytest.raises(MissingKeysError):
        tm.select_required(talks, later)


def test_an_empty_required_list_selects_nothing(spark):
    df = spark.createDataFrame([("p", "v")], "path string, v string")
    assert tm.select_required(df, df.select("path").limit(0)).count() == 0

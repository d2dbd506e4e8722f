import pytest
from pyspark.sql import functions as F

import tablemirror as tm
from tablemirror.errors import SchemaError
from tablemirror.operators import keys as key_checks


def some(spark, ids, schema="k string, t string"):
    return spark.createDataFrame([(None if i is None else f"k{i}", f"text {i}") for i in ids], schema)


def names(df):
    return sorted(df.toPandas()["k"].fillna("-"))


@pytest.fixture
def limit(spark):
    def put(n):
        spark.conf.set(key_checks.BROADCAST_SETTING, str(n))

    yield put
    spark.conf.unset(key_checks.BROADCAST_SETTING)


@pytest.mark.parametrize("words", [None, 1, 3, 5000])
def test_any_size_of_filter_gives_the_same_rows(spark, words):
    df = some(spark, [*range(300), 7, None, None])
    gone = some(spark, [*range(0, 900, 3), 9, None])
    got = names(tm.without_keys(df, gone, "k", words=words))
    assert got == sorted([f"k{i}" for i in [*range(300), 7] if i % 3] + ["-", "-"])


def test_two_key_columns_and_nulls(spark):
    schema = "a long, b date, k string"
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("b").cast("int")).alias("b")
    rows = [(1, 1, "x"), (1, 2, "y"), (None, 1, "z"), (2, None, "u")]
    df = spark.createDataFrame(rows, "a long, b long, k string").select("a", day, "k")
    assert df.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    assert names(tm.without_keys(df, df.filter("k in ('x', 'z')"), ["a", "b"])) == ["u", "y", "z"]


def test_nothing_on_either_side(spark):
    df, none = some(spark, range(5)), some(spark, [])
    assert names(tm.without_keys(df, none, "k")) == names(df)
    assert names(tm.without_keys(none, df, "k")) == []


def test_few_rows_are_shuffled(spark):
    df, gone = some(spark, range(20_000)), some(spark, range(19_900, 30_000))
    possible, absent = tm.key_filter(gone, "k").split(df)
    assert possible.count() + absent.count() == 20_000
    assert possible.join(gone, "k", "left_semi").count() == 100
    assert absent.join(gone, "k", "left_semi").count() == 0
    assert possible.count() < 100 + 20_000 * 0.06


def test_no_filter_where_it_does_not_fit_or_values_may_differ_in_bits(spark, limit):
    df = some(spark, range(600))
    floats = df.select(F.length("k").cast("double").alias("k"), "t")
    assert tm.key_filter(floats, "k") is None
    assert tm.without_keys(floats, floats, "k").count() == 0
    limit(3199)
    assert tm.key_filter(df, "k") is None
    assert names(tm.without_keys(df, some(spark, range(599)), "k")) == ["k599"]
    limit(3200)
    assert tm.key_filter(df, "k").n_words == 100


def test_types_of_keys_must_be_equal(spark):
    df = some(spark, range(3))
    with pytest.raises(SchemaError):
        tm.without_keys(df, df.select(F.lit(1).alias("k")), "k")


def test_upsert_keeps_most_rows_out_of_the_shuffle(spark, limit):
    target, source = some(spark, range(6000)), some(spark, range(5000, 7000))
    limit(25_000)  # too little for the keys that are dropped or kept, enough for their bits
    df = tm.upsert(source, target, "k", validate=False)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan and "LeftAnti" in plan
    assert names(df) == sorted(f"k{i}" for i in range(7000))

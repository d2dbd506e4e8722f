import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

import tablemirror as tm
from tablemirror.errors import EmptySourceError, KeyCheckError, RuleError, SchemaError
from trees import snapshot


@pytest.fixture(scope="module")
def tree(spark):
    return snapshot(spark, {"a/1": "x", "a/2": "y", "b/1": "z"})


@pytest.fixture(scope="module")
def repeated(tree):
    return tree.unionByName(tree.filter("path = 'a/1'"))


@pytest.fixture(scope="module")
def nameless(spark):
    return spark.createDataFrame([("a/1", "x"), (None, "y")], "path string, text string")


def test_unique_keys_pass(tree):
    assert tm.check_keys(tree, "path") is None


def test_an_empty_table_passes(tree):
    tm.check_keys(tree.limit(0), "path")
    assert tm.diff(tree.limit(0), tree.limit(0), "path").count() == 0


def test_duplicate_key(tree, repeated):
    with pytest.raises(KeyCheckError, match="duplicate key.*a/1.*2 rows"):
        tm.check_keys(repeated, "path")
    for sides in ((tree, repeated), (repeated, tree)):
        with pytest.raises(KeyCheckError, match="duplicate"):
            tm.diff(*sides, "path")
        with pytest.raises(KeyCheckError, match="duplicate"):
            tm.upsert(*sides, "path")
        with pytest.raises(KeyCheckError, match="duplicate"):
            tm.run_plan(*sides, "path", [(1, "a/", "mirror")])
        with pytest.raises(KeyCheckError, match="duplicate"):
            tm.mirror(*sides, "b/")
    assert tm.mirror(tree, repeated, "b/", validate=False).count() == 4
    with pytest.raises(KeyCheckError, match="source"):
        tm.diff(repeated, tree, "path", validate="source")
    assert tm.diff(tree, repeated, "path", validate="source").count() == 0


def test_keys_checked_inline_fail_the_job(tree, repeated, nameless):
    for sides, fault in (
        ((tree, repeated), 'target: duplicate key.*"a/1"'),
        ((repeated, tree), 'source: duplicate key.*"a/1"'),
        ((repeated, tree.limit(0)), "source: duplicate key"),
        ((tree.filter("length(path) > 9"), repeated), "target: duplicate key"),
        ((tree, nameless), 'target: null key.*"path":null'),
    ):
        changes = tm.diff(*sides, "path", validate="inline")  # nothing runs yet
        every = tm.diff(*sides, "path", keep_unchanged=True, validate="inline")
        for read in (
            lambda: changes.collect(),
            lambda: tm.change_summary(changes).collect(),
            lambda: every.count(),
            lambda: every.select("path").collect(),
            lambda: every.agg(F.count("*")).collect(),
        ):
            with pytest.raises(SparkRuntimeException, match=fault):
                read()
    with pytest.raises(KeyCheckError, match="validate"):
        tm.upsert(tree, tree, "path", validate="inline")


def test_a_line_item_is_not_keyed_by_order_and_line(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    with pytest.raises(KeyCheckError, match="duplicate"):
        tm.check_keys(lines, ["l_orderkey", "l_linenumber"])


def test_a_key_that_holds_a_third_of_the_rows(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") < 10_000, "hot").otherwise(F.col("id").cast("string")).alias("path")
    )
    with pytest.raises(KeyCheckError, match="hot.*10000 rows"):
        tm.diff(rows, rows, "path")
    assert [tuple(r) for r in tm.duplicate_keys(rows, "path").collect()] == [("hot", 10_000)]


def test_null_key(tree, nameless):
    with pytest.raises(KeyCheckError, match="null key"):
        tm.check_keys(nameless, "path")
    assert tm.null_keys(nameless, "path").count() == 1
    with pytest.raises(KeyCheckError, match="null key"):
        tm.diff(tree, nameless, "path")


def test_null_in_one_of_two_key_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 2, "y")], "a int, b int, text string")
    with pytest.raises(KeyCheckError, match="null key"):
        tm.check_keys(df, ["a", "b"])


def test_a_row_with_a_null_path_is_not_lost_by_a_mirror(tree, nameless):
    assert tm.mirror(tree, nameless, "a/", validate="source").filter("path is null").count() == 1
    assert tm.out_of_scope(nameless, "a/").count() == 1


def test_unknown_validate_value(tree):
    with pytest.raises(KeyCheckError):
        tm.diff(tree, tree, "path", validate="target")


def test_no_key_columns(tree):
    with pytest.raises(KeyCheckError):
        tm.check_keys(tree, [])
    with pytest.raises(SchemaError):
        tm.check_keys(tree, "nope")


@pytest.mark.parametrize("nest", ["map(path, text)", "array(map(path, text))", "struct(map(1, 2))"])
def test_map_payload(tree, nest):
    df = tree.withColumn("extra", F.expr(nest))
    with pytest.raises(SchemaError, match="extra"):
        tm.diff(df, df, "path", digest=[])  # by value
    assert tm.diff(df, df, "path").count() == 0
    assert tm.diff(df, df, "path", compare=["text"]).count() == 0
    assert tm.row_digest(df, ["extra", "path"]).select("digest").distinct().count() == df.count()


def test_map_as_sorted_entries(tree):
    df = tree.withColumn("extra", F.sort_array(F.map_entries(F.create_map("path", "text"))))
    assert tm.diff(df, df, "path").count() == 0


@pytest.mark.parametrize("operator", ["diff", "upsert", "run_plan", "mirror"])
def test_schema_mismatch(tree, operator):
    def call(source, target):
        if operator == "mirror":
            return tm.mirror(source, target, "a/")
        if operator == "run_plan":
            return tm.run_plan(source, target, "path", [(1, "a/", "mirror")])
        return getattr(tm, operator)(source, target, "path")

    for other in (
        tree.withColumn("more", F.lit(1)),
        tree.withColumn("text", F.length("text")),
        tree.withColumnRenamed("text", "Text"),
    ):
        with pytest.raises(SchemaError, match="schemas differ"):
            call(tree, other)
    call(tree, tree.select("text", "path"))  # order is free


@pytest.mark.parametrize(
    "rules",
    [
        [(1, "a", "mirror")],
        [(1, "", "mirror")],
        [(1, "a/", "mirror"), (2, "a/b/", "upsert")],
        [(1, "a/", "mirror"), (2, "b/", "upsert"), (3, "a/", "upsert")],
        [(1, "a/", "copy")],
        [(1, "a/", "mirror"), (1, "b/", "mirror")],
    ],
)
def test_bad_rules(tree, rules):
    with pytest.raises(RuleError):
        tm.run_plan(tree, tree, "path", rules)


def test_prefix_without_slash(tree):
    for call in (tm.in_scope, tm.out_of_scope):
        with pytest.raises(RuleError, match="slash"):
            call(tree, "a")
        with pytest.raises(RuleError):
            call(tree, [])
    with pytest.raises(RuleError, match="slash"):
        tm.mirror(tree, tree, "a")


def test_scope_column_outside_the_key(spark):
    df = spark.createDataFrame([(1, "a/1")], "id int, path string")
    with pytest.raises(RuleError, match="key column"):
        tm.run_plan(df, df, "id", [(1, "a/", "mirror")])
    with pytest.raises(RuleError, match="key column"):
        tm.mirror(df, df, "a/", keys="id")
    with pytest.raises(SchemaError, match="string"):
        tm.in_scope(df, "a/", column="id")


def test_rules_from_a_table(spark):
    table = spark.createDataFrame(
        [(2, "b/", "upsert"), (1, "a/", "mirror")], "seq int, prefix string, mode string"
    )
    assert tm.load_rules(table) == [tm.Rule(1, "a/", "mirror"), tm.Rule(2, "b/", "upsert")]


def test_empty_source_scope(spark, tree):
    target = snapshot(spark, {"c/1": "x", "b/1": "y"})
    assert tm.mirror(tree, target, "c/").count() == 1
    with pytest.raises(EmptySourceError, match="c/"):
        tm.mirror(tree, target, ["a/", "c/"], allow_empty_source=False)
    with pytest.raises(EmptySourceError, match="c/"):
        tm.run_plan(tree, target, "path", [(1, "c/", "mirror")], allow_empty_source=False)
    with pytest.raises(EmptySourceError, match="c/"):
        tm.mirror(tree.limit(0), target, "c/", allow_empty_source=False)


def test_required_list_of_another_shape(spark, tree):
    other = spark.createDataFrame([("a/1", 1)], "path string, more int")
    with pytest.raises(RuleError, match="key columns"):
        tm.run_plan(tree, tree, "path", [], required=other)
    with pytest.raises(SchemaError):
        tm.select_required(tree, spark.createDataFrame([(1,)], "path int"))


def test_missing_required_stops_the_plan(spark, tree):
    names = spark.createDataFrame([("a/1",), ("a/9",)], "path string")
    with pytest.raises(tm.errors.MissingKeysError, match="a/9"):
        tm.run_plan(tree, tree, "path", [], required=names)


def test_keys_are_not_content(tree):
    with pytest.raises(SchemaError):
        tm.diff(tree, tree, "path", compare=["path"])
    with pytest.raises(SchemaError):
        tm.diff(tree, tree, "path", digest=["path"])


@pytest.mark.parametrize("count", [400, 5000])
def test_long_lists_of_rules(spark, count):
    """Prefixes of several lengths, look-alikes among them."""
    prefixes = [f"d{i}/" for i in range(count)]
    source = spark.range(0, count, 7).select(F.format_string("d%d/s", "id").alias("path"), F.lit("s").alias("text"))
    target = spark.createDataFrame([("d7/t", "t"), ("d70/t", "t"), ("d9999999/t", "t"), ("top", "t")], "path string, text string")
    expected = {r.path for r in source.collect()} | {"d9999999/t", "top"}
    rules = [(i, p, "mirror") for i, p in enumerate(prefixes)]
    assert {r.path for r in tm.run_plan(source, target, "path", rules).collect()} == expected
    assert {r.path for r in tm.mirror(source, target, prefixes).collect()} == expected
    assert {r.path for r in tm.in_scope(target, prefixes).collect()} == {"d7/t", "d70/t"}
    assert {r.path for r in tm.out_of_scope(target, prefixes).collect()} == {"d9999999/t", "top"}
    with pytest.raises(EmptySourceError, match="d1/"):
        tm.mirror(source, target, prefixes, allow_empty_source=False)


def test_columns_named_n_or_with_a_dot(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y")], "n int, text string")
    with pytest.raises(SchemaError, match="named n"):
        tm.duplicate_keys(df, "n")
    with pytest.raises(KeyCheckError, match="duplicate"):
        tm.check_keys(df, "n")
    changes = tm.diff(df.limit(1), df.limit(0), "n")
    with pytest.raises(SchemaError, match="named n"):
        tm.change_summary(changes, by="n")
    dotted = df.withColumnRenamed("text", "v.w")
    with pytest.raises(SchemaError, match="dot"):
        tm.diff(dotted, dotted, "n")


def test_scopes_inside_each_other_and_at_the_top(spark):
    paths = ["a/b/c", "a/x", "ab/y", "index.txt", None]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    scope = tm.scope_of(prefixes=["a/", "a/b/"])
    assert [r[0] for r in df.select(scope).collect()] == ["a/b", "a", "ab", ".", None]
    assert [r[0] for r in df.select(tm.scope_of()).collect()] == ["a", "a", "ab", ".", None]


def test_digests_of_arrays_follow_their_values(spark):
    df = spark.createDataFrame(
        [(0, [0.0, 1.5]), (1, [-0.0, 1.5]), (2, [float("nan")]), (3, []), (4, None), (5, [None])],
        "id int, v array<double>",
    )
    digest = {r.id: r.digest for r in tm.row_digest(df, "v").collect()}
    assert digest[0] == digest[1]
    assert digest[4] is None
    assert len({digest[i] for i in (0, 2, 3, 4, 5)}) == 5
    moved = df.withColumn("v", F.when(F.col("id") == 3, None).otherwise(F.col("v")))
    assert [r.id for r in tm.diff(df, moved, "id").collect()] == [3]
    assert tm.diff(df, df.withColumn("v", F.transform("v", lambda x: -(-x))), "id").count() == 0

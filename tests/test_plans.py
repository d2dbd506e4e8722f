"""The physical plans that the operators are meant to get."""

import re

import pytest

import __spark_entry__ as entry_points
import tablemirror as tm
from tablemirror.operators import keys as keys_module

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def tree(df) -> str:
    """The operator tree, without the details below it."""
    return plan(df).split("\n\n")[0]


def read_schemas(df) -> list[str]:
    return re.findall(r"ReadSchema: (.*)", plan(df))


def pushed(df) -> str:
    return "\n".join(re.findall(r"PushedFilters: (.*)", plan(df)))


@pytest.fixture(scope="module")
def snapshots(spark, tmp_path_factory):
    """The two trees as Parquet tables."""
    base = tmp_path_factory.mktemp("snapshots")
    for name, df in zip("st", entry_points._trees(spark, SF)):
        df.write.parquet(f"{base}/{name}")
    return tuple(spark.read.parquet(f"{base}/{name}") for name in "st")


@pytest.fixture
def many_keys(spark):
    """As if no key set could be broadcast."""
    spark.conf.set(keys_module.BROADCAST_SETTING, "-1")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.unset(keys_module.BROADCAST_SETTING)


@pytest.fixture
def room_for_some(many_keys, spark):
    """Room for some sixty keys, no more."""
    spark.conf.set(keys_module.BROADCAST_SETTING, "3000")


def test_mirror_has_no_shuffle_and_pushes_its_prefixes(snapshots):
    df = tm.mirror(*snapshots, ["src1/", "inbox/"])
    assert "Exchange" not in tree(df)
    assert "Join" not in tree(df)
    filters = pushed(df)
    assert "Not(StringStartsWith(path,src1/))" in filters
    assert "Or(StringStartsWith(path,src1/),StringStartsWith(path,inbox/))" in filters


def test_scope_filter_is_pushed(snapshots):
    assert "StringStartsWith(path,src1/)" in pushed(tm.in_scope(snapshots[0], "src1/"))


def test_a_short_required_list_is_pushed(spark, snapshots):
    names = snapshots[0].limit(5).select("path")
    df = tm.select_required(snapshots[0], names)
    assert "In(path" in pushed(df)
    assert "Join" not in tree(df)


def test_a_longer_required_list_is_broadcast(snapshots):
    df = tm.select_required(snapshots[0], snapshots[0].limit(50).select("path"))
    assert "BroadcastHashJoin LeftSemi" in tree(df)
    assert "SortMergeJoin" not in tree(df)


def test_missing_required_leaves_the_source_in_place(snapshots):
    df = tm.missing_required(snapshots[0], snapshots[1].limit(50).select("path"))
    assert "SortMergeJoin" not in tree(df)
    assert all("text" not in s for s in read_schemas(df))


def test_upsert_of_few_keys_reads_the_target_in_place(snapshots):
    df = tm.upsert(*snapshots, "path")
    assert "BroadcastHashJoin LeftAnti" in tree(df)
    assert "SortMergeJoin" not in tree(df)
    assert tree(df).count("Exchange") == 1  # the broadcast itself
    assert "struct<path:string>" in read_schemas(df)


def test_upsert_of_many_keys_shuffles(snapshots, many_keys):
    assert "SortMergeJoin LeftAnti" in tree(tm.upsert(*snapshots, "path"))


def test_upsert_that_hits_few_rows_reads_the_target_in_place(snapshots, room_for_some):
    source, target = snapshots
    fresh = source.filter("path like 'quarantine/%' or path like 'src1/%'")
    target = target.filter("path not like 'src1/%' or lang = 'de'")
    df = tm.upsert(fresh, target, "path")
    assert "BroadcastHashJoin LeftAnti" in tree(df)
    assert_text_is_not_shuffled(df)


def test_upsert_that_keeps_few_rows_reads_the_target_in_place(snapshots, room_for_some):
    source, target = snapshots
    df = tm.upsert(source, target.filter("path not like 'inbox/%'"), "path")
    assert "BroadcastHashJoin LeftSemi" in tree(df)
    assert_text_is_not_shuffled(df)


def test_upsert_of_many_keys_into_narrow_rows_is_a_plain_join(spark, many_keys):
    orders = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderdate")
    df = tm.upsert(orders, orders, "o_orderkey", validate=False)
    assert tree(df).count("SortMergeJoin LeftAnti") == 1
    assert tree(df).count("Exchange") == 2


def assert_text_is_not_shuffled(df):
    exchanges = [b for b in plan(df).split("\n\n") if ") Exchange" in b.split("\n")[0]]
    assert exchanges
    assert not any("text" in b for b in exchanges)


def test_plan_of_few_keys_has_no_shuffle(snapshots):
    df = tm.run_plan(*snapshots, "path", entry_points.RULES)
    assert "Exchange hashpartitioning" not in plan(df)
    assert "SortMergeJoin" not in tree(df)
    assert tree(df).count("Scan parquet") == 3  # target, incoming keys, incoming rows


def test_plan_of_mirrors_only_has_no_join(snapshots, many_keys):
    rules = [r for r in entry_points.RULES if r.mode == "mirror"]
    assert "Exchange" not in tree(tm.run_plan(*snapshots, "path", rules))


def test_plan_of_many_keys_shuffles_only_the_upsert_scopes(snapshots, many_keys):
    df = tm.run_plan(*snapshots, "path", entry_points.RULES)
    text = plan(df)
    assert tree(df).count("SortMergeJoin") == 1
    shuffled = [block for block in text.split("\n\n") if "LeftAnti" in block]
    assert shuffled
    # Both inputs of the join are limited to the upsert prefixes where they are read.
    limited = re.findall(r"PushedFilters: \[.*StringStartsWith\(path,src2/\).*", text)
    assert len(limited) >= 3
    unions = tree(df).split("Union", 1)[1]
    assert unions.count("Exchange") == 2


def test_diff_shuffles_digests_instead_of_text(snapshots):
    df = tm.diff(*snapshots, "path", digest=["text"])
    assert "SortMergeJoin FullOuter" in tree(df)
    exchanges = [b for b in plan(df).split("\n\n") if ") Exchange" in b.split("\n")[0]]
    assert len(exchanges) == 2
    projects = [b for b in plan(df).split("\n\n") if "sha2(" in b]
    assert len(projects) == 2
    assert not any("text" in b for b in exchanges)


def test_keys_checked_inline_cost_no_shuffle_and_no_sort(snapshots):
    plain = tree(tm.diff(*snapshots, "path", digest=["text"], validate=False))
    inline = tree(tm.diff(*snapshots, "path", digest=["text"], validate="inline"))
    for step in ("Exchange", "Sort (", "Scan parquet"):
        assert inline.count(step) == plain.count(step)
    assert (plain.count("Window"), inline.count("Window")) == (0, 2)


def test_a_comparison_of_aggregates_reuses_their_shuffle(spark):
    df = entry_points.diff_orders_rebuilt(spark, SF)
    assert tree(df).count("Exchange") == 2


def test_summary_combines_before_its_shuffle(snapshots):
    df = tm.change_summary(tm.diff(*snapshots, "path"), by=tm.scope_of().alias("scope"))
    assert "partial_count" in plan(df)


def test_key_check_reads_the_key_columns_only(snapshots):
    report = keys_module._key_report(snapshots[0], "path", "source")
    assert read_schemas(report) == ["struct<path:string>"]
    assert "partial_count" in plan(report)


def test_tables_bucketed_alike_meet_without_a_shuffle(spark, snapshots):
    for name, df in zip("st", snapshots):
        df.write.mode("overwrite").bucketBy(4, "path").sortBy("path").saveAsTable(f"bucketed_{name}")
    s, t = (spark.table(f"bucketed_{name}") for name in "st")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = tm.diff(s, t, "path", digest=["text"], validate=False)
        assert "Exchange" not in tree(df)
        report = keys_module._key_report(s, "path", "source")
        assert "hashpartitioning" not in plan(report)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in "st":
            spark.sql(f"drop table bucketed_{name}")


def test_stored_digests_spare_the_text(spark, snapshots, tmp_path):
    store = str(tmp_path / "store")
    tm.publish(snapshots[1], store, "m", "a", 0, keys="path", digest=["text"])
    latest = tm.read_latest(spark, store, with_digests=True)
    df = tm.diff(snapshots[0], latest, "path", digest=["text"])
    assert "struct<path:string,lang:string,text__sha256:binary>" in read_schemas(df)


def test_clustered_versions_have_disjoint_files(spark, snapshots, tmp_path):
    import pyarrow.parquet as pq

    store = str(tmp_path / "store")
    tm.publish(snapshots[1], store, "m", "a", 0, keys="path", digest=["text"], cluster=True)
    ranges = []
    for file in (tmp_path / "store/snapshots").glob("1-*/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(0).statistics
            ranges.append((stats.min, stats.max))
    ranges.sort()
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


OVER_FILES = {"scan_files", "scan_content"}  # list and read files in Python, by design


@pytest.mark.parametrize("name", [q.__name__ for q in entry_points._QUERIES])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry_points.queries()[name](spark, SF))
    python = () if name in OVER_FILES else ("Python", "Pandas", "Arrow")
    for word in (*python, "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_a_long_list_of_prefixes_still_limits_the_scan(snapshots):
    prefixes = [f"src1{i:03}/" for i in range(400)]
    df = tm.in_scope(snapshots[0], prefixes)
    assert "GreaterThanOrEqual(path,src1000/)" in pushed(df)
    assert "LessThan(path,src13990)" in pushed(df)


def test_an_unchecked_required_list_bounds_its_broadcast(spark, snapshots):
    """A source that repeats the named key often must not get into the broadcast."""
    one = snapshots[0].limit(1).select("path")
    often = snapshots[0].join(one, "path").crossJoin(spark.range(2000)).drop("id")
    source = snapshots[0].unionByName(often)
    df = tm.run_plan(source, snapshots[1], "path", [(1, "src2/", "upsert")], required=one, validate=False)
    blocks = [b for b in plan(df).split("\n\n") if ") BroadcastExchange" in b.split("\n")[0]]
    assert blocks
    names = df.sparkSession.createDataFrame(one.collect(), one.schema)
    listed = names.join(source.select("path").distinct(), "path", "left_semi")
    assert listed.count() == 1  # what is broadcast for the list: its own rows


def test_a_plan_with_a_list_reads_the_source_once_for_its_payload(snapshots):
    names = snapshots[0].limit(50).select("path")
    df = tm.run_plan(*snapshots, "path", entry_points.RULES, required=names, validate=False)
    with_text = [s for s in read_schemas(df) if "text" in s]
    assert len(with_text) == 2  # the target and the source, once each


def test_vectors_are_compared_by_digest(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    df = tm.diff(vectors, vectors.withColumn("label", -vectors.label), "vec_id")
    exchanges = [b for b in plan(df).split("\n\n") if ") Exchange" in b.split("\n")[0]]
    assert exchanges
    assert not any("embedding#" in b for b in exchanges)

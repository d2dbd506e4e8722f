import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import SparkRuntimeException

import tablemirror as tm
from tablemirror.errors import KeyCheckError, PatchError, SchemaError
from tablemirror.operators.keys import BROADCAST_SETTING
from trees import as_dict, model_diff, snapshot

A = {"a/1": "x", "a/2": None, "b/1": "y", "b/2": "same"}
B = {"a/1": "x2", "a/2": "", "b/2": "same", "c/1": None}
C = {"a/1": "x", "a/2": "z", "b/1": "new", "b/2": None}

trees = st.dictionaries(
    st.sampled_from([f"{p}/{i}" for p in "ab" for i in range(4)]), st.one_of(st.none(), st.sampled_from(["", "x", "y"]))
)
few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def patch(spark, source, target):
    return tm.make_patch(snapshot(spark, source), snapshot(spark, target), "path")


def test_rows_of_a_patch(spark):
    rows = {r.path: r for r in patch(spark, B, A).collect()}
    assert {k: r.change for k, r in rows.items()} == {
        k: c for k, c in model_diff(B, A).items() if c != "unchanged"
    }
    assert rows["a/1"].row.text == "x2" and rows["c/1"].row.text is None
    assert rows["b/1"].row is None and rows["b/1"].after is None and rows["c/1"].before is None
    assert len(rows["a/1"].before) == len(rows["a/1"].after) == 16


@given(trees, trees)
@few
def test_apply_gives_the_source(spark, source, target):
    made = patch(spark, source, target)
    assert as_dict(tm.apply_patch(snapshot(spark, target), made)) == source


@given(trees, trees, trees)
@few
def test_composition(spark, one, two, three):
    both = tm.compose_patches(patch(spark, two, one), patch(spark, three, two))
    direct = {(r.path, r.change, r.before, r.after, r.row) for r in patch(spark, three, one).collect()}
    assert {(r.path, r.change, r.before, r.after, r.row) for r in both.collect()} == direct


def test_shuffled_where_keys_are_many(spark):
    made = patch(spark, B, A)
    spark.conf.set(BROADCAST_SETTING, "-1")
    try:
        assert as_dict(tm.apply_patch(snapshot(spark, A), made)) == B
        with pytest.raises(PatchError):
            tm.apply_patch(snapshot(spark, C), made)
    finally:
        spark.conf.unset(BROADCAST_SETTING)


@pytest.mark.parametrize(
    ("target", "state"),
    [({**A, "a/1": "other"}, "another row"), ({k: v for k, v in A.items() if k != "b/1"}, "absent"), ({**A, "c/1": "q"}, "already there")],
)
def test_a_patch_of_another_parent_is_refused(spark, target, state):
    with pytest.raises(PatchError, match=state):
        tm.apply_patch(snapshot(spark, target), patch(spark, B, A))
    # rows that the patch does not touch are free
    assert as_dict(tm.apply_patch(snapshot(spark, {**A, "z/9": "n"}), patch(spark, B, A))) == {**B, "z/9": "n"}


def test_patches_that_do_not_follow_each_other(spark):
    with pytest.raises(SparkRuntimeException, match="do not follow"):
        tm.compose_patches(patch(spark, B, A), patch(spark, B, A)).select("path").count()
        tm.compose_patches(patch(spark, B, A), patch(spark, B, A)).collect()


def test_a_repeated_key_in_a_patch_is_refused(spark):
    made = patch(spark, B, A)
    with pytest.raises(KeyCheckError):
        tm.apply_patch(snapshot(spark, A), made.union(made))


def test_other_columns_are_refused(spark):
    made = patch(spark, B, A)
    wider = snapshot(spark, A).selectExpr("*", "1 as n")
    with pytest.raises(SchemaError):
        tm.apply_patch(wider, made)
    with pytest.raises(SchemaError):
        tm.make_patch(wider, snapshot(spark, A), "path")
    with pytest.raises(SchemaError):
        tm.make_patch(wider.withColumnRenamed("n", "row"), wider.withColumnRenamed("n", "row"), ["path", "row"])


def test_tables_of_keys_alone(spark):
    one, two = (spark.createDataFrame([(k,) for k in ks], "k int") for ks in ([1, 2], [2, 3]))
    made = tm.make_patch(one, two, "k")
    assert sorted(tm.apply_patch(two, made).collect()) == [(1,), (2,)]


def test_only_changed_rows_shuffle_their_payload(spark):
    """Digests meet in the comparison; content joins the changed keys."""
    plan = patch(spark, B, A)._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" in plan
    inner = plan[plan.index("FullOuter"):]
    assert "row" not in inner.split("\n")[0]


def test_a_version_with_stored_digests(spark, tmp_path):
    store = str(tmp_path / "s")
    tm.publish(snapshot(spark, A), store, "m", "ann", 0, keys="path")
    held = tm.read_latest(spark, store, with_digests=True)
    made = tm.make_patch(snapshot(spark, B), held, "path")
    assert as_dict(tm.apply_patch(held, made)) == B

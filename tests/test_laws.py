"""Laws on generated snapshots, against the dict model."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import tablemirror as tm
from tablemirror.operators.keys import BROADCAST_SETTING
from trees import as_dict, changes_of, model_diff, model_plan, snapshot

SCOPES = ["a/", "a1/", "b/", "日志/", ""]
PATHS = st.builds(lambda s, n: f"{s}{n}", st.sampled_from(SCOPES), st.integers(0, 5))
TREE = st.dictionaries(PATHS, st.sampled_from([None, "", "x", "ß", "x "]), max_size=14)
MODES = st.sampled_from(["mirror", "upsert", None])
few = settings(
    max_examples=5,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


@pytest.fixture(params=["broadcast", "measure", "shuffle"])
def size(request, spark):
    """Every law holds on both sides of the broadcast bound, and close to it."""
    bound = {"broadcast": None, "measure": "180", "shuffle": "-1"}[request.param]
    if bound:
        spark.conf.set(BROADCAST_SETTING, bound)
    yield request.param
    spark.conf.unset(BROADCAST_SETTING)


@few
@given(source=TREE, target=TREE)
def test_diff(spark, source, target):
    s, t = snapshot(spark, source), snapshot(spark, target)
    forth = changes_of(tm.diff(s, t, "path", keep_unchanged=True))
    assert forth == model_diff(source, target)
    assert changes_of(tm.diff(s, t, "path", keep_unchanged=True, digest=["text"])) == forth
    assert changes_of(tm.diff(s, t, "path", keep_unchanged=True, validate="inline")) == forth
    assert changes_of(tm.diff(s, t, "path")) == {
        p: c for p, c in forth.items() if c != "unchanged"
    }
    swap = {"added": "deleted", "deleted": "added"}
    back = changes_of(tm.diff(t, s, "path", keep_unchanged=True))
    assert back == {p: swap.get(c, c) for p, c in forth.items()}
    assert changes_of(tm.diff(s, s, "path")) == {}


@few
@given(source=TREE, target=TREE)
def test_applying_the_diff_gives_the_source(spark, source, target):
    s, t = snapshot(spark, source), snapshot(spark, target)
    changes = tm.diff(s, t, "path")
    touched = changes.filter("change <> 'added'").select("path")
    fresh = s.join(changes.filter("change <> 'deleted'").select("path"), "path", "left_semi")
    assert as_dict(t.join(touched, "path", "left_anti").unionByName(fresh)) == source


@few
@given(source=TREE, target=TREE)
def test_upsert(spark, size, source, target):
    s, t = snapshot(spark, source), snapshot(spark, target)
    once = tm.upsert(s, t, "path")
    assert as_dict(once) == {**target, **source}
    assert as_dict(tm.upsert(s, once, "path")) == {**target, **source}


@few
@given(source=TREE, target=TREE)
def test_mirror(spark, source, target):
    s, t = snapshot(spark, source), snapshot(spark, target)
    want = model_plan(source, target, [(1, "a/", "mirror"), (2, "日志/", "mirror")])
    once = tm.mirror(s, t, ["a/", "日志/"])
    assert as_dict(once) == want
    assert as_dict(tm.mirror(s, once, ["a/", "日志/"])) == want


@few
@given(
    source=TREE,
    target=TREE,
    modes=st.tuples(MODES, MODES, MODES),
    validate=st.sampled_from([True, "source", False]),
    data=st.data(),
)
def test_run_plan(spark, size, source, target, modes, validate, data):
    rules = [(i, p, m) for i, (p, m) in enumerate(zip(["b/", "a/", "日志/"], modes)) if m]
    names = data.draw(st.lists(st.sampled_from(sorted(source)), max_size=4)) if source else []
    required = spark.createDataFrame([(n,) for n in names], "path string") if names else None
    s, t = snapshot(spark, source), snapshot(spark, target)
    want = model_plan(source, target, rules, names)
    assert as_dict(tm.run_plan(s, t, "path", rules, required, validate=validate)) == want
    again = tm.run_plan(s, snapshot(spark, want), "path", rules, required, validate=validate)
    assert as_dict(again) == want


def test_mirroring_every_scope_gives_the_source(spark):
    source = {f"{s}{i}": str(i) for s in ("a/", "b/") for i in range(9)}
    target = {f"{s}{i}": "old" for s in ("a/", "c/") for i in range(5, 12)}
    rules = [(i, p, "mirror") for i, p in enumerate(["a/", "b/", "c/"])]
    s, t = snapshot(spark, source), snapshot(spark, target)
    assert as_dict(tm.run_plan(s, t, "path", rules)) == source


@few
@given(source=TREE, names=st.lists(PATHS, min_size=1, max_size=14))
def test_required(spark, size, source, names):
    s = snapshot(spark, source)
    keys = spark.createDataFrame([(n,) for n in names], "path string")
    absent = sorted(set(names) - source.keys())
    missing = tm.missing_required(s, keys)
    assert sorted(r["path"] for r in missing.collect()) == absent
    if absent:
        with pytest.raises(tm.errors.MissingKeysError):
            tm.select_required(s, keys)
    else:
        assert as_dict(tm.select_required(s, keys)) == {n: source[n] for n in names}
    unchecked = tm.select_required(s, keys, validate=False)
    assert as_dict(unchecked) == {n: source[n] for n in names if n in source}

import random

import pytest
from pyspark.sql import functions as F

import tablemirror as tm
from tablemirror.errors import (
    EmptyMessageError,
    KeyCheckError,
    NothingChangedError,
    PatchError,
    PublishError,
    SchemaError,
    StaleParentError,
)
from tablemirror.operators import ranges
from tablemirror.operators.keys import BROADCAST_SETTING
from tablemirror.sources import ranged
from trees import as_dict, changes_of, model_diff, snapshot

ROWS = 8


@pytest.fixture
def store(tmp_path):
    return str(tmp_path / "store")


def put(df, store, parent, keys="path", **how):
    return tm.publish_ranged(df, store, "m", "ann", parent, keys=keys, rows_per_range=ROWS, **how)


def tree(n=120, seed=1):
    rng = random.Random(seed)
    return {f"{rng.choice('abcdé')}/{i:03}": rng.choice([None, "", "x", f"t{i}"]) for i in range(n)}


def changed(source, target):
    return {k: c for k, c in model_diff(source, target).items() if c != "unchanged"}


def counts(spark, store):
    rows = tm.history(spark, store).orderBy("version").collect()
    return [(r.version, r.parent, r.n_added, r.n_modified, r.n_deleted) for r in rows]


def files(df):
    return set(df.inputFiles())


# ---------------------------------------------------------------- ranges


@pytest.mark.parametrize("listed", [512, 3])
@pytest.mark.parametrize("limit", [None, "-1"])
def test_a_row_lies_in_the_range_of_the_greatest_start_not_above_it(spark, monkeypatch, listed, limit):
    monkeypatch.setattr(ranges, "LISTED", listed)
    keys = sorted(tree(200))
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "path string, n int")
    starts = ranges.starts_of(df, ["path"], ROWS)
    if limit:
        spark.conf.set(BROADCAST_SETTING, limit)
    try:
        got = {r.path: r[2] and r[2].path for r in ranges.with_start(df, ["path"], starts).collect()}
    finally:
        spark.conf.unset(BROADCAST_SETTING)
    first = sorted(r.path for r in starts.collect())
    assert len(first) > 8
    assert got == {k: max((s for s in first if s <= k), default=None) for k in keys}


def test_no_row_sorts_the_list_of_starts(spark):
    """The starts are a constant of the plan; an array sorted in it is sorted for every row and step."""
    df = spark.createDataFrame([(k,) for k in sorted(tree(200))], "path string")
    found = ranges.with_start(df, ["path"], ranges.starts_of(df, ["path"], ROWS))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan and "named_struct" not in plan


def test_ranges_of_several_keys_and_of_none(spark):
    df = spark.createDataFrame([(i // 7, f"é{i % 7}") for i in range(140)], "a int, b string")
    starts = ranges.starts_of(df, ["a", "b"], 4)
    first = sorted(tuple(r) for r in starts.collect())
    for r in ranges.with_start(df, ["a", "b"], starts).collect():
        want = max((s for s in first if s <= (r.a, r.b)), default=None)
        assert (r[2] and tuple(r[2])) == want
    assert {r[2] for r in ranges.with_start(df, ["a", "b"], starts.filter("false")).collect()} == {None}


def test_a_tree_sums_up_and_equal_trees_have_no_unequal_leaf(spark, store, monkeypatch):
    monkeypatch.setattr(ranges, "FANOUT", 2)
    one, two = tree(300), tree(300) | {"c/007": "changed", "a/new": "n"}
    put(snapshot(spark, one), store, 0)
    put(snapshot(spark, two), store, 1)
    a, b = (ranged.version_of(spark, store, v) for v in (1, 2))
    nodes = a.tree.collect()
    assert max(r.level for r in nodes) >= 3
    whole = tm.scope_digest(a.with_digests, cols=["path", "text"]).first().digest
    for level in range(max(r.level for r in nodes) + 1):
        some = [r for r in nodes if r.level == level]
        assert sum(r.n for r in some) == 300
        assert sum(int(r.digest, 16) for r in some) % 2**128 == int(whole, 16)
    assert [ids.count() for ids in ranges.unequal_leaves(a.tree, a.tree)] == [0, 0]
    for listed in (512, 0):
        monkeypatch.setattr(ranges, "LISTED", listed)
        left, right = ranges.unequal_leaves(a.tree, b.tree)
        assert 1 <= left.count() <= 2 and 1 <= right.count() <= 3


# ---------------------------------------------------------------- publish and read


def test_round_trip_and_shared_files(spark, store):
    one = tree()
    two = {k: v for k, v in one.items() if k != "a/001"} | {"b/050x": "new"}
    two[next(k for k in two if k.startswith("d/"))] = "other"
    assert put(snapshot(spark, one), store, 0) == 1
    assert as_dict(tm.read_latest(spark, store)) == one
    before = files(tm.read_latest(spark, store))
    assert put(snapshot(spark, two), store, 1) == 2
    latest = tm.read_latest(spark, store)
    assert latest.columns == ["path", "text"] and as_dict(latest) == two
    assert counts(spark, store)[0] == (1, 0, 120, 0, 0)
    kinds = list(changed(two, one).values())
    assert counts(spark, store)[1] == (2, 1, *[kinds.count(c) for c in ("added", "modified", "deleted")])
    after = files(latest)
    assert len(before) > 8 and len(after - before) <= 6 and len(before & after) >= len(before) - 6
    assert changes_of(tm.diff_versions(spark, store, 1, 2)) == changed(two, one)
    assert changes_of(tm.diff_versions(spark, store, 2, 1)) == changed(one, two)
    assert tm.diff_versions(spark, store, 2, 2).count() == 0


def test_a_comparison_reads_only_ranges_that_differ(spark, store):
    one = tree()
    put(snapshot(spark, one), store, 0)
    put(snapshot(spark, one | {"c/000": "changed"}), store, 1)
    every = files(tm.read_latest(spark, store))
    read = files(tm.diff_versions(spark, store, 1, 2))
    assert len(every) > 8 and len(read) <= 4
    near = tm.diff_latest(snapshot(spark, one), store, rows_per_range=ROWS)
    assert changes_of(near) == changed(one, one | {"c/000": "changed"})
    theirs = {f for f in files(near) if "/snapshots/" in f}
    assert len(theirs) <= 2


def test_versions_of_two_stores(spark, store, tmp_path):
    one, other = tree(), str(tmp_path / "other")
    put(snapshot(spark, one), store, 0)
    put(snapshot(spark, {"q/1": "first"}), other, 0)
    put(snapshot(spark, one | {"a/002": "z"}), other, 1)
    found = tm.diff_versions(spark, store, 1, 2, new_store=other)
    assert changes_of(found) == changed(one | {"a/002": "z"}, one)
    assert len(files(found)) <= 4


def test_random_edits(spark, store):
    rng, now, parent = random.Random(4), {}, 0
    for _ in range(5):
        then = dict(now)
        for k in rng.sample(sorted(now), len(now) // 5):
            then.pop(k) if rng.random() < 0.5 else then.update({k: rng.choice(["n", None])})
        then |= {f"{rng.choice('abz')}/{rng.randrange(90):02}": "v" for _ in range(25)}
        if not changed(then, now):
            continue
        parent = put(snapshot(spark, then), store, parent)
        assert as_dict(tm.read_latest(spark, store)) == then
        if parent > 1:
            assert changes_of(tm.diff_versions(spark, store, parent - 1, parent)) == changed(then, now)
        now = then


@pytest.mark.parametrize("parts", [1, 7])
def test_patches_write_only_their_ranges(spark, store, parts):
    one = tree()
    two = {k: v for k, v in one.items() if k not in ("a/003", "b/001")} | {"e/5": "n", "a/000": "m"}
    put(snapshot(spark, one), store, 0)
    before = files(tm.read_latest(spark, store))
    patch = tm.make_patch(snapshot(spark, two).repartition(parts), tm.read_latest(spark, store), "path")
    assert tm.publish_patch(patch, store, "m", "ann", 1, rows_per_range=ROWS) == 2
    assert as_dict(tm.read_latest(spark, store)) == two
    kinds = list(changed(two, one).values())
    assert counts(spark, store)[1][2:] == tuple(kinds.count(c) for c in ("added", "modified", "deleted"))
    assert len(before & files(tm.read_latest(spark, store))) >= len(before) - 5
    assert changes_of(tm.diff_versions(spark, store, 1, 2)) == changed(two, one)
    with pytest.raises(PatchError):  # it has been applied
        tm.publish_patch(patch, store, "m", "ann", 2, rows_per_range=ROWS)
    with pytest.raises(StaleParentError):
        tm.publish_patch(patch, store, "m", "ann", 1)


def test_a_patch_is_computed_once(spark, store):
    old = tree(60)
    new = {k: v for k, v in old.items() if v != "x"} | {"a/new": "1"}
    put(snapshot(spark, old), store, 0)
    patch = tm.make_patch(snapshot(spark, new), tm.read_latest(spark, store), "path")
    seen = spark.sparkContext.accumulator(0)

    def count(change):
        seen.add(1)
        return change

    counted = patch.withColumn("change", F.udf(count, "string")("change"))
    tm.publish_patch(counted, store, "m", "ann", 1, rows_per_range=ROWS)
    assert seen.value == patch.count()
    assert as_dict(tm.read_latest(spark, store)) == new


def test_patches_that_empty_ranges_and_the_table(spark, store):
    one = tree(60)
    put(snapshot(spark, one), store, 0)
    some = {k: v for k, v in one.items() if k > "b"}
    for parent, now in ((1, some), (2, {}), (3, one)):
        patch = tm.make_patch(snapshot(spark, now), tm.read_latest(spark, store), "path")
        assert tm.publish_patch(patch, store, "m", "ann", parent, rows_per_range=ROWS) == parent + 1
        assert as_dict(tm.read_latest(spark, store)) == now
    assert changes_of(tm.diff_versions(spark, store, 1, 2)) == changed(some, one)
    assert tm.diff_versions(spark, store, 1, 4).count() == 0
    assert put(snapshot(spark, some), store, 4) == 5
    assert as_dict(tm.read_latest(spark, store)) == some


def test_scopes_are_read_from_the_files_that_hold_them(spark, store):
    one = tree(300)
    put(snapshot(spark, one), store, 0)
    every = files(tm.read_latest(spark, store))
    for prefixes in (["b/"], ["a/", "é/"], ["zz/"], ["b/0/"]):
        found = tm.read_latest(spark, store, scope=prefixes)
        assert as_dict(found) == {k: v for k, v in one.items() if k.startswith(tuple(prefixes))}
        assert len(files(found)) < 0.7 * len(every)
    # a path that comes second in the key: only the bits of the scopes tell
    other = spark.createDataFrame([(i, f"s{i // 100}/{i}") for i in range(400)], "n int, path string")
    put(other, store + "2", 0, keys=["n", "path"])
    found = tm.read_latest(spark, store + "2", scope="s3/")
    assert found.count() == 100 and len(files(found)) < 0.5 * len(files(tm.read_latest(spark, store + "2")))
    plain = store + "3"
    tm.publish(snapshot(spark, one), plain, "m", "ann", 0, keys="path")
    assert as_dict(tm.read_latest(spark, plain, scope="b/")) == {k: v for k, v in one.items() if k[0] == "b"}


def test_plain_and_ranged_versions_follow_each_other(spark, store):
    one, two, three = tree(40), tree(44), tree(48, seed=2)
    tm.publish(snapshot(spark, one), store, "m", "ann", 0, keys="path")
    assert put(snapshot(spark, two), store, 1) == 2
    assert counts(spark, store)[1][2:] == (4, 0, 0)
    assert tm.publish(snapshot(spark, three), store, "m", "ann", 2, keys="path") == 3
    assert as_dict(tm.read_latest(spark, store)) == three
    for old, new, a, b in ((1, 2, one, two), (2, 3, two, three)):
        assert changes_of(tm.diff_versions(spark, store, old, new, keys="path")) == changed(b, a)
    with pytest.raises(PublishError):
        tm.diff_latest(snapshot(spark, one), store)


def test_nulls_nested_types_and_clashing_names(spark, store):
    schema = "id long, key string, n int, digest array<double>, s struct<x:int,y:array<int>>, start string, files string"
    rows = [(i, None if i % 3 else "k", i % 5, [1.0 * i, None], (i, [i]) if i % 2 else None, None, "f") for i in range(60)]
    one = spark.createDataFrame(rows, schema)
    two = one.withColumn("n", F.when(F.col("id") == 7, None).otherwise(F.col("n")))
    put(one, store, 0, keys="id")
    put(two, store, 1, keys="id")
    assert sorted(map(repr, tm.read_latest(spark, store).collect())) == sorted(map(repr, two.collect()))
    assert [tuple(r) for r in tm.diff_versions(spark, store, 1, 2).collect()] == [(7, "modified")]


# ---------------------------------------------------------------- refusals


def test_refused_versions_leave_the_store_as_it_was(spark, store, tmp_path):
    one = tree(30)
    put(snapshot(spark, one), store, 0)

    def every_file():
        return {str(p) for p in (tmp_path / "store").rglob("*.parquet")}

    held = every_file()
    double = snapshot(spark, one).union(snapshot(spark, {"a/000": "q", "zz/1": "q"})).union(snapshot(spark, {"zz/1": "q"}))
    for error, df, parent, how in [
        (NothingChangedError, snapshot(spark, one), 1, {}),
        (StaleParentError, snapshot(spark, one), 0, {}),
        (KeyCheckError, double, 1, {}),
        (SchemaError, snapshot(spark, one).withColumn("leaf", F.lit(1)), 1, {}),
        (SchemaError, snapshot(spark, one).withColumn("more", F.lit(1)), 1, {}),
        (SchemaError, snapshot(spark, one), 1, {"scope": "absent"}),
        (Exception, snapshot(spark, one).union(spark.createDataFrame([(None, "x")], "path string, text string")), 1, {}),
    ]:
        with pytest.raises(error):
            put(df, store, parent, **how)
        assert every_file() == held and tm.latest_version(spark, store) == 1
    with pytest.raises(EmptyMessageError):
        tm.publish_ranged(snapshot(spark, one), store, "", "ann", 1, keys="path")
    assert put(snapshot(spark, one), store, 1, allow_empty=True) == 1
    with pytest.raises(PublishError):
        tm.diff_versions(spark, store, 1, 9)

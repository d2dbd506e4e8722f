import os

import pytest
from pyspark.sql import functions as F

import tablemirror as tm
from tablemirror.errors import (
    EmptyMessageError,
    KeyCheckError,
    NothingChangedError,
    PublishError,
    SchemaError,
    StaleParentError,
)
from tablemirror.operators.diff import DIGEST_SUFFIX
from trees import as_dict, snapshot


@pytest.fixture
def store(tmp_path):
    return str(tmp_path / "store")


def put(df, store, parent, message="m", **how):
    return tm.publish(df, store, message, "ann", parent, keys="path", **how)


def versions(spark, store):
    rows = tm.history(spark, store).orderBy("version").collect()
    return [(r.version, r.parent, r.n_added, r.n_modified, r.n_deleted) for r in rows]


@pytest.mark.parametrize(
    ("digest", "cluster", "validate"),
    [(None, False, True), (["text"], False, "inline"), (["text"], True, True), ([], True, False)],
)
def test_round_trip(spark, store, digest, cluster, validate):
    one = {"a/1": "x", "a/2": None, "b/1": "y"}
    two = {"a/1": "x", "a/2": "z", "c/1": "y"}
    how = {"digest": digest, "cluster": cluster, "validate": validate}
    assert put(snapshot(spark, one), store, 0, "first", **how) == 1
    assert as_dict(tm.read_latest(spark, store)) == one
    assert put(snapshot(spark, two), store, 1, " ", **how) == 2  # blanks are a message
    latest = tm.read_latest(spark, store)
    assert latest.columns == ["path", "text"]
    assert as_dict(latest) == two
    assert versions(spark, store) == [(1, 0, 3, 0, 0), (2, 1, 1, 1, 1)]
    last = tm.history(spark, store).filter("version = 2").first()
    assert (last.message, last.author) == (" ", "ann")
    assert last.published_at is not None
    stored = tm.read_latest(spark, store, with_digests=True)
    assert ("text" + DIGEST_SUFFIX in stored.columns) == (digest != [])
    assert tm.diff(snapshot(spark, two), stored, "path", digest=["text"]).count() == 0
    changed = tm.diff(snapshot(spark, one), stored, "path", digest=["text"])
    assert changed.count() == 3


def test_publish_the_result_of_a_plan_on_the_latest_version(spark, store):
    put(snapshot(spark, {"a/1": "x", "a/2": "y", "b/1": "z"}), store, 0)
    source = snapshot(spark, {"a/1": "x2", "c/1": "w"})
    result = tm.run_plan(source, tm.read_latest(spark, store), "path", [(1, "a/", "mirror")])
    assert put(result, store, 1) == 2
    assert as_dict(tm.read_latest(spark, store)) == {"a/1": "x2", "b/1": "z"}
    assert versions(spark, store)[-1] == (2, 1, 0, 1, 1)


def test_an_emptied_snapshot_is_the_latest(spark, store):
    put(snapshot(spark, {"a/1": "x"}), store, 0)
    assert put(snapshot(spark, {}), store, 1) == 2
    assert tm.read_latest(spark, store).count() == 0
    assert tm.read_latest(spark, store).columns == ["path", "text"]
    assert versions(spark, store)[-1] == (2, 1, 0, 0, 1)
    assert put(snapshot(spark, {"a/1": "x"}), store, 2) == 3
    assert versions(spark, store)[-1] == (3, 2, 1, 0, 0)


def test_empty_store(spark, store):
    assert tm.latest_version(spark, store) == 0
    assert tm.history(spark, store).count() == 0
    with pytest.raises(PublishError):
        tm.read_latest(spark, store)
    schema = snapshot(spark, {}).schema
    empty = tm.read_latest(spark, store, schema=schema)
    assert empty.schema.simpleString() == schema.simpleString()
    source = snapshot(spark, {"a/1": "x", "b/1": "y"})
    assert as_dict(tm.run_plan(source, empty, "path", [(1, "a/", "mirror")])) == {"a/1": "x"}


def test_empty_message(spark, store):
    for message in ("", None):
        with pytest.raises(EmptyMessageError):
            put(snapshot(spark, {"a/1": "x"}), store, 0, message)
    assert not os.path.exists(store)


def test_nothing_changed(spark, store):
    tree = snapshot(spark, {"a/1": "x", "a/2": None})
    put(tree, store, 0)
    with pytest.raises(NothingChangedError):
        put(tree, store, 1)
    assert put(tree, store, 1, allow_empty=True) == 1
    assert [name.split("-")[0] for name in os.listdir(f"{store}/snapshots")] == ["1"]
    assert len(versions(spark, store)) == 1


def test_first_version_without_rows(spark, store):
    with pytest.raises(NothingChangedError):
        put(snapshot(spark, {}), store, 0)
    assert tm.latest_version(spark, store) == 0


def test_stale_parent(spark, store):
    put(snapshot(spark, {"a/1": "x"}), store, 0)
    put(snapshot(spark, {"a/1": "y"}), store, 1)
    for parent in (0, 1, 3):
        with pytest.raises(StaleParentError):
            put(snapshot(spark, {"a/1": "z"}), store, parent)
    assert as_dict(tm.read_latest(spark, store)) == {"a/1": "y"}


@pytest.mark.parametrize("mine", [{"a/1": "mine"}, {"a/1": "x"}])
def test_a_competitor_is_not_harmed(spark, store, monkeypatch, mine):
    """Another writer publishes version 2 after this one's first look at the history."""
    from tablemirror.sources import versions as version_rows

    put(snapshot(spark, {"a/1": "x"}), store, 0)
    check, calls = version_rows.refuse_stale, []

    def late(*args):
        check(*args)
        calls.append(1)
        if len(calls) == 1:
            monkeypatch.setattr(version_rows, "refuse_stale", check)
            assert put(snapshot(spark, {"a/1": "theirs"}), store, 1) == 2

    monkeypatch.setattr(version_rows, "refuse_stale", late)
    with pytest.raises((StaleParentError, NothingChangedError)):
        put(snapshot(spark, mine), store, 1)
    assert as_dict(tm.read_latest(spark, store)) == {"a/1": "theirs"}
    assert [v[0] for v in versions(spark, store)] == [1, 2]
    assert len(os.listdir(f"{store}/snapshots")) == 2


def test_refused_rows_leave_no_trace(spark, store):
    put(snapshot(spark, {"a/1": "x"}), store, 0)
    twice = snapshot(spark, {"a/1": "y"}).unionByName(snapshot(spark, {"a/1": "z"}))
    for validate in (True, "inline"):
        with pytest.raises(KeyCheckError, match="duplicate"):
            put(twice, store, 1, validate=validate)
    with pytest.raises(KeyCheckError, match="validate"):
        put(twice, store, 1, validate="source")
    with pytest.raises(SchemaError):
        put(snapshot(spark, {"a/1": "y"}).withColumn("more", F.lit(1)), store, 1)
    with pytest.raises(SchemaError, match="reserved"):
        put(snapshot(spark, {"a/1": "y"}).withColumn("text__sha256", F.lit(1)), store, 1)
    assert [name.split("-")[0] for name in os.listdir(f"{store}/snapshots")] == ["1"]
    assert as_dict(tm.read_latest(spark, store)) == {"a/1": "x"}


def test_a_map_by_value_is_refused_before_anything_is_written(spark, store):
    tree = snapshot(spark, {"a/1": "x"}).withColumn("extra", F.create_map("path", "text"))
    with pytest.raises(SchemaError, match="extra"):
        put(tree, store, 0, digest=[])
    assert not os.path.exists(store)


def test_a_version_without_history_is_never_seen(spark, store):
    put(snapshot(spark, {"a/1": "x"}), store, 0)
    orphan = snapshot(spark, {"a/1": "half", "a/2": "written"})
    orphan.write.parquet(f"{store}/snapshots/2-half-written")
    assert as_dict(tm.read_latest(spark, store)) == {"a/1": "x"}
    assert put(snapshot(spark, {"a/1": "y"}), store, 1) == 2
    assert as_dict(tm.read_latest(spark, store)) == {"a/1": "y"}


def test_a_failing_write_publishes_nothing(spark, store):
    put(snapshot(spark, {"a/1": "x"}), store, 0)
    broken = snapshot(spark, {"a/1": "y"}).withColumn("text", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        put(broken, store, 1)
    assert tm.latest_version(spark, store) == 1
    assert as_dict(tm.read_latest(spark, store)) == {"a/1": "x"}


def test_versions_with_and_without_digests_compare(spark, store):
    """Each side's digest is read where it is stored and computed where it is not."""
    trees = [{"a/1": "x", "a/2": None}, {"a/1": "y", "a/2": None}, {"a/1": "y", "a/2": "z"}]
    for parent, (tree, digest) in enumerate(zip(trees, ([], ["text"], []))):
        put(snapshot(spark, tree), store, parent, digest=digest)
    assert versions(spark, store) == [(1, 0, 2, 0, 0), (2, 1, 0, 1, 0), (3, 2, 0, 1, 0)]


def test_binary_columns_store_a_digest_by_default(spark, store):
    df = spark.createDataFrame([("a", bytearray(b"1")), ("b", None)], "path string, content binary")
    put(df, store, 0)
    stored = tm.read_latest(spark, store, with_digests=True)
    assert stored.columns == ["path", "content", "content__sha256"]
    other = df.withColumn("content", F.when(F.col("path") == "a", F.col("content")).otherwise(F.lit(b"2")))
    assert put(other, store, 1) == 2
    assert versions(spark, store)[-1] == (2, 1, 0, 1, 0)


def test_two_key_columns_and_a_key_that_is_not_a_path(spark, store):
    talks = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    keys = ["conv_id", "turn"]
    assert tm.publish(talks, store, "m", "a", 0, keys=keys) == 1
    fewer = talks.filter("role <> 'system'")
    assert tm.publish(fewer, store, "m", "a", 1, keys=keys) == 2
    assert versions(spark, store)[-1] == (2, 1, 0, 0, talks.count() - fewer.count())

import pytest

import tablemirror as tm
from tablemirror.errors import PublishError, StaleParentError
from tablemirror.sources import paths, versions
from trees import as_dict, snapshot


@pytest.mark.parametrize("how", [tm.publish, tm.publish_ranged])
def test_one_of_two_writers_wins(spark, tmp_path, monkeypatch, how):
    store = str(tmp_path / "s")
    how(snapshot(spark, {"a/1": "x"}), store, "m", "ann", 0, keys="path")
    check, calls = versions.refuse_stale, []

    def interleaved(*args):
        check(*args)
        calls.append(1)
        if len(calls) == 2:  # the last check of one writer has passed, and another one publishes
            how(snapshot(spark, {"a/1": "first"}), store, "m", "ben", 1, keys="path")

    monkeypatch.setattr(versions, "refuse_stale", interleaved)
    with pytest.raises(StaleParentError, match="claimed"):
        how(snapshot(spark, {"a/1": "second"}), store, "m", "ann", 1, keys="path")
    monkeypatch.undo()
    assert as_dict(tm.read_latest(spark, store)) == {"a/1": "first"}
    assert [r.author for r in tm.history(spark, store).orderBy("version").collect()] == ["ann", "ben"]
    assert len(list((tmp_path / "s" / "snapshots").iterdir())) == 2


def test_a_claim_without_a_version_can_be_released(spark, tmp_path):
    store = str(tmp_path / "s")
    assert paths.create_new(spark, f"{store}/claims/1") and not paths.create_new(spark, f"{store}/claims/1")
    with pytest.raises(StaleParentError, match="release_claim"):
        tm.publish(snapshot(spark, {"a/1": "x"}), store, "m", "ann", 0, keys="path")
    tm.release_claim(spark, store, 1)
    assert tm.publish(snapshot(spark, {"a/1": "x"}), store, "m", "ann", 0, keys="path") == 1
    with pytest.raises(PublishError):
        tm.release_claim(spark, store, 1)

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import tablemirror as tm
from tablemirror.errors import ScanError
from tablemirror.sources import files
from trees import changes_of

FILES = {
    "logs/run 1.txt": b"one",
    "logs/deep/er/50%.log": b"",
    "code/日本 ü.md": b"\x00\xff",
    "notes.txt": b"note",
}


@pytest.fixture
def root(tmp_path):
    base = tmp_path / "my tree ä"
    write(base, FILES)
    return base


def write(base, files):
    for name, content in files.items():
        (base / name).parent.mkdir(parents=True, exist_ok=True)
        (base / name).write_bytes(content)


def test_paths_are_relative_and_unescaped(spark, root):
    for form in (str(root), str(root) + "/", f"file://{root}"):
        df = tm.scan_files(spark, form)
        assert df.columns == ["path", "modified", "length"]
        assert {r.path: r.length for r in df.collect()} == {p: len(c) for p, c in FILES.items()}


def test_content(spark, root):
    rows = tm.scan_files(spark, str(root), content=True).collect()
    assert {r.path: bytes(r.content) for r in rows} == FILES


@pytest.mark.parametrize("piece", [1, 3, 7, 10**6])
def test_pieces_hold_every_line_once_and_whole(spark, root, monkeypatch, piece):
    monkeypatch.setattr(files, "_READ", 2)
    texts = {"a": b"one\ntwo\n\n\nthree and more\n", "b": b"\n", "c": b"no end", "d": b"", "e": b"\n\nx\nyy"}
    write(root, {f"t/{name}": text for name, text in texts.items()})
    found = tm.scan_files(spark, str(root), content=True, piece=piece).filter("path like 't/%'")
    assert found.columns == ["path", "modified", "length", "start", "content"]
    parts = {}
    for r in sorted(found.collect(), key=lambda r: (r.path, r.start)):
        parts.setdefault(r.path[2:], []).append((r.start, bytes(r.content)))
        assert r.length == len(texts[r.path[2:]])
    for name, text in texts.items():
        assert b"".join(c for _, c in parts[name]) == text
        assert all(text[at : at + len(c)] == c and (c or not text) for at, c in parts[name])
        assert all(c.endswith(b"\n") for _, c in parts[name][:-1])
        assert all(at == 0 or text[at - 1 : at] == b"\n" for at, _ in parts[name])


def test_contents_are_read_by_as_many_tasks_as_their_bytes_ask_for(spark, root, monkeypatch):
    monkeypatch.setattr(files, "_TASK_BYTES", 10)
    write(root, {f"many/{i}": b"line\n" * 20 for i in range(20)})
    for how in ({}, {"piece": 10}):
        found = tm.scan_files(spark, str(root), content=True, **how)
        assert found.rdd.getNumPartitions() > 100
        assert found.filter("path like 'many/%'").agg(F.sum(F.octet_length("content"))).first()[0] == 2000


def test_pieces_need_content(spark, root):
    for how in ({"piece": 5}, {"piece": 5, "content": True, "hidden": "skip"}, {"piece": 0, "content": True}):
        with pytest.raises(ScanError):
            tm.scan_files(spark, str(root), **how)


def test_names_that_spark_hides(spark, root):
    write(root, {".hidden": b"x", "logs/_tmp": b"x", "_folder/file": b"x"})
    everything = FILES.keys() | {".hidden", "logs/_tmp", "_folder/file"}
    assert {r.path for r in tm.scan_files(spark, str(root)).collect()} == everything
    plain = tm.scan_files(spark, str(root), hidden="skip")
    assert {r.path for r in plain.filter("length > 0").collect()} == {p for p, c in FILES.items() if c}
    with pytest.raises(ScanError):
        tm.scan_files(spark, str(root), hidden="drop")


def test_empty_files_with_awkward_names(spark, root):
    names = {"a+b %25 ü.log", "50%", "logs/x=1/_k=v", "logs/#1?.txt"}
    write(root, {name: b"" for name in names} | {"logs/_metadata": b""})
    rows = tm.scan_files(spark, str(root), content=True).filter("length = 0").collect()
    assert {r.path for r in rows} == names | {"logs/deep/er/50%.log", "logs/_metadata"}
    assert all(r.content == b"" and r.modified is not None for r in rows)


def test_an_empty_folder_is_no_row(spark, root):
    (root / "empty").mkdir()
    assert tm.scan_files(spark, str(root)).count() == len(FILES)


def test_missing_root_raises(spark, tmp_path):
    with pytest.raises(ScanError):
        tm.scan_files(spark, str(tmp_path / "nowhere"))


def test_trees_differ_by_content_not_by_time(spark, root, tmp_path):
    other = tmp_path / "other"
    write(other, {**FILES, "notes.txt": b"done", "new.txt": b""})
    (other / "logs/run 1.txt").unlink()
    source = tm.scan_files(spark, str(other), content=True)
    target = tm.scan_files(spark, str(root), content=True)
    assert changes_of(tm.diff(source, target, "path", compare=["content"])) == {
        "notes.txt": "modified",
        "new.txt": "added",
        "logs/run 1.txt": "deleted",
    }


def test_listing_does_not_read_content(spark, root):
    (root / "code/日本 ü.md").chmod(0)
    plan = tm.scan_files(spark, str(root))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    assert "Join" not in plan
    assert tm.scan_files(spark, str(root)).count() == len(FILES)


def test_the_whole_round(spark, root, tmp_path):
    """Into a subfolder of the target: a named file, two mirrored folders, the rest left alone."""
    store = str(tmp_path / "store")
    before = {"proj/logs/old.log": b"x", "proj/other": b"k", "proj/notes.txt": b"old", "top": b"t"}
    write(tmp_path / "old", before)
    old = tm.scan_files(spark, str(tmp_path / "old"), content=True).drop("modified")
    first = tm.publish(old, store, "import", "ann", 0, keys="path")
    files = tm.scan_files(spark, str(root), content=True).drop("modified")
    result = tm.run_plan(
        files.withColumn("path", F.concat(F.lit("proj/"), "path")),
        tm.read_latest(spark, store),
        "path",
        [(1, "proj/logs/", "mirror"), (2, "proj/code/", "mirror")],
        required=spark.createDataFrame([("proj/notes.txt",)], "path string"),
        validate="source",
    )
    assert tm.publish(result, store, "sync", "ann", first, keys="path") == 2
    got = {r.path: bytes(r.content) for r in tm.read_latest(spark, store).collect()}
    moved = {f"proj/{path}": content for path, content in FILES.items()}
    assert got == {**moved, "proj/other": b"k", "top": b"t"}
    last = tm.history(spark, store).filter("version = 2").first()
    assert (last.n_added, last.n_modified, last.n_deleted) == (3, 1, 1)


def test_a_huge_folder_is_listed_in_ranges_of_names(spark, tmp_path):
    base = tmp_path / "huge"
    write(base, {f"logs/{i % 700:04d} ü{i}": b"x" * (i % 3) for i in range(3000)})
    write(base, {"logs/below/one": b"1", "logs/zz/two": b"22", "top": b""})
    want = {str(p.relative_to(base)): p.stat().st_size for p in base.rglob("*") if p.is_file()}
    for split in (1, 500, 3001, 10**6):
        rows = tm.scan_files(spark, str(base), split=split).collect()
        assert len(rows) == len(want)
        assert {r.path: r.length for r in rows} == want


def test_ranges_are_even_and_names_stream(tmp_path):
    base = tmp_path / "many"
    base.mkdir()
    for i in range(20_000):
        (base / f"part-{i:06d}").touch()
    cuts = files._cuts(f"{base}/", 5000)
    assert len(cuts) == 3
    edges = [None, *cuts, None]
    sizes = [sum(1 for _ in files._names(f"{base}/", a, b)) for a, b in zip(edges, edges[1:])]
    assert sum(sizes) == 20_000 and max(sizes) < 6500
    folder = pa.RecordBatch.from_pydict({"path": [""], "least": ["part-005000"], "beyond": [None]})
    first = next(files._children(f"file://{base}", 5000, iter([folder])))
    assert first.num_rows == files._ROWS  # a batch, not the list of the folder

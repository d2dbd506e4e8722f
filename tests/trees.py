"""Small snapshots for the tests, and a dict model of what the operators should do."""

from __future__ import annotations

from pyspark.sql import SparkSession

SCHEMA = "path string, text string"


def snapshot(spark: SparkSession, rows: dict[str, str | None]):
    return spark.createDataFrame(sorted(rows.items()), SCHEMA)


def as_dict(df) -> dict:
    rows = df.select("path", "text").collect()
    out = {r["path"]: r["text"] for r in rows}
    assert len(out) == len(rows), "a path occurs twice"
    return out


def changes_of(df) -> dict[str, str]:
    rows = df.collect()
    out = {r["path"]: r["change"] for r in rows}
    assert len(out) == len(rows)
    return out


def model_diff(source: dict, target: dict) -> dict[str, str]:
    out = {}
    for path in source.keys() | target.keys():
        if path not in target:
            out[path] = "added"
        elif path not in source:
            out[path] = "deleted"
        elif source[path] != target[path]:
            out[path] = "modified"
        else:
            out[path] = "unchanged"
    return out


def model_plan(source: dict, target: dict, rules, required=()) -> dict:
    """Step by step, as the rules are written."""
    out = dict(target)
    for path in required:
        out[path] = source[path]
    for _, prefix, mode in sorted(rules):
        if mode == "mirror":
            out = {p: v for p, v in out.items() if not p.startswith(prefix)}
        out.update({p: v for p, v in source.items() if p.startswith(prefix)})
    return out


# The fixture of FIXTURES.md: two snapshots of documents with an edit script.
TREES_SQL = """
with src as (
  select concat(source, '/', cast(doc_id as varchar(20))) as path, source as scope, lang,
         case when doc_id % 13 = 0 then null
              when doc_id % 11 = 0 then concat(text, ' [rev2]')
              else text end as text
  from documents where doc_id % 7 <> 0 and source <> 'src9'
), tgt as (
  select concat(source, '/', cast(doc_id as varchar(20))) as path, source as scope, lang,
         case when doc_id % 26 = 0 then null else text end as text
  from documents where doc_id % 3 <> 0 and source <> 'src8'
)
"""
RULES = [
    (1, "src1/", "mirror"),
    (2, "src8/", "mirror"),
    (3, "src9/", "mirror"),
    (4, "src2/", "upsert"),
    (5, "src3/", "upsert"),
]


def document_trees(spark: SparkSession, sf: str):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    docs.createOrReplaceTempView("documents")
    return tuple(spark.sql(TREES_SQL + f"select * from {side}") for side in ("src", "tgt"))

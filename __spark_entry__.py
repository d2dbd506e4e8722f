"""

Two trees of the whole ``documents`` table are compared and merged throughout:

* the published tree (target): every document at ``<source>/<doc_id>``, the Spanish
  ones still at ``inbox/<doc_id>``; texts under 200 characters are held back (null);
* the working tree (source): every document at ``<source>/<doc_id>``, those labelled
  toxic at ``quarantine/<doc_id>``; texts under 400 characters are held back, and
  texts that mention an address (``@``) have been reviewed and marked.

So ``inbox/`` is empty in the source, ``quarantine/`` is new, all other scopes gain,
lose and change rows, nulls meet values and nulls, and ``src1/`` sits beside ``src10/``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tablemirror as tm
from tablemirror.operators import keys as key_checks
from tablemirror.sources import paths

try:  # the operators for training data are a part that the library works without
    from tablemirror.llm import queries as llm
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith("tablemirror.llm"):
        raise
    llm = None
try:
    import corpus_pipeline
except ModuleNotFoundError as missing:
    if missing.name != "corpus_pipeline" and not (missing.name or "").startswith("tablemirror.llm"):
        raise
    corpus_pipeline = None

MIRRORED = ["src1/", "quarantine/", "inbox/"]
UPSERTED = ["src2/", "src3/"]
RULES = [
    *[tm.Rule(i, p, "mirror") for i, p in enumerate(MIRRORED)],
    *[tm.Rule(len(MIRRORED) + i, p, "upsert") for i, p in enumerate(UPSERTED)],
]
MARK = " [reviewed]"
#: Rows of a key range in the stores of the queries, which are small.
RANGE_ROWS = 100
#: Bytes of a file that scan_content splits into lines at a time.
PIECE = 1 << 20


# ---------------------------------------------------------------- inputs


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _path(scope) -> F.Column:
    return F.concat(scope, F.lit("/"), F.col("doc_id").cast("string")).alias("path")


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    toxic = _table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id", "toxic")
    scope = F.when(F.col("toxic") == 1, "quarantine").otherwise(F.col("source"))
    text = F.col("text")
    return docs.join(toxic, "doc_id", "left").select(
        _path(scope),
        "lang",
        F.when(F.col("n_chars") < 400, None)
        .when(text.contains("@"), F.concat(text, F.lit(MARK)))
        .otherwise(text)
        .alias("text"),
    )


def _target(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = F.when(F.col("lang") == "es", "inbox").otherwise(F.col("source"))
    text = F.when(F.col("n_chars") >= 200, F.col("text"))
    return _table(spark, sf_dir, "documents").select(_path(scope), "lang", text.alias("text"))


def _trees(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _source(spark, sf_dir), _target(spark, sf_dir)


def _scratch(spark: SparkSession) -> str:
    """A new folder that every executor can reach."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        folder = f"{shared.rstrip('/')}/tablemirror-{uuid.uuid4().hex}"
        paths.delete_on_exit(spark, folder)
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tablemirror-")
    paths.delete_on_exit(spark, folder)
    return folder


# ---------------------------------------------------------------- queries


def diff_changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _trees(spark, sf_dir)
    return tm.diff(source, target, "path", digest=["text"])


def diff_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _trees(spark, sf_dir)
    return tm.change_summary(
        tm.diff(source, target, "path", keep_unchanged=True, digest=["text"])
    )


def diff_by_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _trees(spark, sf_dir)
    changes = tm.diff(source, target, "path", keep_unchanged=True, digest=["text"])
    return tm.change_summary(changes, by=tm.scope_of().alias("scope"))


def diff_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scopes that lie inside each other, and documents at the top of the tree."""
    docs = _table(spark, sf_dir, "documents")
    folder = F.when(F.col("lang") == "fr", "").otherwise(F.concat("source", F.lit("/"), "lang", F.lit("/")))
    target = docs.select(F.concat(folder, F.col("doc_id").cast("string")).alias("path"), "text")
    source = target.filter(F.length("text") >= 400)
    changes = tm.diff(source, target, "path", keep_unchanged=True, validate="inline")
    nested = ["src1/", "src1/en/", "src2/de/"]
    return tm.change_summary(changes, by=tm.scope_of(prefixes=nested).alias("scope"))


def folder_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes below every folder of a tree with a folder for each digit of an id; some lie at its top."""
    docs = _table(spark, sf_dir, "documents")
    number = F.col("doc_id").cast("string")
    digits = F.regexp_replace(number, "(.)", "$1/")
    folder = F.when(F.col("lang") == "fr", "").otherwise(F.concat("source", F.lit("/"), "lang", F.lit("/"), digits))
    target = docs.select(F.concat(folder, number).alias("path"), "text")
    source = target.filter(F.length("text") >= 400)
    return tm.folder_summary(tm.diff(source, target, "path", keep_unchanged=True, validate="inline"))


def diff_orders_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order status rebuilt from the line items, against the status on record."""
    status = (
        F.when(F.bool_and(F.col("l_linestatus") == "F"), "F")
        .when(F.bool_and(F.col("l_linestatus") == "O"), "O")
        .otherwise("P")
    )
    rebuilt = (
        _table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(status.alias("o_orderstatus"))
    )
    recorded = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return tm.diff(rebuilt, recorded, "o_orderkey", validate="inline")


def diff_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two key columns: system turns dropped, line breaks flattened."""
    talks = _table(spark, sf_dir, "conversations")
    flat = talks.filter("role <> 'system'").withColumn(
        "text", F.replace("text", F.lit("\n"), F.lit(" "))
    )
    return tm.diff(flat, talks, ["conv_id", "turn"], keep_unchanged=True, digest=["text"])


def diff_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array payload, compared by its digest: vectors of labels under 5 reversed."""
    vectors = _table(spark, sf_dir, "embeddings")
    turned = vectors.withColumn(
        "embedding",
        F.when(F.col("label") < 5, F.reverse("embedding")).otherwise(F.col("embedding")),
    )
    return tm.diff(turned, vectors, "vec_id", keep_unchanged=True)


def diff_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map of turns for each conversation, without system turns and built the other way round."""
    talks = _table(spark, sf_dir, "conversations")
    turn = F.struct("turn", F.struct("role", "text").alias("said"))

    def one_map(rows: DataFrame, ascending: bool) -> DataFrame:
        entries = F.sort_array(F.collect_list(turn), ascending)
        return rows.groupBy("conv_id").agg(F.map_from_entries(entries).alias("turns"))

    return tm.diff(one_map(talks.filter("role <> 'system'"), False), one_map(talks, True), "conv_id", keep_unchanged=True)


def select_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every labelled document has to be there."""
    labelled = _table(spark, sf_dir, "labels").select("doc_id")
    return tm.select_required(_table(spark, sf_dir, "documents"), labelled)


def required_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _trees(spark, sf_dir)
    return tm.missing_required(source, target.select("path"))


def scope_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.in_scope(_source(spark, sf_dir), "src1/")


def row_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return tm.row_digest(docs, "text").select("doc_id", "digest")


def row_digest_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several columns, with nulls among them."""
    return tm.row_digest(_source(spark, sf_dir), ["lang", "text"]).select("path", "digest")


def row_digest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with equal digests, counted: a vector, its double, and both with zeros negated."""
    vectors = _table(spark, sf_dir, "embeddings")
    signed = F.transform("embedding", lambda x: F.when(x == 0, -x).otherwise(x))
    every = vectors.union(vectors.withColumn("embedding", signed))
    return tm.row_digest(every, "embedding").groupBy("digest").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("n")
    ).select("vec_id", "n")


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.duplicate_keys(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a line item: keyed by their lines, they have no key."""
    lines = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_lines"))
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return tm.null_keys(joined, "l_orderkey").select("o_orderkey", "o_custkey")


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _trees(spark, sf_dir)
    return tm.upsert(source, target, "path")


def upsert_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert as it runs where no set of keys is small enough to broadcast."""
    source, target = _trees(spark, sf_dir)
    before = spark.conf.get(key_checks.BROADCAST_SETTING, None)
    spark.conf.set(key_checks.BROADCAST_SETTING, "-1")
    try:
        return tm.upsert(source, target, "path")
    finally:
        if before is None:
            spark.conf.unset(key_checks.BROADCAST_SETTING)
        else:
            spark.conf.set(key_checks.BROADCAST_SETTING, before)


def without_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target rows that the source lacks; bits rule out most others before the join."""
    source, target = _trees(spark, sf_dir)
    return tm.without_keys(target, source, "path")


def mirror_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _trees(spark, sf_dir)
    return tm.mirror(source, target, MIRRORED)


def run_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _trees(spark, sf_dir)
    return tm.run_plan(source, target, "path", RULES)


def run_plan_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule per source, read from a table: even sources are mirrored, odd ones upserted."""
    source, target = _trees(spark, sf_dir)
    number = F.substr("source", F.lit(4)).cast("int")
    table = _table(spark, sf_dir, "documents").select("source").distinct().select(
        number.alias("seq"),
        F.concat("source", F.lit("/")).alias("prefix"),
        F.when(number % 2 == 0, "mirror").otherwise("upsert").alias("mode"),
    )
    return tm.run_plan(source, target, "path", tm.load_rules(table))


def run_plan_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed documents are named one by one and come first, whatever their scope."""
    source, target = _trees(spark, sf_dir)
    reviewed = source.filter(F.col("text").endswith(MARK)).select("path")
    return tm.run_plan(source, target, "path", RULES, required=reviewed)


def run_plan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _trees(spark, sf_dir)
    result = tm.run_plan(source, target, "path", RULES)
    changes = tm.diff(result, target, "path", keep_unchanged=True, digest=["text"], validate=False)
    return tm.change_summary(changes)


def _published(spark: SparkSession, sf_dir: str) -> str:
    """A store with the target as its first version and the plan's result as its second."""
    store = _scratch(spark)
    source, target = _trees(spark, sf_dir)
    how = {"keys": "path", "digest": ["text"]}
    first = tm.publish(target, store, "first import", "ann", 0, **how)
    latest = tm.read_latest(spark, store)
    result = tm.run_plan(source, latest, "path", RULES, validate="source")
    tm.publish(result, store, "apply rules", "ben", first, **how)
    return store


def read_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.read_latest(spark, _published(spark, sf_dir))


def publish_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.history(spark, _published(spark, sf_dir)).drop("published_at")


def scope_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One digest for all rows of each scope."""
    return tm.scope_digest(_source(spark, sf_dir), by=tm.scope_of().alias("scope"))


def patch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _trees(spark, sf_dir)
    return tm.make_patch(source, target, "path").select(
        "path", "change", F.lower(F.hex("before")).alias("before"), F.lower(F.hex("after")).alias("after"), "row.text"
    )


def apply_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the patch from target to source makes of the target: the source."""
    source, target = _trees(spark, sf_dir)
    return tm.apply_patch(target, tm.make_patch(source, target, "path"))


def compose_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the target over the source back to the target without its English documents, at once."""
    source, target = _trees(spark, sf_dir)
    last = target.filter("lang <> 'en'")
    there = tm.make_patch(source, target, "path")
    back = tm.make_patch(last, source, "path", validate=False)
    return tm.apply_patch(target, tm.compose_patches(there, back))


def _ranged(spark: SparkSession, sf_dir: str) -> str:
    """A store of key ranges: the target, then the same with one scope mirrored from the source."""
    store = _scratch(spark)
    source, target = _trees(spark, sf_dir)
    how = {"keys": "path", "rows_per_range": RANGE_ROWS}
    tm.publish_ranged(target, store, "first import", "ann", 0, **how)
    result = tm.mirror(source, target, ["src1/", "quarantine/"], validate=False)
    tm.publish_ranged(result, store, "mirror two scopes", "ben", 1, **how)
    return store


def diff_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions by their digest trees."""
    return tm.diff_versions(spark, _ranged(spark, sf_dir), 1, 2)


def diff_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The working tree against the newest version, of which only differing ranges are read."""
    store = _ranged(spark, sf_dir)
    return tm.diff_latest(_source(spark, sf_dir), store, rows_per_range=RANGE_ROWS)


def read_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.read_latest(spark, _ranged(spark, sf_dir))


def read_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two scopes of the newest version, from the files that can hold them."""
    return tm.read_latest(spark, _ranged(spark, sf_dir), scope=["src1/", "src12/"])


def publish_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version after a patch that turns one scope into the source's."""
    store = _ranged(spark, sf_dir)
    latest = tm.read_latest(spark, store)
    patch = tm.make_patch(tm.mirror(_source(spark, sf_dir), latest, "src7/", validate=False), latest, "path")
    tm.publish_patch(patch, store, "one more scope", "cid", 2, rows_per_range=RANGE_ROWS)
    return tm.read_latest(spark, store)


def scan_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes per top folder of a tree of text files, one folder per document source."""
    root = _scratch(spark) + "/tree"
    docs = _table(spark, sf_dir, "documents").select("source", "text")
    docs.write.partitionBy("source").text(root)
    files = tm.scan_files(spark, root).withColumn("scope", tm.scope_of())
    data = files.filter(F.col("path").endswith(".txt"))
    return data.groupBy("scope").agg(F.sum("length").alias("n_bytes"))


def scan_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a scanned tree against the lines of the documents that it was written from."""
    root = _scratch(spark) + "/tree"
    docs = _table(spark, sf_dir, "documents").select("source", "text")
    docs.write.partitionBy("source").text(root)
    files = tm.scan_files(spark, root, content=True, piece=PIECE).filter(F.col("path").endswith(".txt"))
    lines = files.select(
        tm.scope_of().alias("scope"),
        F.explode(F.split(F.expr("decode(substring(content, 1, octet_length(content) - 1), 'utf-8')"), "\n")).alias("line"),
    )
    return lines.groupBy("scope").agg(
        F.count("*").alias("n_lines"),
        F.count_distinct("line").alias("n_distinct"),
        F.min(F.sha2("line", 256)).alias("least"),
        F.max(F.sha2("line", 256)).alias("largest"),
    )


_QUERIES = [
    diff_summary,
    diff_by_scope,
    diff_changed_rows,
    diff_by_rule,
    folder_summary,
    diff_orders_rebuilt,
    diff_conversations,
    diff_embeddings,
    diff_maps,
    select_required,
    required_missing,
    scope_filter,
    row_digest,
    row_digest_columns,
    row_digest_vectors,
    duplicate_keys,
    null_keys,
    upsert,
    upsert_shuffled,
    without_keys,
    mirror_scope,
    run_plan,
    run_plan_loaded,
    run_plan_required,
    run_plan_summary,
    read_latest,
    publish_history,
    scope_digest,
    patch_rows,
    apply_patch,
    compose_patches,
    diff_versions,
    diff_latest,
    read_ranged,
    read_scope,
    publish_patch,
    scan_files,
    scan_content,
]


def entry(spark: SparkSession) -> DataFrame:
    """Changes between the two trees at the smallest scale, counted by scope."""
    return diff_by_scope(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {query.__name__: query for query in _QUERIES}
    if llm:
        found |= llm.queries()
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


# ---------------------------------------------------------------- DuckDB twins

_TREES = """
with src as (
  select concat(case when k.doc_id is not null then 'quarantine' else d.source end,
                '/', cast(d.doc_id as varchar)) as path,
         d.lang,
         case when d.n_chars < 400 then null
              when contains(d.text, '@') then concat(d.text, ' [reviewed]')
              else d.text end as text
  from documents d left join (select doc_id from labels where toxic = 1) k on k.doc_id = d.doc_id
), tgt as (
  select concat(case when lang = 'es' then 'inbox' else source end,
                '/', cast(doc_id as varchar)) as path,
         lang, case when n_chars >= 200 then text end as text
  from documents
)"""

_CHANGES = """, chg as (
  select coalesce(s.path, t.path) as path,
         case when t.path is null then 'added' when s.path is null then 'deleted'
              when s.text is distinct from t.text or s.lang is distinct from t.lang then 'modified'
              else 'unchanged' end as change
  from {source} s full outer join tgt t on s.path = t.path
)"""

_RESULT = """, res as (
  select * from src
  where split_part(path, '/', 1) in ('src1', 'quarantine', 'inbox', 'src2', 'src3'){named}
  union all
  select * from tgt
  where split_part(path, '/', 1) not in ('src1', 'quarantine', 'inbox')
    and path not in (
      select path from src where split_part(path, '/', 1) in ('src2', 'src3'){named})
)"""

_PLAN = _TREES + _RESULT.format(named="")

# a row digest: each column by name, behind its length, or as a digest, or a dash for null
_DIGEST = "left(sha256(concat({parts})), 32)"
_WIDE = "coalesce(sha256({0}), '-')"
_CONTENT = _DIGEST.format(parts=", ".join(_WIDE.format(c) for c in ("lang", "text")))
_ROW = _DIGEST.format(parts=", ".join(_WIDE.format(c) for c in ("lang", "path", "text")))

_MIRRORED = _TREES + """, res as (
  select * from src where split_part(path, '/', 1) in ({scopes})
  union all
  select * from tgt where split_part(path, '/', 1) not in ({scopes})
)"""


def oracle_sql() -> dict[str, str]:
    changes = _TREES + _CHANGES.format(source="src")
    plan_changes = _PLAN + _CHANGES.format(source="res")
    twins = {
        "diff_summary": changes + "select change, count(*) as n from chg group by change",
        "diff_by_scope": changes
        + """select split_part(path, '/', 1) as scope, change, count(*) as n
             from chg group by all""",
        "diff_changed_rows": changes + "select path, change from chg where change <> 'unchanged'",
        "diff_by_rule": """
            with paths as (
              select case when lang = 'fr' then '' else concat(source, '/', lang, '/') end as folder,
                     length(text) >= 400 as stays
              from documents
            )
            select case when folder = '' then '.'
                        when folder in ('src1/en/', 'src2/de/') then rtrim(folder, '/')
                        else split_part(folder, '/', 1) end as scope,
                   case when stays then 'unchanged' else 'deleted' end as change, count(*) as n
            from paths group by all""",
        "folder_summary": r"""
            with recursive leaf as (
              select case when lang = 'fr' then '' else concat(source, '/', lang, '/',
                       regexp_replace(cast(doc_id as varchar), '(.)', '\1/', 'g')) end as folder,
                     case when length(text) >= 400 then 'unchanged' else 'deleted' end as change, count(*) as n
              from documents group by all
            ), up as (
              select folder, change, n from leaf
              union all
              select regexp_replace(folder, '[^/]*/$', ''), change, n from up where folder <> ''
            )
            select folder, change, cast(sum(n) as bigint) as n from up group by all""",
        "diff_orders_rebuilt": """
            with built as (
              select l_orderkey, case when bool_and(l_linestatus = 'F') then 'F'
                                      when bool_and(l_linestatus = 'O') then 'O'
                                      else 'P' end as status
              from lineitem group by l_orderkey
            )
            select coalesce(l_orderkey, o_orderkey) as o_orderkey,
                   case when o_orderkey is null then 'added' when l_orderkey is null then 'deleted'
                        else 'modified' end as change
            from built full outer join orders on l_orderkey = o_orderkey
            where status is distinct from o_orderstatus""",
        "diff_conversations": """
            select conv_id, turn,
                   case when role = 'system' then 'deleted'
                        when contains(text, chr(10)) then 'modified' else 'unchanged' end as change
            from conversations""",
        "diff_embeddings": """
            select vec_id, case when label < 5 and list_reverse(embedding) <> embedding
                                then 'modified' else 'unchanged' end as change
            from embeddings""",
        "diff_maps": """
            select conv_id, case when bool_and(role = 'system') then 'deleted'
                                 when bool_or(role = 'system') then 'modified' else 'unchanged' end as change
            from conversations group by conv_id""",
        "select_required": """
            select * from documents where doc_id in (select doc_id from labels)""",
        "required_missing": _TREES
        + "select path from tgt where not exists (select 1 from src where src.path = tgt.path)",
        "scope_filter": _TREES + "select * from src where split_part(path, '/', 1) = 'src1'",
        "row_digest": "select doc_id, sha256(text) as digest from documents",
        "row_digest_columns": _TREES
        + """select path, sha256(concat(coalesce(sha256(lang), '-'),
                                       coalesce(sha256(text), '-'))) as digest from src""",
        "row_digest_vectors": """
            select min(vec_id) as vec_id, 2 * count(*) as n from embeddings group by embedding""",
        "duplicate_keys": """
            select l_orderkey, l_linenumber, count(*) as n from lineitem
            group by l_orderkey, l_linenumber having count(*) > 1""",
        "null_keys": """
            select o_orderkey, o_custkey from orders
            where o_orderkey not in (select l_orderkey from lineitem)""",
        "upsert": _TREES
        + """select * from src union all
             select * from tgt where not exists (select 1 from src where src.path = tgt.path)""",
        "upsert_shuffled": _TREES
        + """select * from src union all
             select * from tgt where not exists (select 1 from src where src.path = tgt.path)""",
        "without_keys": _TREES
        + "select * from tgt where not exists (select 1 from src where src.path = tgt.path)",
        "mirror_scope": _TREES
        + """select * from src where split_part(path, '/', 1) in ('src1', 'quarantine', 'inbox')
             union all
             select * from tgt where split_part(path, '/', 1) not in ('src1', 'quarantine', 'inbox')""",
        "run_plan": _PLAN + "select * from res",
        "run_plan_loaded": _TREES
        + """, rules as (
               select distinct source, cast(substr(source, 4) as int) % 2 = 0 as mirrored from documents
             ), s as (select src.* from src join rules on source = split_part(path, '/', 1))
             select * from s
             union all
             select tgt.* from tgt left join rules on source = split_part(tgt.path, '/', 1)
             where not coalesce(mirrored, false) and tgt.path not in (select path from s)""",
        "run_plan_required": _TREES
        + _RESULT.format(named=" or text like '% [reviewed]'")
        + "select * from res",
        "run_plan_summary": plan_changes + "select change, count(*) as n from chg group by change",
        "read_latest": _PLAN + "select * from res",
        "publish_history": plan_changes
        + """select 1::bigint as version, 0::bigint as parent, 'first import' as message,
                    'ann' as author, (select count(*) from tgt) as n_added,
                    0::bigint as n_modified, 0::bigint as n_deleted
             union all
             select 2, 1, 'apply rules', 'ben',
                    count(*) filter (where change = 'added'),
                    count(*) filter (where change = 'modified'),
                    count(*) filter (where change = 'deleted')
             from chg""",
        "scope_digest": _TREES
        + f""", d as (
               select split_part(path, '/', 1) as scope, {_ROW} as h from src
             ), s as (
               select scope, count(*) as n,
                      sum(cast(cast('0x' || h[1:16] as ubigint) as hugeint)) as high,
                      sum(cast(cast('0x' || h[17:32] as ubigint) as hugeint)) as low
               from d group by scope
             )
             select scope, n, concat(
               format('{{:016x}}', cast((high + low // 18446744073709551616) % 18446744073709551616 as ubigint)),
               format('{{:016x}}', cast(low % 18446744073709551616 as ubigint))) as digest
             from s""",
        "patch_rows": _TREES
        + f""", a as (select path, text, {_CONTENT} as h from src),
             b as (select path, {_CONTENT} as h from tgt)
             select coalesce(a.path, b.path) as path,
                    case when b.path is null then 'added' when a.path is null then 'deleted'
                         else 'modified' end as change,
                    b.h as before, a.h as after, a.text
             from a full outer join b on a.path = b.path where a.h is distinct from b.h""",
        "apply_patch": _TREES + "select * from src",
        "compose_patches": _TREES + "select * from tgt where lang <> 'en'",
        "diff_versions": _MIRRORED.format(scopes="'src1', 'quarantine'")
        + _CHANGES.format(source="res")
        + "select path, change from chg where change <> 'unchanged'",
        "diff_latest": _MIRRORED.format(scopes="'src1', 'quarantine'")
        + _CHANGES.format(source="src").replace("tgt", "res")
        + "select path, change from chg where change <> 'unchanged'",
        "read_ranged": _MIRRORED.format(scopes="'src1', 'quarantine'") + "select * from res",
        "read_scope": _MIRRORED.format(scopes="'src1', 'quarantine'")
        + "select * from res where split_part(path, '/', 1) in ('src1', 'src12')",
        "publish_patch": _MIRRORED.format(scopes="'src1', 'quarantine', 'src7'") + "select * from res",
        "scan_files": """
            select concat('source=', source) as scope, cast(sum(strlen(text) + 1) as bigint) as n_bytes
            from documents group by source""",
        "scan_content": """
            with l as (select source, unnest(string_split(text, chr(10))) as line from documents)
            select concat('source=', source) as scope, count(*) as n_lines,
                   count(distinct line) as n_distinct,
                   min(sha256(line)) as least, max(sha256(line)) as largest
            from l group by source""",
    }
    if llm:
        twins |= llm.oracle_sql()
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        twins["pipeline"] = corpus_pipeline.ORACLE_SQL
    return twins

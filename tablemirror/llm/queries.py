"""The registered queries of the numbered operators, and their DuckDB twins where SQL has one."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemirror.llm import (
    boosting,
    divergence,
    jaccard,
    language,
    packing,
    pieces,
    pii,
    quality,
    sharding,
    spelling,
    suffixes,
    topk,
    toxicity,
)

N_SHARDS = 40
WINDOW = packing.WINDOW


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """A public tokenizer's file; TABLEMIRROR_TOKENIZERS names another folder."""
    folder = os.environ.get("TABLEMIRROR_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def _fold(n: int) -> F.Column:
    """crc32 of the id as text, modulo n; a null id is in no fold and never learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_table(spark, sf_dir, "documents"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty highest inner products of every twentieth vector, against all others."""
    vectors = topk.integer_vectors(_table(spark, sf_dir, "embeddings"))
    found = topk.search(vectors, F.col("id") % 20 == 0)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data and of the terms that reveal it."""
    found = pii.spans(_table(spark, sf_dir, "documents"), "doc_id")

    def count(kind: int) -> F.Column:
        return F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS[:4])]
    base = F.sha2(pii.span_text("base").cast("binary"), 256)
    secret = pii.KINDS.index("secret")
    return found.select(
        "doc_id",
        *counts,
        base.alias("base_sha256"),
        pii.span_text("spans").alias("spans"),
        F.size(F.filter("spans", lambda span: span["kind"] == secret)).cast("long").alias("n_secret"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").filter(_fold(5) != 0))
    held_out = F.coalesce(_fold(5) == 0, F.lit(False))
    return toxicity.score(docs, model, "doc_id").select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.fit(docs, _fold(4) != 2)
    held_out = F.coalesce(_fold(4) == 2, F.lit(False))
    return language.predict(docs, model, "doc_id").select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op6_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty shards of equal row counts along a curve through source, language and size."""
    text = F.col("text").cast("binary")
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        "lang",
        (F.coalesce(F.length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
    )
    done = sharding.shards(rows, ["source", "lang", "size"], ["doc_id", "text_crc32"], N_SHARDS)
    return done.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "hilbert",
    )


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pieces.digests(docs, tokenizer_file("piece_bpe_32k.model"), "doc_id")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of repeated 400-byte strings, and the words in repeated passages of over 50 words."""
    return suffixes.removal(_table(spark, sf_dir, "documents"), "doc_id", words=suffixes.WORDS)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    forest = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.judge(docs, forest, "doc_id")


def packed(docs: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids in place of the ids."""
    import public_tokenizers

    tokens = packing.tokenise(
        docs,
        tokenizer_file("byte_bpe_50k.json"),
        tokenizer_file("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    return packing.pack(tokens, WINDOW).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"))


def op11_quality_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the quality classifier; labels of the held-out fold are never learned from."""
    docs = _table(spark, sf_dir, "documents")
    forest = boosting.fit(docs, _table(spark, sf_dir, "labels").filter(_fold(4) != 2))
    held_out = F.coalesce(_fold(4) == 2, F.lit(False))
    return boosting.score(docs, forest, "doc_id").select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the whole documents with the more frequent words that they are variants of."""
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language lie apart, in total and by term."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


_QUERIES = [
    op1_ngram_jaccard, op2_topk, op3_pii, op4_toxicity, op5_language, op6_hilbert_shards, op7_pieces,
    op8_suffix_dedup, op9_quality, op10_packing, op11_quality_boost, op12_spelling, op13_divergence,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


_TOPK = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as e
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, d.vec_id,
         cast(list_sum(list_transform(list_zip(q.e, d.e), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v d on q.vec_id <> d.vec_id where q.vec_id % 20 = 0
), r as (
  select query_id, vec_id, score,
         row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 20"""


_JACCARD = r"""
with recursive w as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents
), g as (
  select doc_id, list_distinct(case
      when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
  from w
), t as (select doc_id, unnest(s) as t from g),
p as (
  select a.doc_id as x, b.doc_id as y, count(*) as c
  from t a join t b on a.t = b.t and a.doc_id < b.doc_id group by a.doc_id, b.doc_id
), l as (
  select x, y from p join g a on a.doc_id = x join g b on b.doc_id = y
  where 100 * c >= 80 * (len(a.s) + len(b.s) - c)
), both_ways as (select x, y from l union all select y, x from l),
r as (
  select doc_id as x, doc_id as y from g
  union
  select r.x, e.y from r join both_ways e on r.y = e.x
)
select g.doc_id, cast(len(s) as bigint) as n_shingles, m.component_id
from g join (select x, min(y) as component_id from r group by x) m on m.x = g.doc_id"""


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# crc32 by its table, made from the polynomial; a pair of near words of one length shares what is
# left without one place, a pair of two lengths the shorter word
_SPELLING = (
    r"""
with recursive crc as (
  select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: xor(c >> 1, 3988292384 * (c & 1))) order by i) as t
  from (select unnest(range(256)) as i)
), occ as (
  select doc_id, unnest(regexp_extract_all("""
    + _LOWERED
    + r""", '[a-z\x{C0}-\x{FF}]+')) as run from documents
), runs as (
  select concat(doc_id, ':', run) as named, run, count(*) as k
  from occ where length(run) >= 6 group by doc_id, run
), summed as (
  select run, k, xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(named))),
      lambda i: cast('0x' || substr(hex(encode(named)), 2 * i + 1, 2) as bigint))),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) as h
  from runs, crc
), made as (
  select k, case when h % 199 = 0
                 then concat(substr(run, 1, cast(h % length(run) as int)), substr(run, cast(h % length(run) as int) + 2))
                 else run end as word
  from summed
), v as (
  select word, cast(sum(k) as bigint) as n from made where length(word) >= 6 group by word having sum(k) >= 5
), cut as (
  select word, i, concat(substr(word, 1, i), substr(word, i + 2)) as rest
  from (select word, unnest(range(length(word))) as i from v)
), near as (
  select a.word, b.word as other from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union
  select c.word, v.word from cut c join v on c.rest = v.word
  union
  select v.word, c.word from cut c join v on c.rest = v.word
), best as (
  select near.word, count(*) as n_near, min(struct_pack(o := -v.n, w := v.word)) as b
  from near join v on v.word = near.other group by near.word
), formed as (
  select v.word, v.n, coalesce(n_near, 0) as n_near,
         case when -b.o >= 5 * v.n then b.w end as form, case when -b.o >= 5 * v.n then -b.o end as form_n
  from v left join best on best.word = v.word
), chain as (
  select word, word as root from formed
  union all
  select chain.word, f.form from chain join formed f on f.word = chain.root where f.form is not null
), ends as (
  select chain.word, root from chain join formed f on f.word = chain.root where f.form is null
)
select formed.word, form, root, n, n_near, cast(form_n as bigint) as form_n
from formed join ends on ends.word = formed.word"""
)


_DIVERGENCE = (
    r"""
with t as (
  select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as d,
         regexp_extract_all("""
    + _LOWERED
    + r""", '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), o as (select lang, source, d, unnest(w) as term from t),
k as (select lang, term, count(*) as n from o group by all having count(distinct d) >= 3),
v as (select lang, cast(count(*) as hugeint) as size, cast(sum(n) as hugeint) as total from k group by lang),
g as (select distinct lang, source from t),
c as (select lang, source, term, count(*) as n from o semi join k using (lang, term) group by all),
s as (select lang, source, cast(sum(n) as hugeint) as total from c group by all),
p as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
         1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (coalesce(s.total, 0) + v.size) as p,
         1 + (1000000000::hugeint * (k.n + 1)) // (v.total + v.size) as q
  from g join k on k.lang = g.lang join v on v.lang = g.lang
  left join c on c.lang = g.lang and c.source = g.source and c.term = k.term
  left join s on s.lang = g.lang and s.source = g.source
), summed as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), every as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(value, 0) as bigint) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join summed m on m.lang = a.lang and m.source = a.source and m.item = b.source
  union all
  select lang, source, 'term', term, cast((p - q) * (p - q) // q as bigint) from p where n > 0 and p > q
), ranked as (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank
  from every
)
select * from ranked where part = 'pair' or rank <= 200"""
)


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_jaccard": _JACCARD,
        "op2_topk": _TOPK,
        "op12_spelling": _SPELLING,
        "op13_divergence": _DIVERGENCE,
    }

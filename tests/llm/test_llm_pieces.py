import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

import awkward
from tablemirror.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digests_equal_the_library(spark, library):
    pairs = awkward.rows()
    docs = awkward.documents(spark, pairs).unionByName(
        spark.read.parquet(f"{awkward.SF}/documents.parquet"), allowMissingColumns=True
    )
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = [*library.encode(r.text or ""), 2]
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    awkward.same_rows(pieces.digests(docs, MODEL, "doc_id").collect(), want)


def test_ids_and_texts(spark, library):
    docs = awkward.documents(spark)
    for r in pieces.encode(docs, MODEL, "text").collect():
        assert r.ids == [*library.encode(r.text or ""), 2]
        assert r.decoded == library.decode(r.ids)


def test_empty_table(spark):
    assert pieces.digests(awkward.documents(spark).limit(0), MODEL, "doc_id").collect() == []


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(" ▁ab\n\té ﬁ　€😀<s>/\x00.thing"), max_size=40), st.booleans())
def test_any_text(text, small):
    chunks = pieces.table(MODEL)
    if small:
        chunks.entries.clear()
    n, ids, plain = chunks.encode([text])[0]
    want = [*chunks.library.encode(text), 2]
    assert (n, ids, plain) == (len(want), " ".join(map(str, want)), chunks.library.decode(want))


def test_a_full_table_starts_anew(monkeypatch, library):
    monkeypatch.setattr(pieces, "MAX_CHUNKS", 10)
    monkeypatch.setattr(pieces, "MAX_TEXTS", 2)
    texts = [f"word{i} and w{i}" for i in range(50)]
    got = pieces.ChunkTable(MODEL).encode(texts)
    assert [g[1] for g in got] == [" ".join(map(str, [*library.encode(t), 2])) for t in texts]

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers

import awkward
from tablemirror.llm import packing, queries


@pytest.fixture(scope="module")
def library():
    own = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    return own


def check(rows, pairs, library, window=2048):
    """Every id in exactly one piece, sequences full but for the last, ids those of the library."""
    ids = [[*library.encode(t or "", add_special_tokens=False).ids, 1] for _, t in pairs]
    want = sorted((str(i), zlib.crc32(np.array(x, "<u4").tobytes()), len(x)) for (i, _), x in zip(pairs, ids))
    place = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    at = 0
    for r in place:
        assert (r.sequence_id, r.offset) == (at // window, at % window)
        assert r.offset + r.length <= window
        at += r.length
    assert at == sum(map(len, ids))
    whole = [r for r in rows if r.length == r.doc_tokens]
    cut = len({(r.doc_id, r.doc_tokens, r.sequence_id) for r in rows if r.start == 0})
    assert len([r for r in rows if r.start == 0]) == len(pairs) and cut
    for r in whole:
        assert (str(r.doc_id), r.ids_crc32, r.doc_tokens) in want


def test_awkward_documents(spark, library):
    pairs = awkward.rows()
    rows = queries.packed(awkward.documents(spark, pairs).repartition(3)).collect()
    check(rows, pairs, library)


def test_pieces_of_cut_documents_have_the_ids_of_the_library(spark, library):
    pairs = awkward.rows()[:-4]  # without repeated ids
    tokens = packing.tokenise(
        awkward.documents(spark, pairs), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
    )
    pieces = {}
    for r in packing.pack(tokens, 64).collect():
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, bytes(r.ids)))
    for i, t in pairs:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        found = sorted(pieces[(i, len(ids) // 4)])
        assert ids == b"".join(p for _, p in found)


def test_without_a_rank_file_the_library_itself(spark, library):
    pairs = awkward.rows()[:12]
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = {(r.doc_id, bytes(r.ids)) for r in packing.tokenise(awkward.documents(spark, pairs), path).collect()}
    assert got == {
        (i, np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for i, t in pairs
    }


def test_added_tokens_have_the_ids_of_the_library(spark):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))  # its defaults
    files = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>\n", "x<|endoftext|", "é <|endoftext|>€ " * 50]
    for own in (packing.tokenizer(*files, public_tokenizers.PATTERN), packing.tokenizer(files[0], None, None)):
        for text in texts:
            assert list(own.ids(text)) == library.encode(text, add_special_tokens=False).ids
    assert list(own.ids(texts[0])) == [64, 220, 50256, 275]
    pairs = list(enumerate(texts))
    check(queries.packed(awkward.documents(spark, pairs)).collect(), pairs, library)


def test_empty_table(spark):
    assert queries.packed(awkward.documents(spark).limit(0)).collect() == []


def test_both_tokenizers_agree(library):
    rng = random.Random(2)
    own = packing.tokenizer(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    letters = " ▁ab\n\té ﬁ　€😀<|endoftext|>\x00.'ll thing\x85\x1c"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        assert list(own.ids(text)) == library.encode(text, add_special_tokens=False).ids

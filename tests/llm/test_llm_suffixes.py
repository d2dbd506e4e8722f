import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import awkward
import corpus_pipeline
from tablemirror.llm import passages, suffixes


def expected(pairs):
    plain = awkward.without_repeats([t for _, t in pairs])
    return [
        (i, len((t or "").encode()), removed, runs, hashlib.sha256(kept).hexdigest())
        for (i, t), (kept, removed, runs) in zip(pairs, plain)
    ]


@pytest.mark.parametrize("group", [suffixes.GROUP, 1])
def test_awkward_documents(spark, monkeypatch, group):
    """With a group of one every gram is hot, and all is settled by the finer grams."""
    monkeypatch.setattr(suffixes, "GROUP", group)
    pairs = awkward.rows()
    got = suffixes.removal(awkward.documents(spark, pairs), "doc_id").collect()
    awkward.same_rows(got, expected(pairs))


def test_passages_shared_by_many(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "GROUP", 5)
    passages = ["".join(chr(97 + (i * k + k) % 23) for i in range(n)) for k, n in ((7, 399), (11, 400), (5, 430))]
    pairs = [
        (i, f"{i:03d}" * 150 + passages[i % 3] + f"{i * 7919:06d}" * 80) for i in range(40)
    ]
    got = suffixes.removal(awkward.documents(spark, pairs), "doc_id").collect()
    awkward.same_rows(got, expected(pairs))


def test_texts_without_their_repeats(spark):
    pairs = awkward.rows()
    docs = awkward.documents(spark, pairs)
    kept = suffixes.without_repeats(docs)
    assert kept.columns == docs.columns
    plain = awkward.without_repeats([t for _, t in pairs])
    want = [
        (i, None if t is None else k.decode("utf-8", "ignore")) for (i, t), (k, _, _) in zip(pairs, plain)
    ]
    awkward.same_rows(kept.select("doc_id", "text").collect(), want)


def test_passages_of_over_fifty_words_in_the_pipeline(spark):
    """Planted passages of 50 to 60 words, all under 400 bytes; some with other blanks in a copy."""
    rng = np.random.default_rng(12)
    word = lambda size: "".join(rng.choice(list("abcdefghij"), size))
    pairs, passages = [], []
    for k, (n, size) in enumerate([(50, 5), (51, 1), (51, 2), (51, 5), (55, 4), (60, 5)]):
        passages.append([word(size) for _ in range(n)])
        for copy in range(2):
            body = ("\n " if copy else " ").join(passages[-1])
            assert len(" ".join(passages[-1])) < 400
            pairs.append((2 * k + copy, f"é{word(9)} {word(40)} {body} {word(40)} {word(9)}"))
    pairs += [(90, None), (91, ""), (92, "short")]
    docs = awkward.documents(spark, pairs)
    out = corpus_pipeline.repeated_passages(spark, docs, "")
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert len(got) == len(pairs)
    for i, t in pairs:
        if i < 2 or i >= 90:  # fifty words stay
            assert got[i][0] == t
        else:
            w = t.split()
            assert got[i] == (f"{w[0]} {w[1]}  {w[-2]} {w[-1]}", 103)
    rows = suffixes.removal(docs, "doc_id").collect()
    assert not any(r.n_removed for r in rows)  # the query stays at 400 bytes


@pytest.mark.parametrize("group", [passages.GROUP, 1])
def test_passages_of_over_fifty_words_are_counted(spark, monkeypatch, group):
    """Planted passages of 50 to 60 words and under 400 bytes in three texts each, with other blanks in a copy;
    a passage twice in one text; copies of a text; words of any length. Clean texts count nothing."""
    monkeypatch.setattr(passages, "GROUP", group)
    rng = np.random.default_rng(8)
    fresh = lambda n, size=5: ["".join(rng.choice(list("abcdefghij"), size)) for _ in range(n)]
    texts = []
    for n, size in [(50, 5), (51, 1), (51, 5), (60, 5), (52, 3)]:
        passage = fresh(n, size)
        for copy in range(3):
            body = ("\n " if copy == 1 else " ").join(passage)
            texts.append(f"é{' '.join(fresh(9))} {body} {' '.join(fresh(70))}")
    planted = len(texts)
    texts += [" ".join(fresh(200)) for _ in range(6)]
    twice = " ".join(fresh(51, 4))
    texts += [f"{twice} {fresh(1)[0]} {twice}\t", "a " * 60, " ".join(fresh(55, 17)), None, "", "short \r"]
    texts += [" ".join(fresh(51, 30))] * 2
    want = awkward.passage_words(texts)
    assert [p for p, _ in want[:planted]] == [0] * 3 + [51] * 6 + [60] * 3 + [52] * 3
    assert not any(p for p, _ in want[planted : planted + 6])
    pairs = list(enumerate(texts))
    got = suffixes.removal(awkward.documents(spark, pairs), "doc_id", words=suffixes.WORDS)
    awkward.same_rows(got.select("doc_id", "n_passage_words", "n_passages").collect(), [(i, *p) for i, p in enumerate(want)])
    awkward.same_rows(got.drop("n_passage_words", "n_passages").collect(), expected(pairs))


def test_words_of_awkward_documents(spark):
    pairs = awkward.rows()
    got = suffixes.removal(awkward.documents(spark, pairs), "doc_id", words=suffixes.WORDS)
    awkward.same_rows(got.drop("n_passage_words", "n_passages").collect(), expected(pairs))
    want = awkward.passage_words([t for _, t in pairs])
    awkward.same_rows(got.select("doc_id", "n_passage_words", "n_passages").collect(), [(i, *p) for (i, _), p in zip(pairs, want)])
    assert suffixes.removal(awkward.documents(spark).limit(0), "doc_id", words=suffixes.WORDS).collect() == []


def test_the_stage_still_removes_repeats_of_400_bytes(spark):
    pairs = awkward.rows()[:12]
    docs = awkward.documents(spark, pairs)
    plain = {r.doc_id: r.text for r in suffixes.without_repeats(docs).collect()}
    for r in suffixes.without_passages(docs).collect():
        assert len(r.text or "") <= len(plain[r.doc_id] or "")
    unbroken = [(i, f"{i}" * 9 + "abcdefghij" * 3 + "".join(chr(97 + (k * k) % 23) for k in range(450)) + f"{i}" * 9) for i in (1, 2)]
    same = awkward.documents(spark, unbroken)
    awkward.same_rows(suffixes.without_passages(same).select("text").collect(), suffixes.without_repeats(same).select("text").collect())
    assert suffixes.without_passages(docs.limit(0)).collect() == []


def test_empty_table(spark):
    docs = awkward.documents(spark).limit(0)
    assert suffixes.removal(docs, "doc_id").collect() == []
    assert suffixes.without_repeats(docs).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab", min_size=1, max_size=200), st.sampled_from([8, 16, 400]))
def test_suffix_array_and_common_prefixes(text, depth):
    data = np.frombuffer(text.encode(), np.uint8)
    raw = text.encode()
    order = suffixes.suffix_array(data, depth)
    assert sorted(order.tolist()) == list(range(len(raw)))
    heads = [raw[i : i + depth] for i in order]
    assert heads == sorted(heads)
    found = suffixes.common_prefixes(data, order, depth)
    for r in range(1, len(order)):
        a, b = raw[order[r - 1] :][:depth], raw[order[r] :][:depth]
        same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert found[r] == same


def test_pieces_of_a_long_text_have_the_windows_of_the_whole(monkeypatch):
    rng = np.random.default_rng(4)
    text = rng.integers(97, 100, 5000).astype(np.uint8).tobytes()
    whole = list(suffixes._anchors_of([(0, 0, text)], 400))
    starts = [s for a in whole for s in range(a[1], a[2] + 1)]
    assert starts == list(range(len(text) - 399))
    parts = [(0, s, text[s : s + 1000 + 399]) for s in range(0, len(text) - 399, 1000)]
    of_window = lambda found: {s: (a[3], a[4]) for a in found for s in range(a[1], a[2] + 1)}
    assert of_window(suffixes._anchors_of(parts, 400)) == of_window(whole)


def test_a_text_that_repeats_itself_gives_few_rows(spark):
    """Else every word of such texts is a row of the same gram, all in one task."""
    texts = [f"{i} " + "over again " * 900 + f"{i}" for i in range(12)] + ["x" * 3000] * 3
    pairs = list(enumerate(texts))
    docs = awkward.documents(spark, pairs)
    keyed = docs.selectExpr("unhex(md5(text)) AS key", "CAST(text AS binary) AS bytes").coalesce(1)
    found = suffixes.anchors(keyed, words=suffixes.WORDS).collect()
    assert len(found) < 400
    for kind, n in ((False, sum(len(t) - 399 for t in texts)), (True, sum(len(t.split()) - 50 for t in texts[:12]))):
        own = [r for r in found if r.words == kind]
        once = sum(r.high - r.low + 1 for r in own if r.times == 1)
        assert once + sum(r.times > 1 for r in own) <= n
        assert all(r.times != 1 for r in own if r.high - r.low > 700)
    got = suffixes.removal(docs, "doc_id", words=suffixes.WORDS)
    awkward.same_rows(got.drop("n_passage_words", "n_passages").collect(), expected(pairs))
    want = awkward.passage_words(texts)
    awkward.same_rows(got.select("doc_id", "n_passage_words", "n_passages").collect(), [(i, *p) for i, p in enumerate(want)])


def test_every_window_of_words_has_one_anchor(monkeypatch):
    """Equal windows have equal grams at equal distances; parts of a long text give what the whole gives."""
    rng = np.random.default_rng(5)
    passage = b" ".join(rng.choice([b"ab", b"a-word-of-many-bytes", b"c"], 90).tolist())
    texts = [b"", b"x \t" + passage + b" y", passage + b"\n z", b"two words", passage.replace(b" ", b" \r"), b"a " * 70]
    runs = [awkward.WORD.findall(t.decode()) for t in texts]

    def of_window():
        out = {}
        for d, low, high, at, gram, _, _, start, size in zip(*(c.tolist() for c in passages.anchors(texts, 51))):
            assert awkward.WORD.findall(texts[d][start : start + size].decode()) == runs[d][low : high + 51]
            for k in range(low, high + 1):
                assert (d, k) not in out
                out[d, k] = (at - k, gram)
        return out

    whole = of_window()
    assert sorted(whole) == [(d, k) for d, run in enumerate(runs) for k in range(len(run) - 50)]
    by_words: dict = {}
    for (d, k), found in whole.items():
        assert by_words.setdefault(tuple(runs[d][k : k + 51]), found) == found
    monkeypatch.setattr(passages, "_WORDS", 7)
    monkeypatch.setattr(passages, "_BYTES", 30)
    assert of_window() == whole

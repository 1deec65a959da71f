import hashlib
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stayscope.llm import sentence_pieces as s
from stayscope.llm.queries import op2_sentencepiece
from tests.llm.samples import awkward, empty

P = pytest.importorskip("public_tokenizers")
SF_DIR = "/root/testdata/sf0.001"
PATH = P.path("piece_bpe_32k.model")
V = s.read_vocabulary(PATH)
PARTS = ["a", "the", " ", "  ", "▁", "é", "\n", "\t", "日本", "🦄", "</s>", "<0x0A>", "ing", "x" * 40, "\x00", "ﬁ"]


def ours(text):
    return [i for seg in V.segments(text) for i in V.encoded(seg)] + [V.end_id]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_equals_the_library(text):
    ids = V.library.encode(text, add_eos=True)
    assert ours(text) == ids
    assert V.decoded(ids) == V.library.decode(ids)


def test_any_ids_decode_as_the_library_does():
    rng = random.Random(4)
    for _ in range(3000):
        ids = [rng.randrange(1, 300) for _ in range(rng.randint(1, 10))]
        assert V.decoded(ids) == V.library.decode(ids)


def test_unsplit_vocabulary_gives_the_same(monkeypatch):
    text = "one  two three\nfour ▁ five"
    split = ours(text)
    monkeypatch.setattr(V, "splits", False)
    assert ours(text) == split


@pytest.mark.parametrize("check", ["segments", "texts"])
def test_awkward_rows(spark, check):
    docs = awkward(spark, {"ids": "clash", "decoded": 1, "t": 2})
    rows = s.decode(s.encode(docs, PATH, check=check), PATH).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.ids == V.library.encode(r.text or "", add_eos=True)
        assert r.decoded == V.library.decode(r.ids) == (r.text or "") and r.t == 2


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_query_equals_the_library(spark):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for _ in range(2):  # the second run meets the workers' memory
        for r in op2_sentencepiece(spark, SF_DIR).collect():
            ids = V.library.encode(texts[r.doc_id], add_eos=True)
            written = digest(" ".join(map(str, ids))), digest(V.library.decode(ids))
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), *written)


def test_empty_table(spark):
    assert s.decode(s.encode(empty(spark), PATH), PATH).count() == 0


def test_a_difference_stops_the_job():
    known = s.Segments(V)
    known["two"], known.fresh = b"\x05\x00\x00\x00", ["two"]
    with pytest.raises(ValueError, match="differs"):
        known.check()


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(s, "MEMORY_SEGMENTS", 3)
    known = s.Segments(V)
    for text in ("a b c d e", "f g", "a b"):
        assert b"".join(map(known.__getitem__, V.segments(text)))
        known.check()
        assert len(known) <= 3


WORD = st.text(max_size=40) | st.lists(st.sampled_from([*PARTS, "\ud800", "er", "in", "aaa"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(WORD, max_size=30, unique=True))
def test_side_by_side_equals_one_by_one(words):
    assert dict(V.encoded_many(words)) == {w: V.packed(w) for w in words}


def test_equal_ranks_merge_leftmost_first():
    for n in range(1, 34):
        word = "a" * n
        assert dict(V.encoded_many([word, "b" + word])) == {w: V.packed(w) for w in (word, "b" + word)}


def test_new_words_of_a_batch_are_merged_together(monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choices("etaoinshrdlu\n", k=rng.randint(1, 20))) for _ in range(500)]
    calls = []
    monkeypatch.setattr(V, "merged", lambda characters: calls.append(characters) or pytest.fail("one by one"))
    [packed] = s._encoder(s.Segments(V), "segments")([" ".join(["x", *words, "x"])])
    assert not calls and len(packed) > 4 * len(words)

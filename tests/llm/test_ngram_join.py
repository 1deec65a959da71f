import random
import re

import numpy as np
import pytest

from stayscope.llm import ngram_join as nj
from stayscope.llm.hashing import BY_WHITE, Words, window_hashes
from tests.llm.samples import awkward, empty, invented

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(id, set size, component) of each row; rows of one id are one document."""
    sets = [(doc, shingles(text)) for doc, text in rows]
    parent = {doc: doc for doc, _ in rows if doc is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, sa) in enumerate(sets):
        for b, sb in sets[:i]:
            if a is not None and b is not None and sa and sb and 100 * len(sa & sb) >= 80 * len(sa | sb):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted(((d, len(s), root(d) if d is not None else None) for d, s in sets), key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        at = rng.randrange(len(words))
        rng.choice([words.insert, words.__setitem__])(at, f"new{rng.randrange(99)}")
    return " ".join(words)


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    texts = []
    for text in invented(seed, 30, rng.choice([6, 20, 80])):
        text = " ".join(text.split()[: rng.randint(1, 80)])
        texts += [text] + [edited(rng, text, rng.randint(0, 3)) for _ in range(rng.randint(0, 4))]
    passage = invented(99, 1, 50)[0]
    texts += [passage + " " + x for x in invented(seed + 50, 25, 15)]
    chain = texts[0].split() + ["tail"] * 40
    for k in range(12):  # each links to its neighbours only
        chain = chain[1:] + [f"c{k}"]
        texts.append(" ".join(chain))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    assert result(nj.near_duplicates(docs)) == brute(rows)


def test_awkward_rows(spark):
    docs = awkward(spark, {"n": 1, "key": 2, "node": 3, "component_id": 4})
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(nj.near_duplicates(docs)) == brute(rows)
    assert nj.near_duplicates(empty(spark)).count() == 0


def test_rows_of_one_id_unite(spark):
    a, b, c = invented(8, 3, 30)
    rows = [(5, a), (5, b), (3, a), (9, b), (7, c), (1, c)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(nj.near_duplicates(docs)) == brute(rows)


@pytest.mark.parametrize("low,high", [(1, 60), (60, 900)])
def test_linked_sets_share_a_key(low, high):
    rng = np.random.default_rng(low)
    heat = np.zeros(nj.SLOTS, dtype=np.uint8)
    heat[rng.integers(0, nj.SLOTS, nj.SLOTS // 3)] = 3
    linked = 0
    for _ in range(3000):
        n = int(rng.integers(low, high))
        pool = rng.integers(0, 2**63, 2 * n + 4).astype(np.uint64)
        kept = int(rng.integers(max(1, int(0.8 * n)), n + 1))
        grown = int(rng.integers(0, max(0, int(kept / 0.8 + 1e-9) - n) + 1))
        a, b = set(pool[:n].tolist()), set(pool[:kept].tolist()) | set(pool[n : n + grown].tolist())
        if 100 * len(a & b) >= 80 * len(a | b):
            linked += 1
            keys = [nj.keys_of(np.unique(np.array(list(s), dtype=np.uint64)), heat) for s in (a, b)]
            assert len(np.intersect1d(*keys))
    assert linked > 1000


def test_every_size_lies_in_its_band():
    for n in range(1, 5000):
        assert nj.lowest(nj.band_of(n)) <= n < nj.lowest(nj.band_of(n) + 1)


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, 101), (103, 101), (200, 200)]
    got = {r.node: r.root for r in nj.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {k: 1 for k in range(2, 61)} | {101: 100, 103: 100}
    assert {k: v for k, v in got.items() if k != v} == want


def test_words_and_windows():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choices(["a", "B", " ", "\n", "é", "\x00", "\x0b", "zz", "日", "\xa0"], k=rng.randint(0, 40)))
        want = [re.sub("[A-Z]", lambda m: m[0].lower(), w).encode() for w in WORD.findall(text)]
        words = Words(text, BY_WHITE)
        assert [words.joined(i, i + 1).replace(b"\xff", b"\0") for i in range(len(words))] == want
        assert len(set(zip(want, words.hashes.tolist()))) == len(set(want)) == len(set(words.hashes.tolist()))
        wide = window_hashes(words.hashes, 3).tolist()
        grams = [tuple(want[i : i + 3]) for i in range(len(want) - 2)]
        assert len(set(zip(grams, wide))) == len(set(grams)) == len(set(wide))

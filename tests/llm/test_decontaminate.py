import random
import re

import pytest

from stayscope.llm import decontaminate as d
from tests.llm.samples import awkward, empty, invented

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (holders := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= holders
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def result(found):
    return sorted(
        ((r.doc_id, r.n_words, sum(x.end - x.start for x in r.hit_words), r.hit_items) for r in found.collect()), key=repr
    )


@pytest.fixture(scope="module")
def sample(spark):
    rng = random.Random(7)
    items = list(enumerate(invented(1, 12, 25))) + [(50, "Only THREE words"), (51, ""), (52, None), (0, "again zero")]
    docs = []
    for k, text in enumerate(invented(2, 40, 80)):
        if k % 3 == 0:
            source = rng.choice(items[:12])[1].split()
            at = rng.randrange(len(source) - 9)
            text += ". " + ", ".join(source[at : at + rng.randint(8, 14)]).upper() + " " + text
        if k % 5 == 0:
            text += "\nonly... three WORDS!"
        docs.append((k, text))
    return docs, items


@pytest.mark.parametrize("block", [250_000, 60])
def test_equals_brute_force_in_one_block_or_many(spark, sample, block):
    docs, items = sample
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert result(d.scan(df, bench, block_windows=block)) == brute(docs, items)


def test_span_removal(spark, sample):
    docs, items = sample
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    cleaned = d.decontaminate(df, bench, action="span")
    assert cleaned.columns == df.columns
    hit = {r[0] for r in brute(docs, items) if r[2]}
    for r in cleaned.collect():
        text = dict(docs)[r.doc_id]
        assert (r.text == text) == (r.doc_id not in hit)
    kept = d.decontaminate(df, bench)
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in docs} - hit


def test_awkward_rows(spark):
    docs = awkward(spark, {"n_words": 3, "hit_items": "x", "c0": 1, "t": "y"})
    bench = spark.createDataFrame([(1, "a second text under"), (None, "and another")], "item_id bigint, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # The brute force names a null id "None"; the scan leaves it out of the items.
    want = brute(rows, [(1, "a second text under"), (None, "and another")])
    assert result(d.scan(docs, bench)) == sorted(
        [(doc, n, hit, [x for x in found if x != "None"]) for doc, n, hit, found in want], key=repr
    )
    assert d.scan(empty(spark), bench).count() == 0
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert d.decontaminate(docs, nothing).count() == docs.count()

import re

import pytest

from stayscope.llm import license_scan as ls
from tests.llm.samples import awkward, empty, invented


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(ls.BETWEEN_WORDS, lowered) if w]


def brute(rows, templates=ls.TEMPLATES, containment=0.8):
    """Templates held, by trying every window."""
    out = {}
    for k, (_, notice) in enumerate(templates):
        w = words_of(notice)
        wanted = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        length = ls.size_class(len(w) - 4)
        for doc, text in rows:
            w = words_of(text)
            shingles = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
            for at in range(0, len(shingles), length):
                share = len(wanted & set(shingles[at : at + 2 * length])) / len(wanted)
                if share >= containment:
                    out[doc, k] = max(share, out.get((doc, k), 0))
    return out


@pytest.fixture(scope="module")
def rows():
    texts = invented(3, 60, 70)
    notices = [t for _, t in ls.TEMPLATES]
    out = []
    for k, text in enumerate(texts):
        notice = notices[k % len(notices)].split()
        if k % 4 == 1:  # one word changed
            notice[len(notice) // 2] = "changed"
        if k % 4 == 2:  # the middle left out
            notice = notice[: len(notice) // 3] + notice[2 * len(notice) // 3 :]
        at = (k * 7) % 60
        words = text.split()
        out.append((k, " ".join(words[:at] + notice + words[at:])))
    return out


@pytest.mark.parametrize("literal", [ls.LITERAL_SHINGLES, 0])
def test_equals_every_window(spark, rows, literal, monkeypatch):
    monkeypatch.setattr(ls, "LITERAL_SHINGLES", literal)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.template): r.containment for r in ls.scan(docs).collect()}
    assert got == pytest.approx(brute(rows)) and len(got) > 20


def test_bands_reach_the_chance():
    for length in (4, 8, 16, 32, 64):
        fewest = 1 if length == 4 else length // 2 + 1
        for m in range(fewest, length + 1):
            held = -(-8 * m // 10)
            similarity = held / (2 * length + m - held)
            assert (1 - similarity) ** ls.bands(length) <= 1e-6 * 1.01


def test_awkward_rows(spark):
    docs = awkward(spark, {"template": 1, "license": "x", "words": 2})
    assert ls.scan(docs).count() == 0
    assert ls.scan(empty(spark)).count() == 0
    notice = "Released under the MIT License"
    same = spark.createDataFrame([(1, notice), (1, notice), (None, notice)], "doc_id bigint, text string")
    assert sorted((r.doc_id or 0, r.license) for r in ls.scan(same).collect()) == [(0, "MIT"), (1, "MIT")]


def test_short_templates_are_refused(spark):
    with pytest.raises(ValueError, match="fewer than"):
        ls.scan(empty(spark), [("short", "four words are few")])

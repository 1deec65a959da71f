import hashlib
import random
import re

import numpy as np
import pytest

from stayscope.llm import pii
from stayscope.llm.crf import Chain
from tests.llm.samples import awkward, empty


def brute(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        if 14 <= len(d) <= 19 and sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out)


def base(text):
    raw = text.encode()
    return sorted(pii.in_code_points(raw, pii.base_spans(raw)))


def test_base_spans_equal_plain_expressions():
    rng = random.Random(3)
    parts = [*"0123456789", "+1", " ", "-", ".", "(", ")", "@", "a.b", "é", "x", "com", "4111111111111111"]
    parts += ["192.168.1.1", "\n", "..", "@@", "+49 30 1234567"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 22)))
        assert base(text) == brute(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000):
        pii.base_spans(text.encode())


def path_score(chain, x, tags):
    score = chain.first[tags[0]] + chain.emissions(x)[np.arange(len(tags)), tags].sum()
    return score + sum(chain.pairs[a, b] for a, b in zip(tags, tags[1:]))


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(2)
    chain = Chain(["A", "B", "C"], {f"f{k}": k for k in range(6)})
    chain.unary[:] = rng.normal(size=chain.unary.shape)
    chain.pairs[:], chain.first[:] = rng.normal(size=(3, 3)), rng.normal(size=3)
    sequences = [rng.integers(0, 7, size=(n, 2)) for n in (1, 5, 3, 7, 5)]
    for x, best in zip(sequences, chain.decode(sequences, batch=2)):
        paths = np.array(np.meshgrid(*[range(3)] * len(x))).reshape(len(x), -1).T
        scores = [path_score(chain, x, p) for p in paths]
        assert list(best) == list(paths[int(np.argmax(scores))])


def test_fit_follows_the_gradient_of_the_likelihood():
    rng = np.random.default_rng(4)
    sequences = [rng.integers(0, 4, size=(n, 1)) for n in (3, 4, 2, 4)]
    labels = [(s[:, 0] % 2).astype(np.int64) for s in sequences]

    def likelihood(chain):
        total = 0.0
        for x, y in zip(sequences, labels):
            paths = np.array(np.meshgrid(*[range(2)] * len(x))).reshape(len(x), -1).T
            total += path_score(chain, x, y) - np.log(sum(np.exp(path_score(chain, x, p)) for p in paths))
        return total

    chain = Chain(["A", "B"], {str(k): k for k in range(4)})
    start = likelihood(chain)
    chain.fit(sequences, labels, 60, 1e-4)
    assert start < -8 and likelihood(chain) > -0.5


HELD_OUT = [
    ("please call (212) 321-7788 before ten", "crf_phone", "(212) 321-7788"),
    ("mail bob at example dot org today", "crf_email", "bob at example dot org"),
    ("ssn 111-22-3333 was on the form", "crf_id", "111-22-3333"),
    ("ring 555-222-1111 now", "crf_phone", "555-222-1111"),
    ("in 2021 there were 512 cases in 14 towns", None, None),
    ("chapter 4 of 12 on page 300", None, None),
    ("version 3.2 cost 29.99 in 2020", None, None),
]


@pytest.mark.parametrize("text,kind,found", HELD_OUT)
def test_field_on_held_out_lines(text, kind, found):
    spans = [(k, text[a:b]) for k, a, b in pii.field_spans([text], pii.train([]))[0]]
    assert spans == ([(kind, found)] if kind else [])


def test_awkward_rows(spark):
    docs = awkward(spark, {"spans": "clash", "n_ip": 4})
    rows = [(9, "é +1 (375) 555-4393 and fakol.33@mail7.example.com, 54.158.173.199 4207051279108084", "en", "", 0)]
    docs = docs.union(spark.createDataFrame(rows, docs.schema))
    for r in pii.scan(docs).collect():
        want = brute(r.text or "")
        written = [f"{k}:{a}:{b}" for k, a, b in sorted(want, key=lambda x: (x[1], pii.KINDS.index(x[0])))]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(r.spans.split(",")) | {""}
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x[0] for x in want) for k in pii.BASE_KINDS)
    assert pii.scan(empty(spark)).count() == 0

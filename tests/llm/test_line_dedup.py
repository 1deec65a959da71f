import random
import re
from collections import defaultdict

from stayscope.llm import line_dedup
from tests.llm.samples import awkward, empty


def brute(rows, min_chars=20, min_documents=3):
    """Kept text per row of (id, text), rows of one id being one document."""

    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        kept = []
        for line in (text or "").split("\n"):
            ids = holders[key(line)]
            known = [i for i in ids if i is not None]
            repeated = len(key(line)) >= min_chars and len(ids) >= min_documents and known
            if not repeated or (doc is not None and doc == max(known)):
                kept.append(line)
        out.append((doc, len((text or "").split("\n")), len((text or "").split("\n")) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def check(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = line_dedup.dedup_lines(docs)
    found = [(r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got.collect()]
    assert sorted(found, key=repr) == brute(rows)
    return got


def test_awkward_rows_with_clashing_columns(spark):
    got = check(spark, awkward(spark, {"h1": 1, "pos": 2, "row": "x", "doc": "y", "held": "z"}))
    assert {r.row for r in got.select("row").collect()} == {"x"}


def test_random_documents(spark):
    rng = random.Random(5)
    pool = [f"shared line number {k} of the pool" for k in range(30)] + ["short", "", " Shared Line number 3 of the pool"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 150)))) for i in range(60)]
    check(spark, spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_hot_line_and_nulls(spark):
    rows = [(i if i % 3 else None, "one line that everybody repeats\nown %d" % i) for i in range(300)]
    check(spark, spark.createDataFrame(rows, "doc_id bigint, text string"))
    only_null = [(None, "one line that everybody repeats %s" % "") for _ in range(4)]
    got = check(spark, spark.createDataFrame(only_null, "doc_id bigint, text string"))
    assert {r.n_dropped for r in got.collect()} == {0}


def test_empty_table(spark):
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_first_occurrences_stream_from_one_sort(spark):
    rows = [(d, 0, pos, h, h) for d in (None, 1, 2) for h in range(5) for pos in (7, 3, 9)]
    lines = spark.createDataFrame(rows, "doc bigint, row bigint, pos int, h1 bigint, h2 bigint")
    first = line_dedup.first_occurrences(lines)
    plan = first._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert len(re.findall(r"\bSort \[", plan)) == 1
    assert re.findall(r"\bExchange (\w+)", plan) == ["rangepartitioning"]
    assert re.search(r"Sort \[h1#\w+ ASC NULLS FIRST, h2#\w+ ASC NULLS FIRST, doc#\w+ ASC NULLS FIRST, pos#", plan)
    found = sorted(((r.doc or 0, r.h1, r.pos) for r in first.collect()))
    assert found == sorted((d or 0, h, 3) for d in (None, 1, 2) for h in range(5))

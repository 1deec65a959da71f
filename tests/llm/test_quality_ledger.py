import re
from collections import Counter


from stayscope.llm import quality_ledger as q
from tests.llm.samples import awkward, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines),
        len(lines) - len(set(lines)),
        len(hit),
    )


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def test_measurements_equal_brute_force(spark):
    docs = awkward(spark, {"n_words": 7, "failed_rules": 9, "w": 1})
    extra = [(100 + k, "a b c " * k + "a b\na b\na b #|" * (k % 3), "en", 7, 9, 1) for k in range(12)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    for r in q.ledger(docs).collect():
        assert tuple(r[c] for c in COLUMNS) == brute(r.text)
        assert r.w == 1


def test_policy_keeps_rows_and_columns(spark):
    docs = awkward(spark, {"failed_rules": 9})
    kept = q.apply_policy(docs, q.Policy("none", ()))
    assert kept.columns == docs.columns and sorted(map(repr, kept.collect())) == sorted(map(repr, docs.collect()))
    assert {r.doc_id for r in q.apply_policy(docs).collect()} == set()


def test_ablation_counts(spark):
    bits = q.BIT
    rows = [(0,), (bits["few_words"],), (bits["few_words"] | bits["repeated_words"],), (bits["symbol_heavy"],)]
    got = {r.rule: r for r in q.ablation(spark.createDataFrame(rows, "failed_rules bigint"), q.BASE).collect()}
    few = got["few_words"]
    assert (few.n_failed, few.n_only, few.n_kept_without) == (2, 1, 3)
    assert got["repeated_words"].n_only == 0


def test_empty_table(spark):
    assert q.ledger(empty(spark)).count() == 0
    assert q.ablation(q.ledger(empty(spark))).count() == 0


def test_bits_do_not_move():
    assert [q.BIT[name] for name, _ in q.RULES] == [1 << i for i in range(len(q.RULES))]

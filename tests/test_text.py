import re

import pytest
from pyspark.sql import functions as F

from stayscope.functions import text as tx
from stayscope.operators import notes as nt


def clean(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(tx.clean_text(F.col("t"))).collect()]


def test_cleaning_passes(spark):
    found = clean(spark, "BP 120/80, a b c d|e", "x2y été−1 tab\tkept", "one a two", "", "a lone")
    # Only lone letters between spaces go, and two passes leave the fourth of a run.
    assert found[0].split() == ["BP", "d|e"]
    assert found[1].split() == ["été", "tab", "kept"]
    assert found[2] == "one two" and found[3] == "" and found[4] == "a lone"


def test_digit_words_match_the_plain_pattern(spark):
    words = ["a1", "1a", "éa1b", "__9", "no", "x-1", "a1é2", "12", "abc def9ghi jkl"]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    both = df.select(
        F.regexp_replace("t", tx.WORD_WITH_DIGIT, "#"), F.regexp_replace("t", r"\w*\d\w*", "#")
    )
    assert all(r[0] == r[1] for r in both.collect())


def test_tokens_and_stop_words(spark):
    df = spark.createDataFrame([("  The  Cat sat ",)], "t string")
    row = df.select(
        tx.tokens(F.col("t")),
        tx.tokens(F.col("t"), ["THE"]),
        tx.without_stop_words(F.array(F.lit("The"), F.lit("cat")), ["the"]),
    ).collect()[0]
    assert list(row) == [["the", "cat", "sat"], ["cat", "sat"], ["cat"]]


def test_notes_in_order_give_the_whole_text(spark):
    data = [("hot" if i % 3 == 0 else f"e{i % 7}", i, f"note {i} of text" if i % 11 else None) for i in range(120)]
    data.append(("long", 0, "x" * 17_000_000))
    data.append(("long", 1, "tail"))
    notes = spark.createDataFrame(data, "id string, seq int, text string").repartition(5)
    expected, found = {}, {}
    for who, _, text in data:
        expected.setdefault(who, []).append(text or "")
    for r in nt.concat_notes(notes, ["seq"]).orderBy("id", "position").collect():
        assert r["position"] == len(found.setdefault(r["id"], []))
        assert r["start_char"] == sum(len(t) + 1 for t in found[r["id"]])
        found[r["id"]].append(r["text"])
    assert found == expected


def test_cutoffs_are_limited_by_a_clear_error(spark):
    with pytest.raises(ValueError, match="cutoffs"):
        nt.term_counts_grid(None, None, [f"c{k}" for k in range(64)])


def test_term_counts_of_notes_equal_those_of_the_joined_text(spark):
    data = [("a", "x fine"), ("a", "pain b"), ("a", "c fine 12"), ("b", "pain")]
    notes = spark.createDataFrame(data, "id string, text string")
    found = {(r["id"], r["term"]): r["n"] for r in nt.term_counts(notes, inner=True).collect()}
    assert found == {("a", "fine"): 2, ("a", "pain"): 1, ("b", "pain"): 1}
    stats = nt.corpus_stats(nt.term_counts(notes, inner=True)).collect()[0]
    assert tuple(stats) == (2, 3, 4)


def test_vocabulary_orders_by_count_then_name_and_is_cut(spark):
    counts = spark.createDataFrame(
        [("a", "x", 3), ("b", "x", 1), ("a", "y", 4), ("a", "z", 9), ("b", "w", 1)],
        "id string, term string, n long",
    )
    full = {r["term"]: r["idx"] for r in nt.vocabulary(counts).collect()}
    assert full == {"z": 0, "x": 1, "y": 2, "w": 3}
    cut = nt.vocabulary(counts, size=2)
    assert {r["term"] for r in cut.collect()} == {"z", "x"} and nt.dropped_terms(counts, cut) == 2
    assert {r["term"] for r in nt.vocabulary(counts, min_documents=2).collect()} == {"x"}
    vectors = {r["id"]: r["features"] for r in nt.note_vectors(counts, cut).collect()}
    assert vectors["a"].toArray().tolist() == [9.0, 3.0] and vectors["b"].indices.tolist() == [1]


def test_topics(spark):
    data = [(f"d{i}", ("heart beat pulse " if i % 2 else "lung air breath ") * 5) for i in range(12)]
    counts = nt.term_counts(spark.createDataFrame(data, "id string, text string"))
    vocab = nt.vocabulary(counts)
    vectors = nt.note_vectors(counts, vocab)
    model = nt.fit_topics(vectors, k=2, iterations=10)
    weights = nt.topic_weights(model, vectors)
    sums = weights.groupBy("id").agg(F.sum("value").alias("s")).collect()
    assert len(sums) == 12 and all(r["s"] == pytest.approx(1.0) for r in sums)
    assert {r[0] for r in weights.select("feature").distinct().collect()} == {"topic-0", "topic-1"}
    assert nt.topic_weights(model, vectors, top=1).count() == 12
    terms = nt.topic_terms(model, vocab, 3).collect()
    assert len(terms) == 6 and all(re.fullmatch(r"[a-z]+", r["term"]) for r in terms)

"""Passes that leave most of a text alone must not match it."""

import re

from pyspark.sql import functions as F

from stayscope.functions import text as tx
from stayscope.sources import delimited


def test_spaces_are_not_replaced_by_spaces():
    assert re.search(tx.PUNCTUATION, "plain words only") is None
    assert re.sub(tx.PUNCTUATION, " ", "a,b  c_d") == "a b  c d"


def test_words_with_digits_are_taken_whole(spark):
    texts = ["a1 b é2x cafe 3", "x9y9 zz_1 é1", "abc abcd1", "1", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    old = rows.selectExpr(r"regexp_replace(text, '(?<!\\w)[A-Za-z_]*\\d\\w*', ' ') AS t")
    new = rows.select(F.regexp_replace("text", tx.WORD_WITH_DIGIT, " ").alias("t"))
    assert [r.t for r in new.collect()] == [r.t for r in old.collect()]


def test_headers_are_checked_without_a_shuffle_of_all_lines(spark, tmp_path, monkeypatch):
    (tmp_path / "one.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    (tmp_path / "two.csv").write_text("a,b\n3,w\n")
    plans = []
    joined = delimited._joined

    def seen(lines, numbered):
        plans.append(lines.join(numbered, delimited._PLACE)._jdf.queryExecution().toString())
        return joined(lines, numbered)

    monkeypatch.setattr(delimited, "_joined", seen)
    table = delimited.read_multiline_table(spark, str(tmp_path), view="pair")
    assert sorted(r.a for r in table.collect()) == ["1", "2", "3"]
    assert len(plans) == 2 and "strategy=broadcast" in plans[1]

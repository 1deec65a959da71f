"""Records with quoted line breaks: well-formed files in full, stray quotes set apart, nothing lost."""

import csv
import io
import random

import pytest

from stayscope.sources import delimited


def read(spark, path, **options):
    table = delimited.read_multiline_table(spark, str(path), view="quoted", **options)
    rows = sorted(map(tuple, table.collect()))
    return rows, [r["record"] for r in spark.table("quoted_rejects").collect()]


@pytest.fixture(params=["300b", "1m"])
def split_size(spark, request):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    yield request.param
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_two_stray_quotes_far_apart(spark, tmp_path):
    lines = [f"{i},text {i}" for i in range(10_000)]
    lines[500] = '500,"text 500'
    lines[9_500] = '9500,text 9500"'
    (tmp_path / "far.csv").write_text("id,text\n" + "\n".join(lines) + "\n")
    rows, rejects = read(spark, tmp_path / "far.csv")
    assert len(rows) >= 9_998 and len(rows) + len(rejects) == 10_000
    assert rejects == ['500,"text 500'] and ("501", "text 501") in rows and ("9499", "text 9499") in rows


def test_random_well_formed_files(spark, tmp_path, split_size):
    draw = random.Random(split_size)
    parts = ["a", "b c", ",", ", ", "\n", "\n", '"', '""', " ", "x,y,z", "12\" pipe", "", "\r\n", "end"]
    rows = []
    for i in range(120):
        rows.append([str(i), *("".join(draw.choices(parts, k=draw.randint(0, 7))) for _ in range(3)), "z"])
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL if split_size == "1m" else csv.QUOTE_MINIMAL)
    writer.writerows([["id", "a", "b", "c", "d"], *rows])
    (tmp_path / "f.csv").write_bytes(out.getvalue().encode())
    found, rejects = read(spark, tmp_path / "f.csv", odd_quotes="reject")
    assert rejects == [] and [r[0] for r in found] == sorted(r[0] for r in rows)

    def letters(text):  # quotes, commas and white space are rewritten
        return "".join(c for c in text or "" if c.isalnum())

    want = {r[0]: [letters(x) for x in r] for r in rows}
    assert {r[0]: [letters(x) for x in r] for r in found} == want


def test_a_stray_quote_before_quoted_records(spark, tmp_path, split_size):
    good = [f'{i},"text, {i}\nmore {i}",x{i}' for i in range(1, 80)]
    good[40] = '41,"stray,x41'
    good[60] = '61,fine 5" wide,x61'
    (tmp_path / "f.csv").write_text("id,text,k\n" + "\n".join(good) + "\n")
    rows, rejects = read(spark, tmp_path / "f.csv", odd_quotes="reject")
    assert len(rows) == 78 and rejects == ['41,"stray,x41']
    assert ("61", 'fine 5" wide', "x61") in rows and ("42", "text; 42 more 42", "x42") in rows


def test_a_quote_that_never_closes(spark, tmp_path, split_size):
    (tmp_path / "f.csv").write_text('id,text\n1,a\n2,"b\n' + "".join(f"{i},c\n" for i in range(3, 40)))
    with pytest.raises(ValueError, match="odd number of quotes in .*f.csv"):
        delimited.read_multiline_table(spark, str(tmp_path / "f.csv"), view="quoted")
    rows, rejects = read(spark, tmp_path / "f.csv", odd_quotes="reject")
    assert len(rows) == 38 and rejects == ['2,"b']


def test_several_stray_quotes_in_a_row(spark, tmp_path):
    lines = ['1,"a', '2,"b', "3,c", '4,"d', '5,"e"', "6,f"]
    (tmp_path / "f.csv").write_text("id,text\n" + "\n".join(lines) + "\n")
    rows, rejects = read(spark, tmp_path / "f.csv", odd_quotes="reject")
    assert rows == [("3", "c"), ("5", "e"), ("6", "f")] and sorted(rejects) == ['1,"a', '2,"b', '4,"d']


def test_records_over_the_limits_are_set_apart(spark, tmp_path):
    long = '2,"' + "\n".join(f"line {i}" for i in range(50)) + '"'
    (tmp_path / "f.csv").write_text(f"id,text\n1,a\n{long}\n3,b\n")
    rows, rejects = read(spark, tmp_path / "f.csv")
    assert len(rows) == 3 and rejects == []
    for limit in ({"max_lines": 20}, {"max_chars": 200}):
        rows, rejects = read(spark, tmp_path / "f.csv", **limit)
        assert [r[0] for r in rows] == ["1", "3"] and len(rejects) == 50


def test_lines_that_flip_or_reset_the_state(spark, tmp_path, split_size):
    text = 'id,a,b\n1,"x\n","y"\n2,"\n","\n"\n"3\n",p,"q"\n4,"u","v\nw"\n5,r,s\n'
    (tmp_path / "f.csv").write_text(text)
    rows, rejects = read(spark, tmp_path / "f.csv")
    assert rejects == [] and sorted(r[0].strip() for r in rows) == ["1", "2", "3", "4", "5"]

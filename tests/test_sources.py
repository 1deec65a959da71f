import datetime as dt

import pytest
from pyspark.sql import functions as F

from stayscope.functions import dates, values
from stayscope.sources import clinical, delimited, libsvm, sinks, stop_words

OPEN = dt.datetime(9000, 1, 1)
FILES = {
    "PATIENTS.csv": """"ROW_ID","SUBJECT_ID","GENDER","DOB","DOD","DOD_HOSP","DOD_SSN","EXPIRE_FLAG"
1,9,m,1950-01-01 00:00:00,2020-01-03 05:00:00,,,1
2,10,"M",1960-06-01 00:00:00,2020-01-09 00:00:00,,,0
3,11,F,1970-01-01 00:00:00,,,,1
""",
    "ICUSTAYS.csv": """SUBJECT_ID,HADM_ID,ICUSTAY_ID,INTIME,OUTTIME
9,1,1,2020-01-01 00:00:00,2020-01-04 00:00:00
10,2,2,2020-01-01 12:00:00,
""",
    "SAPSII.csv": "subject_id,hadm_id,icustay_id,"
    + ",".join(clinical.schemas.SCORE_FEATURES)
    + "\n9,9,1,"
    + ",".join(["1.5"] * 17)
    + "\n9,10,2,"
    + ",".join(["2.5"] * 16)
    + ",\n",
    "EHCOMORBIDITIES.csv": "subject_id,hadm_id,"
    + ",".join(clinical.schemas.FLAG_COLUMNS)
    + "\n9,10,"
    + ",".join(["1"] + ["0"] * 28)
    + ",\n",
    "LABEVENTS.csv": """SUBJECT_ID,HADM_ID,ITEMID,CHARTTIME,VALUE,VALUENUM
9,1,50800,2020-01-01 06:00:00,"1,5",4.0
9,1,50800,2020-01-01 07:00:00,x,
9,1,50800,2020-01-03 07:00:00,x,100
10,1,,2020-01-01 07:00:00,x,1
""",
    "DIAGNOSES_ICD.csv": """SUBJECT_ID,HADM_ID,SEQ_NUM,ICD9_CODE
9,1,1,4280
9,1,,4280
10,1,2,
11,1,3,V10
""",
    "PRESCRIPTIONS.csv": """SUBJECT_ID,HADM_ID,STARTDATE,ENDDATE,DRUG
9,1,2020-01-01 00:00:00,2020-01-02 00:00:00,Aspirin
9,1,,2020-01-05 00:00:00,Aspirin
9,1,,,Heparin
""",
    "NOTEEVENTS.csv": (
        '"SUBJECT_ID","HADM_ID","CHARTDATE","CHARTTIME","CATEGORY","DESCRIPTION","TEXT"\n'
        '9,1,2020-01-01,,"Nursing","x","Pt said ""fine, ok""\r\n\n  \nlungs clear, x 12mg"\n'
        '9,1,2020-01-01,2020-01-01 03:00:00,"Nursing","x","lungs wet a b"\n'
        '9,1,2020-01-01,2020-01-02,"Discharge Summary","x","gone"\n'
        '10,1,2020-01-03,2020-01-01,"ECG","x","sinus rhythm"\n'
    ),
    "icu_mortality_test_patients.csv": "SUBJECT_ID\n10\n77\n",
    "CHARTEVENTS.csv": "SUBJECT_ID,CHARTTIME\n9,2020-01-01 00:00:00\n",
}


@pytest.fixture(scope="module")
def directory(tmp_path_factory):
    folder = tmp_path_factory.mktemp("study")
    for name, text in FILES.items():
        (folder / name).write_bytes(text.encode())
    return str(folder)


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_entities(spark, directory):
    found = by_id(clinical.load_entities(spark, directory))
    assert found["9"]["is_male"] and found["10"]["is_male"] and not found["11"]["is_male"]
    assert found["9"]["dod"] == dt.datetime(2020, 1, 3, 5)
    assert found["10"]["dod"] == OPEN and found["10"]["is_dead"] == 0.0
    assert found["11"]["dod"] == OPEN and found["11"]["is_dead"] == 1.0


def test_open_stays_sort_last(spark, directory):
    assert by_id(clinical.load_episodes(spark, directory))["10"]["out_ts"] == OPEN


def test_blank_numbers(spark, directory):
    scores = clinical.load_scores(spark, directory).orderBy("episode_id").collect()
    assert scores[0]["sapsii"] == 1.5 and scores[1]["admissiontype_score"] == 0.0
    flags = clinical.load_flags(spark, directory).collect()[0]
    assert flags["congestive_heart_failure"] == 1.0 and flags["depression"] == 0.0
    labs = clinical.load_labs(spark, directory).orderBy("ts").collect()
    assert [(r["value"], r["measured"]) for r in labs if r["code"]] == [
        (4.0, True),
        (0.0, False),
        (100.0, True),
    ]


def test_dates_of_events(spark, directory):
    drugs = clinical.load_medications(spark, directory).collect()
    assert sorted((r["ts"].year, r["code"]) for r in drugs) == [
        (1900, "Heparin"),
        (2020, "Aspirin"),
        (2020, "Aspirin"),
    ]
    codes = clinical.load_diagnoses(spark, directory).collect()
    assert {r["ts"] for r in codes} == {dt.datetime(1900, 1, 1)}
    assert sorted(r["sequence"] for r in codes) == [0, 1, 2, 3]


def test_notes(spark, directory):
    notes = clinical.load_notes(spark, directory).orderBy("id", "ts").collect()
    assert [(r["id"], r["ts"]) for r in notes] == [
        ("10", dt.datetime(2020, 1, 1)),
        ("9", dt.datetime(2020, 1, 1)),
        ("9", dt.datetime(2020, 1, 1, 3)),
    ]
    assert notes[1]["text"] == "Pt said fine; ok  lungs clear; x 12mg"


def test_all_tables_and_counts(spark, directory):
    loaded = clinical.load_all(spark, directory, holdout=True)
    counts = {r["table_name"]: r["n_rows"] for r in clinical.row_counts(loaded).collect()}
    assert counts == {
        "entities": 3, "episodes": 2, "scores": 2, "flags": 1, "labs": 4,
        "diagnoses": 4, "medications": 3, "notes": 3, "holdout_ids": 2,
    }
    assert set(clinical.load_all(spark, directory, False, False, False, False).tables()) == {
        "entities", "episodes",
    }
    assert clinical.load_chart_events(spark, directory).count() == 1


def test_multiline_records_across_many_splits(spark, tmp_path):
    """The record repair gives the same rows however small the splits are."""
    lines = ['id,text']
    for i in range(300):
        body = "\n".join(f"line {i} {j}, x" for j in range(i % 4 + 1))
        lines.append(f'{i},"{body}"' if i % 3 else f"{i},plain {i}")
    (tmp_path / "long.csv").write_text("\n".join(lines) + "\n")
    path = str(tmp_path / "long.csv")
    whole = delimited.read_csv_table(spark, path, multiline=True)
    flat = whole.select("id", values.flatten_field(F.col("text")).alias("text"))
    expected = sorted(map(tuple, flat.collect()))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("512b", "1k", "1m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            table = delimited.read_multiline_table(spark, path, view="long_text")
            assert sorted(map(tuple, table.collect())) == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_stray_quotes_and_headers(spark, tmp_path):
    (tmp_path / "odd.csv").write_text('ID,TEXT\n1,"a\n' + "".join(f"{k},b\n" for k in range(2, 60)))
    with pytest.raises(ValueError, match="odd.csv"):
        delimited.read_multiline_table(spark, str(tmp_path / "odd.csv"))
    # Two stray quotes are even: the record between them has a wrong number of fields.
    (tmp_path / "even.csv").write_text('ID,ICU STAY,TEXT\n1,x,a"\n2,y,b\n3,z,"c\n4,w,d\nID,ICU STAY,TEXT\n5,v,e"f,g"\n')
    table = delimited.read_multiline_table(spark, str(tmp_path / "even.csv"), view="even")
    rows = {r["ID"] for r in table.collect()}
    bad = {r["record"] for r in spark.table("even_rejects").collect()}
    assert rows | {b.split(",")[0] for b in bad} >= {"4", "5"} and "ID" in rows
    lost = {"1", "2", "3"} - rows
    assert all(any(f"{k}," in b or f"{k};" in b for b in [*bad, *map(str, table.collect())]) for k in lost)


def test_part_files_with_another_header_are_an_error(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "p1.csv").write_text("a,b\n1,2\n")
    (folder / "p2.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        delimited.read_csv_table(spark, str(folder), view="parts").collect()
    with pytest.raises(ValueError, match="headers"):
        delimited.read_multiline_table(spark, str(folder), view="parts")


def test_predictions_keep_every_id(spark, tmp_path):
    ids = ["3000000000", "12", "abc", "9", "00A", "123456789012345678901"]
    scored = spark.createDataFrame([(i, 0.5) for i in ids], "id string, score double")
    rows = [r["SUBJECT_ID"] for r in sinks.prediction_rows(scored).collect()]
    assert rows == ["9", "12", "3000000000", "123456789012345678901", "00A", "abc"]


def test_quoted_commas(spark):
    lines = spark.createDataFrame([('1,"a, b ""c""",d',)], "value string")
    assert delimited.clean_quoted_lines(lines).collect()[0]["value"] == '1,"a; b  c ",d'


def test_cleaned_lines_are_parsed(spark):
    lines = spark.createDataFrame([('1,"a, b ""c""",d',), ("2,x",)], "record string")
    cleaned = delimited.clean_quoted_lines(lines, "record")
    rows = delimited.parse_records(cleaned, ["id", "text", "last"], header=False).collect()
    assert [tuple(r) for r in rows] == [("1", "a; b  c ", "d")]


def test_table_names(spark):
    paths = ["/d/PATIENTS.csv", "events", "/d/x.csv.gz", "/d/odd-", "s3://b/lab_2.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    names = [r[0] for r in df.select(delimited.table_name_from_path(F.col("path"))).collect()]
    assert names == ["PATIENTS", "events", "gz", "/d/odd-", "lab_2"]


def test_parsing(spark):
    texts = ["2020-01-02 03:04:05", " 2020-01-02 ", "", None, "2020-02-30 00:00:00", "soon"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    strict = [r[0] for r in df.select(dates.parse_timestamp(F.col("t"))).collect()]
    mixed = [r[0] for r in df.select(dates.parse_mixed_timestamp(F.col("t"))).collect()]
    moment = dt.datetime(2020, 1, 2, 3, 4, 5)
    assert strict == [moment, None, None, None, None, None]
    assert mixed == [moment, dt.datetime(2020, 1, 2), None, None, None, None]


def test_stop_word_files(spark, tmp_path):
    (tmp_path / "words.txt").write_text("pt, Mg,\nmg , pt,l\ness\n")
    words = stop_words.read_stop_words(spark, str(tmp_path / "words.txt"))
    assert {r["word"] for r in words.collect()} == {"pt", "Mg", "mg", "l", "ess", ""}
    assert stop_words.read_stop_words(spark, "").count() == 0
    with pytest.raises(ValueError):
        stop_words.word_list(words, limit=2)


def test_libsvm_round_trip_keeps_width(spark, tmp_path):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(1.0, Vectors.sparse(9, [0, 4], [1.0, 0.0]))], ["label", "features"])
    for _ in range(2):  # the second write replaces the first
        sinks.write_libsvm(df, str(tmp_path / "m"))
    back = libsvm.read_libsvm(spark, str(tmp_path / "m"), 9).collect()
    assert len(back) == 1 and back[0]["features"].size == 9
    entries = libsvm.read_libsvm_entries(spark, str(tmp_path / "m")).collect()
    assert [tuple(r) for r in entries] == [(1.0, 0, 1.0), (1.0, 4, 0.0)]


def test_counts_observed_while_storing(spark):
    some = spark.range(7).withColumnRenamed("id", "n_rows").repartition(3)
    none = spark.createDataFrame([], "id string")
    stored, counts = clinical.store_counted(clinical.Inputs(some, none, notes=some.where("n_rows > 4")))
    assert {tuple(r) for r in counts.collect()} == {("entities", 7), ("episodes", 0), ("notes", 2)}
    assert stored.entities.count() == 7 and stored.episodes.count() == 0 and stored.scores is None

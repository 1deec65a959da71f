"""Readers and writers, run over CSV, text and LIBSVM files derived from the tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stayscope.functions import dates, values
from stayscope.sources import clinical, delimited, sinks, stop_words
from stayscope.storage import new_path
from stayscope.workload import roles
from stayscope.workload.registry import query


_FLAT = r"""replace(regexp_replace(regexp_replace(
      replace(replace({0}, '"', ' '), '  ', ' '), '\n(?:[ \t\r]*\n)+', chr(10), 'g'),
      '\r?\n', ' ', 'g'), ',', ';')"""


def _second(ts: Column) -> Column:
    return F.substring(ts.cast("string"), 1, 19)


def write_csv(df, path: str) -> str:
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("emptyValue", "").option("nullValue", "").csv(path)
    return path


def _events(spark, sf_dir, *kinds):
    events = roles.table(spark, sf_dir, "events")
    return events.filter(F.col("event_type").isin(list(kinds))) if kinds else events


def _subject() -> Column:
    return F.col("user_id").cast("string").alias("SUBJECT_ID")


def _code(modulus: int | None = None) -> Column:
    code = F.get_json_object("props", "$.k").cast("int")
    return (code if modulus is None else code % modulus).cast("string")


def patients_csv(spark, sf_dir, directory):
    """The flag does not always agree with the terminal date; the loader has to sort it out."""
    late = (F.col("event_type") == "purchase") & (
        F.col("ts") >= dates.timestamp_lit("2024-01-20 00:00:00")
    )
    users = _events(spark, sf_dir).groupBy("user_id").agg(
        F.min(F.when(late, F.col("ts"))).alias("died")
    )
    born = dates.timestamp_lit("1950-01-01 00:00:00") + F.make_dt_interval(
        (100 * (F.col("user_id") % 250)).cast("int")
    )
    sex = F.element_at(F.array(F.lit("M"), F.lit("F"), F.lit("m")), (F.col("user_id") % 3 + 1).cast("int"))
    rows = users.select(
        _subject(),
        sex.alias("GENDER"),
        _second(born).alias("DOB"),
        _second(F.col("died")).alias("DOD"),
        (F.col("user_id") % 3 != 0).cast("int").cast("string").alias("EXPIRE_FLAG"),
    )
    write_csv(rows, f"{directory}/PATIENTS.csv")


def stays_csv(spark, sf_dir, directory):
    """Every seventh stay is still open."""
    out = F.when(F.col("event_id") % 7 != 0, _second(dates.plus_hours(F.col("ts"), 48)))
    rows = _events(spark, sf_dir, "signup").select(
        _subject(),
        F.col("event_id").cast("string").alias("ICUSTAY_ID"),
        _second(F.col("ts")).alias("INTIME"),
        out.alias("OUTTIME"),
    )
    write_csv(rows, f"{directory}/ICUSTAYS.csv")


def labs_csv(spark, sf_dir, directory):
    """Every fifth measurement has no value."""
    rows = _events(spark, sf_dir, "error").select(
        _subject(),
        F.col("event_id").cast("string").alias("HADM_ID"),
        _code(20).alias("ITEMID"),
        _second(F.col("ts")).alias("CHARTTIME"),
        F.when(F.col("event_id") % 5 != 0, F.col("value").cast("string")).alias("VALUENUM"),
    )
    write_csv(rows, f"{directory}/LABEVENTS.csv")


def codes_csv(spark, sf_dir, directory):
    rows = _events(spark, sf_dir, "click").select(
        _subject(),
        F.col("event_id").cast("string").alias("HADM_ID"),
        F.when(F.col("event_id") % 4 != 0, (F.col("event_id") % 9).cast("string")).alias("SEQ_NUM"),
        _code().alias("ICD9_CODE"),
    )
    write_csv(rows, f"{directory}/DIAGNOSES_ICD.csv")


def drugs_csv(spark, sf_dir, directory):
    """A third of the rows lack the start date, a sixth both dates."""
    k = F.col("event_id") % 6
    rows = _events(spark, sf_dir, "view").select(
        _subject(),
        F.col("event_id").cast("string").alias("HADM_ID"),
        F.when(k > 1, _second(F.col("ts"))).alias("STARTDATE"),
        F.when(k > 0, _second(dates.plus_days(F.col("ts"), 3))).alias("ENDDATE"),
        _code(10).alias("DRUG"),
    )
    write_csv(rows, f"{directory}/PRESCRIPTIONS.csv")


def notes_csv(spark, sf_dir, directory):
    """Documents as notes: date-only and missing chart times, several categories, line breaks."""
    k = F.col("doc_id") % 4
    day = F.concat(F.lit("2024-01-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"))
    charted = F.when(k == 1, day).when(k == 2, F.concat(day, F.lit(" 07:30:00")))
    category = F.when(k == 3, F.lit("Discharge Summary")).otherwise(F.lit("Nursing"))
    rows = roles.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("SUBJECT_ID"),
        F.col("source").alias("HADM_ID"),
        day.alias("CHARTDATE"),
        charted.alias("CHARTTIME"),
        category.alias("CATEGORY"),
        F.col("lang").alias("DESCRIPTION"),
        F.col("text").alias("TEXT"),
    )
    write_csv(rows, f"{directory}/NOTEEVENTS.csv")


def scores_csv(spark, sf_dir, directory):
    """Order lines in the shape of the score file; every eleventh line lacks its price."""
    lines = roles.scores(spark, sf_dir)
    shaped = {"sapsii": "l_quantity", "sapsii_prob": "l_discount", "age_score": "l_tax"}
    missing = F.col("l_partkey") % 11 == 0
    cells = []
    for column in clinical.schemas.SCORE_FEATURES:
        if column == "hr_score":
            cell = F.when(~missing, F.col("l_extendedprice"))
        elif column in shaped:
            cell = F.col(shaped[column])
        else:
            cell = F.lit(None)
        cells.append(cell.cast("string").alias(column))
    rows = lines.select(
        F.col("id").cast("string").alias("subject_id"),
        F.col("admission_id").alias("hadm_id"),
        F.col("episode_id").alias("icustay_id"),
        *cells,
    )
    write_csv(rows, f"{directory}/SAPSII.csv")


def flags_csv(spark, sf_dir, directory):
    rows = roles.flags(spark, sf_dir)
    shaped = {"congestive_heart_failure": "is_urgent", "hypertension": "is_open", "depression": "is_large"}
    cells = [
        (F.col(shaped[c]) if c in shaped else F.lit(None)).cast("string").alias(c)
        for c in clinical.schemas.FLAG_COLUMNS
    ]
    out = rows.select(
        F.col("id").cast("string").alias("subject_id"), F.col("admission_id").alias("hadm_id"), *cells
    )
    write_csv(out, f"{directory}/EHCOMORBIDITIES.csv")


def holdout_csv(spark, sf_dir, directory):
    ids = roles.holdout_ids(spark, sf_dir).select(F.col("id").cast("string").alias("SUBJECT_ID"))
    write_csv(ids, f"{directory}/icu_mortality_test_patients.csv")


def chart_csv(spark, sf_dir, directory):
    rows = _events(spark, sf_dir, "purchase").select(_subject(), _second(F.col("ts")).alias("CHARTTIME"))
    write_csv(rows, f"{directory}/CHARTEVENTS.csv")


_PATIENTS_SQL = """
users AS (
  SELECT user_id,
    min(CASE WHEN event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-20 00:00:00' THEN ts END) AS died
  FROM events GROUP BY user_id)"""


@query(
    "load_entities",
    f"""WITH {_PATIENTS_SQL}
    SELECT CAST(user_id AS VARCHAR) AS id, user_id % 3 <> 1 AS is_male,
      TIMESTAMP '1950-01-01 00:00:00' + INTERVAL (100 * (user_id % 250)) DAY AS dob,
      CASE WHEN user_id % 3 <> 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS is_dead,
      CASE WHEN user_id % 3 <> 0 AND died IS NOT NULL THEN date_trunc('second', died)
           ELSE TIMESTAMP '9000-01-01 00:00:00' END AS dod,
      TIMESTAMP '1971-01-01 00:00:00' AS index_ts, CAST(0 AS DOUBLE) AS age
    FROM users""",
)
def load_entities(spark, sf_dir):
    directory = new_path(spark, "csv")
    patients_csv(spark, sf_dir, directory)
    return clinical.load_entities(spark, directory)


@query(
    "load_holdout_ids",
    "SELECT DISTINCT CAST(user_id AS VARCHAR) AS id FROM events WHERE user_id % 5 = 0",
)
def load_holdout_ids(spark, sf_dir):
    directory = new_path(spark, "csv")
    holdout_csv(spark, sf_dir, directory)
    return clinical.load_holdout_ids(spark, directory)


@query(
    "load_episodes",
    """SELECT CAST(user_id AS VARCHAR) AS id, CAST(event_id AS VARCHAR) AS episode_id,
      date_trunc('second', ts) AS in_ts,
      CASE WHEN event_id % 7 <> 0 THEN date_trunc('second', ts) + INTERVAL 48 HOUR
           ELSE TIMESTAMP '9000-01-01 00:00:00' END AS out_ts
    FROM events WHERE event_type = 'signup'""",
)
def load_episodes(spark, sf_dir):
    directory = new_path(spark, "csv")
    stays_csv(spark, sf_dir, directory)
    return clinical.load_episodes(spark, directory)


@query(
    "load_chart_events",
    """SELECT CAST(user_id AS VARCHAR) AS id, date_trunc('second', ts) AS ts
    FROM events WHERE event_type = 'purchase'""",
)
def load_chart_events(spark, sf_dir):
    directory = new_path(spark, "csv")
    chart_csv(spark, sf_dir, directory)
    return clinical.load_chart_events(spark, directory)


@query(
    "load_scores",
    f"""WITH {roles.SCORES_SQL}
    SELECT CAST(id AS VARCHAR) AS id, CAST(l_orderkey AS VARCHAR) AS admission_id,
      CAST(l_linenumber AS VARCHAR) AS episode_id, l_quantity AS sapsii, l_discount AS sapsii_prob,
      l_tax AS age_score, CASE WHEN l_partkey % 11 = 0 THEN 0 ELSE l_extendedprice END AS hr_score,
      {", ".join(f"CAST(0 AS DOUBLE) AS {c}" for c in list(clinical.schemas.SCORE_FEATURES)[4:])}
    FROM score_rows""",
)
def load_scores(spark, sf_dir):
    directory = new_path(spark, "csv")
    scores_csv(spark, sf_dir, directory)
    return clinical.load_scores(spark, directory)


_SHAPED_FLAGS = {"congestive_heart_failure": "is_urgent", "hypertension": "is_open", "depression": "is_large"}


@query(
    "load_flags",
    f"""WITH {roles.FLAGS_SQL}
    SELECT CAST(id AS VARCHAR) AS id, CAST(o_orderkey AS VARCHAR) AS admission_id,
      {", ".join(f"{_SHAPED_FLAGS.get(c, 'CAST(0 AS DOUBLE)')} AS {c}" for c in clinical.schemas.FLAG_COLUMNS)}
    FROM flag_rows""",
)
def load_flags(spark, sf_dir):
    directory = new_path(spark, "csv")
    flags_csv(spark, sf_dir, directory)
    return clinical.load_flags(spark, directory)


@query(
    "load_lab_events",
    """SELECT CAST(user_id AS VARCHAR) AS id, CAST(event_id AS VARCHAR) AS admission_id,
      date_trunc('second', ts) AS ts,
      CAST(CAST(json_extract_string(props, '$.k') AS INT) % 20 AS VARCHAR) AS code,
      CASE WHEN event_id % 5 <> 0 THEN value ELSE 0 END AS value, event_id % 5 <> 0 AS measured
    FROM events WHERE event_type = 'error'""",
)
def load_lab_events(spark, sf_dir):
    directory = new_path(spark, "csv")
    labs_csv(spark, sf_dir, directory)
    return clinical.load_labs(spark, directory)


@query(
    "load_undated_codes",
    """SELECT CAST(user_id AS VARCHAR) AS id, CAST(event_id AS VARCHAR) AS admission_id,
      TIMESTAMP '1900-01-01 00:00:00' AS ts, json_extract_string(props, '$.k') AS code,
      CAST(CASE WHEN event_id % 4 <> 0 THEN event_id % 9 ELSE 0 END AS INT) AS sequence
    FROM events WHERE event_type = 'click'""",
)
def load_undated_codes(spark, sf_dir):
    directory = new_path(spark, "csv")
    codes_csv(spark, sf_dir, directory)
    return clinical.load_diagnoses(spark, directory)


@query(
    "load_med_events",
    """SELECT CAST(user_id AS VARCHAR) AS id, CAST(event_id AS VARCHAR) AS admission_id,
      CASE WHEN event_id % 6 > 1 THEN date_trunc('second', ts)
           WHEN event_id % 6 = 1 THEN date_trunc('second', ts) + INTERVAL 3 DAY
           ELSE TIMESTAMP '1900-01-01 00:00:00' END AS ts,
      CAST(CAST(json_extract_string(props, '$.k') AS INT) % 10 AS VARCHAR) AS code
    FROM events WHERE event_type = 'view'""",
)
def load_med_events(spark, sf_dir):
    directory = new_path(spark, "csv")
    drugs_csv(spark, sf_dir, directory)
    return clinical.load_medications(spark, directory)


@query(
    "load_notes",
    f"""SELECT CAST(doc_id AS VARCHAR) AS id, source AS admission_id,
      CAST(TIMESTAMP '2024-01-01 00:00:00' + INTERVAL (doc_id % 28) DAY
        + CASE WHEN doc_id % 4 = 2 THEN INTERVAL 450 MINUTE ELSE INTERVAL 0 MINUTE END AS TIMESTAMP) AS ts,
      'Nursing' AS category, lang AS description, md5({_FLAT.format("text")}) AS text_md5
    FROM documents WHERE doc_id % 4 <> 3""",
)
def load_notes(spark, sf_dir):
    directory = new_path(spark, "csv")
    notes_csv(spark, sf_dir, directory)
    notes = clinical.load_notes(spark, directory)
    return notes.withColumn("text_md5", F.md5("text")).drop("text")


def study_csv(spark, sf_dir) -> str:
    """All input files of a study in one directory."""
    directory = new_path(spark, "csv")
    for write in (
        patients_csv, stays_csv, labs_csv, codes_csv, drugs_csv,
        notes_csv, scores_csv, flags_csv, holdout_csv,
    ):
        write(spark, sf_dir, directory)
    return directory


_COUNTS_SQL = """SELECT 'entities' AS table_name, count(DISTINCT user_id) AS n_rows FROM events
    UNION ALL SELECT 'episodes', count(*) FROM events WHERE event_type = 'signup'
    UNION ALL SELECT 'scores', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    UNION ALL SELECT 'flags', count(*) FROM orders
    UNION ALL SELECT 'labs', count(*) FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'diagnoses', count(*) FROM events WHERE event_type = 'click'
    UNION ALL SELECT 'medications', count(*) FROM events WHERE event_type = 'view'
    UNION ALL SELECT 'notes', count(*) FROM documents WHERE doc_id % 4 <> 3
    UNION ALL SELECT 'holdout_ids', count(DISTINCT user_id) FROM events WHERE user_id % 5 = 0"""


@query("load_all_counts", _COUNTS_SQL)
def load_all_counts(spark, sf_dir):
    loaded = clinical.load_all(spark, study_csv(spark, sf_dir), holdout=True)
    return clinical.row_counts(loaded)


@query("stored_counts", _COUNTS_SQL)
def stored_counts(spark, sf_dir):
    """The same counts, observed while the tables are stored."""
    return clinical.store_counted(clinical.load_all(spark, study_csv(spark, sf_dir), holdout=True))[1]


_TEXT_EVENTS_SQL = """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
      strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type,
      CASE WHEN event_id % 3 = 0 THEN NULL ELSE props END AS props FROM events"""


def _text_events_csv(spark, sf_dir, directory):
    rows = _events(spark, sf_dir).select(
        F.col("event_id").cast("string"),
        F.col("user_id").cast("string"),
        _second(F.col("ts")).alias("ts"),
        "event_type",
        F.when(F.col("event_id") % 3 != 0, F.col("props")).alias("props"),
    )
    return write_csv(rows, f"{directory}/event_log.csv")


@query("csv_scan", _TEXT_EVENTS_SQL)
def csv_scan(spark, sf_dir):
    path = _text_events_csv(spark, sf_dir, new_path(spark, "csv"))
    delimited.read_csv_table(spark, path, view="scanned_events")
    return spark.sql("SELECT event_id, user_id, ts, event_type, props FROM scanned_events")


@query("csv_scan_inferred", _TEXT_EVENTS_SQL)
def csv_scan_inferred(spark, sf_dir):
    path = _text_events_csv(spark, sf_dir, new_path(spark, "csv"))
    delimited.read_csv_table(spark, path)
    return spark.sql("SELECT event_id, user_id, ts, event_type, props FROM event_log")


@query(
    "table_name_from_path",
    r"""WITH paths AS (
      SELECT url || CASE WHEN page_id % 3 = 0 THEN '.csv' WHEN page_id % 3 = 1 THEN '' ELSE '.csv.' END AS path
      FROM pages)
    SELECT path, CASE WHEN regexp_extract(path, '(\w+)(\.csv)?$', 1) = '' THEN path
      ELSE regexp_extract(path, '(\w+)(\.csv)?$', 1) END AS name FROM paths""",
)
def table_name_from_path(spark, sf_dir):
    k = F.col("page_id") % 3
    ending = F.when(k == 0, F.lit(".csv")).when(k == 1, F.lit("")).otherwise(F.lit(".csv."))
    paths = roles.table(spark, sf_dir, "pages").select(F.concat("url", ending).alias("path"))
    return paths.select("path", delimited.table_name_from_path(F.col("path")).alias("name"))


@query(
    "stopword_list",
    """SELECT DISTINCT trim(word, ' ') AS word
    FROM (SELECT unnest(string_split(line, ',')) AS word
          FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))""",
)
def stopword_list(spark, sf_dir):
    path = new_path(spark, "words")
    roles.table(spark, sf_dir, "documents").select("text").write.text(path)
    return stop_words.split_words(spark.read.option("lineSep", "\n").text(path), F.col("value"))


def _turns_csv(spark, sf_dir):
    """Conversation turns with quotes, commas and line breaks inside quoted fields."""
    text = F.concat(F.lit('He said "go, now"\n\n'), F.col("text"), F.lit(",\nend"))
    turns = roles.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", text.alias("text"))
    path = new_path(spark, "csv")
    writer = turns.write.option("header", True).option("escape", '"').option("quoteAll", True)
    writer.csv(path)
    return path


_TURN_SQL = """'He said "go, now"' || chr(10) || chr(10) || text || ',' || chr(10) || 'end'"""


@query(
    "clean_multiline_csv",
    f"""SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role,
      md5({_FLAT.format(f"({_TURN_SQL})")}) AS text_md5 FROM conversations""",
)
def clean_multiline_csv(spark, sf_dir):
    table = delimited.read_multiline_table(spark, _turns_csv(spark, sf_dir), view="turns")
    return table.select("conv_id", "turn", "role", F.md5("text").alias("text_md5"))


@query(
    "join_quoted_lines",
    f"""SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role,
      md5({_FLAT.format(f"({_TURN_SQL})")}) AS text_md5 FROM conversations""",
)
def join_quoted_lines(spark, sf_dir):
    records = delimited.join_quoted_lines(delimited.read_lines(spark, _turns_csv(spark, sf_dir)))
    table = delimited.parse_records(records, ["conv_id", "turn", "role", "text"])
    return table.select("conv_id", "turn", "role", F.md5("text").alias("text_md5"))


@query(
    "stray_quotes",
    """SELECT CASE WHEN o_orderkey % 499 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS id,
      CASE WHEN o_orderkey % 499 = 0 THEN o_orderkey || ',"' || o_orderpriority
           WHEN o_orderkey % 5 = 0 THEN o_orderpriority || '; then more' ELSE o_orderpriority END AS text,
      o_orderkey % 499 = 0 AS rejected FROM orders""",
)
def stray_quotes(spark, sf_dir):
    """Lines of which some hold a stray quote: these are set apart, all others are read."""
    key = F.col("o_orderkey")
    text = (
        F.when(key % 499 == 0, F.concat(F.lit('"'), "o_orderpriority"))
        .when(key % 5 == 0, F.concat(F.lit('"'), "o_orderpriority", F.lit(', then\nmore"')))
        .otherwise(F.col("o_orderpriority"))
    )
    path = new_path(spark, "lines")
    roles.table(spark, sf_dir, "orders").select(F.concat_ws(",", key.cast("string"), text)).write.text(path)
    records = delimited.join_quoted_lines(delimited.read_lines(spark, path), 2, odd_quotes="reject")
    good = delimited.parse_records(records, ["id", "text"], header=False).withColumn("rejected", F.lit(False))
    bad = records.where("stray").select(
        F.lit(None).cast("string").alias("id"), F.col("record").alias("text"), F.lit(True).alias("rejected")
    )
    return good.unionByName(bad)


@query(
    "clean_quoted_csv",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
      'a; b ' || event_type || ' ; c' AS remark FROM events""",
)
def clean_quoted_csv(spark, sf_dir):
    remark = F.concat(F.lit("a, b"), F.lit('"'), F.col("event_type"), F.lit('"'), F.lit(", c"))
    rows = _events(spark, sf_dir).select(F.col("event_id"), "event_type", remark.alias("remark"))
    path = new_path(spark, "csv")
    rows.write.option("escape", '"').option("quoteAll", True).csv(path)
    cleaned = delimited.clean_quoted_lines(spark.read.text(path))
    return delimited.parse_records(
        cleaned.withColumnRenamed("value", "record"), ["event_id", "event_type", "remark"], header=False
    )


@query(
    "parse_timestamps",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN date_trunc('second', ts) END AS parsed
    FROM events""",
)
def parse_timestamps(spark, sf_dir):
    k = F.col("event_id") % 3
    text = (
        F.when(k == 0, _second(F.col("ts")))
        .when(k == 1, F.substring(F.col("ts").cast("string"), 1, 10))
        .otherwise(F.lit(""))
    )
    return _events(spark, sf_dir).select("event_id", dates.parse_timestamp(text).alias("parsed"))


@query(
    "parse_mixed_dates",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN date_trunc('second', ts)
      WHEN event_id % 3 = 1 THEN CAST(date_trunc('day', ts) AS TIMESTAMP) END AS parsed
    FROM events""",
)
def parse_mixed_dates(spark, sf_dir):
    k = F.col("event_id") % 3
    text = (
        F.when(k == 0, F.concat(F.lit(" "), _second(F.col("ts"))))
        .when(k == 1, F.concat(F.substring(F.col("ts").cast("string"), 1, 10), F.lit(" ")))
        .otherwise(F.lit("n/a"))
    )
    return _events(spark, sf_dir).select("event_id", dates.parse_mixed_timestamp(text).alias("parsed"))


@query(
    "blank_to_default",
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN value ELSE 0 END AS number,
      CAST(CASE WHEN event_id % 4 = 0 THEN user_id ELSE -1 END AS INT) AS whole FROM events""",
)
def blank_to_default(spark, sf_dir):
    k = F.col("event_id") % 4

    def text(column: str) -> Column:
        return (
            F.when(k == 0, F.concat(F.col(column).cast("string"), F.lit(" ")))
            .when(k == 1, F.lit("  "))
            .when(k == 2, F.lit("none"))
        )

    return _events(spark, sf_dir).select(
        "event_id",
        values.number_or(text("value")).alias("number"),
        values.integer_or(text("user_id"), -1).alias("whole"),
    )


@query(
    "date_fallback",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN ts
      WHEN event_id % 3 = 1 THEN ts + INTERVAL 1 DAY
      ELSE TIMESTAMP '1900-01-01 00:00:00' END AS at FROM events""",
)
def date_fallback(spark, sf_dir):
    k, ts = F.col("event_id") % 3, F.col("ts")
    at = dates.first_date(
        F.when(k == 0, ts), F.when(k == 1, dates.plus_days(ts, 1)), default=dates.undated()
    )
    return _events(spark, sf_dir).select("event_id", at.alias("at"))


def _scored(spark, sf_dir):
    return roles.entities(spark, sf_dir).select("id", (F.col("id") % 7 / 8).alias("score"))


@query(
    "prediction_export",
    """SELECT CAST(user_id AS VARCHAR) AS "SUBJECT_ID", CAST(user_id % 7 / 8 AS VARCHAR) AS "InHospital_Expiry"
    FROM (SELECT DISTINCT user_id FROM events)""",
)
def prediction_export(spark, sf_dir):
    path = new_path(spark, "predictions")
    sinks.write_predictions(_scored(spark, sf_dir), path)
    return spark.read.schema("SUBJECT_ID STRING, InHospital_Expiry STRING").csv(path)


@query(
    "ordered_export",
    """SELECT row_number() OVER (ORDER BY user_id) - 1 AS line_no,
      CAST(user_id AS VARCHAR) || ',' || CAST(user_id % 7 / 8 AS VARCHAR) AS line
    FROM (SELECT DISTINCT user_id FROM events)""",
)
def ordered_export(spark, sf_dir):
    """Sorted part files, read back with each line's number in the concatenated file."""
    path = new_path(spark, "lines")
    line = F.concat_ws(",", F.col("id").cast("string"), F.col("score").cast("string"))
    sinks.write_ordered_text(_scored(spark, sf_dir), ["id"], path, line)
    return delimited.numbered_lines(delimited.read_lines(spark, path))

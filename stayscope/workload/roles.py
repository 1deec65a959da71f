"""The study's roles played by the benchmark tables, in DataFrame and in SQL form.

Entities are the users of ``events``; sign-ups are 48-hour stays, a late purchase is the
terminal event, clicks are undated codes, views medications and errors measurements.
Order lines are score rows and orders flag rows of customers. Conversation turns are notes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stayscope import schemas
from stayscope.config import IN_STAY, Outcome, cohort_specs
from stayscope.functions import dates
from stayscope.sources.clinical import Inputs

# The events span 30 days, hence windows of 3 and 10 days instead of 30 and 365.
SHORT_TERM = Outcome("short_term", "in3d", within_days=3)
LONG_TERM = Outcome("long_term", "in10d", within_days=10, beyond_days=3)
OUTCOMES = (IN_STAY, SHORT_TERM, LONG_TERM)
SPECS = cohort_specs(OUTCOMES)

SCORE_NAMES = {
    "l_quantity": "quantity_score",
    "l_extendedprice": "price_score",
    "l_discount": "discount_score",
    "l_tax": "tax_score",
}
FLAG_NAMES = {
    "is_urgent": "com-isUrgent",
    "is_open": "com-isOpen",
    "is_finished": "com-isFinished",
    "is_large": "com-isLarge",
}

_SPLIT_DAY = "2024-01-20 00:00:00"


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table; its schema is looked up in the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _code() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _events(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter(F.col("event_type") == kind)


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.expr(
            f"""min(CASE WHEN event_type = 'purchase' AND ts >= TIMESTAMP_NTZ '{_SPLIT_DAY}'
                THEN ts END) AS first_late"""
        )
    )
    return users.selectExpr(
        "user_id AS id",
        "user_id % 2 = 0 AS is_male",
        """TIMESTAMP_NTZ '1950-01-01 00:00:00'
           + make_dt_interval(CAST(100 * (user_id % 250) AS INT)) AS dob""",
        "CAST(user_id % 3 <> 0 AS DOUBLE) AS is_dead",
        f"""coalesce(CASE WHEN user_id % 3 <> 0 THEN first_late END,
            TIMESTAMP_NTZ '{schemas.OPEN_END}') AS dod""",
    )


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    stays = _events(spark, sf_dir, "signup").filter(
        f"ts < TIMESTAMP_NTZ '{_SPLIT_DAY}' AND user_id % 10 <> 0"
    )
    return stays.selectExpr(
        "user_id AS id",
        "event_id AS episode_id",
        "ts AS in_ts",
        "ts + INTERVAL '48' HOUR AS out_ts",
    )


def diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, "click").select(
        F.col("user_id").alias("id"), dates.undated().alias("ts"), _code().cast("string").alias("code")
    )


def medications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, "view").select(
        F.col("user_id").alias("id"), "ts", (_code() % 10).cast("string").alias("code")
    )


def labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, "error").select(
        F.col("user_id").alias("id"), "ts", (_code() % 20).cast("string").alias("code"), "value"
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of each customer; ids are text, as in a CSV source."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("id"),
        F.col("l_orderkey").cast("string").alias("admission_id"),
        F.col("l_linenumber").cast("string").alias("episode_id"),
        "l_partkey",
        "l_suppkey",
        *SCORE_NAMES,
    )


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderkey").cast("string").alias("admission_id"),
        (F.col("o_orderpriority") == "1-URGENT").cast("double").alias("is_urgent"),
        (F.col("o_orderstatus") == "O").cast("double").alias("is_open"),
        (F.col("o_orderstatus") == "F").cast("double").alias("is_finished"),
        (F.col("o_totalprice") > 200000).cast("double").alias("is_large"),
    )


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns, one per hour from the start of the events."""
    start = dates.timestamp_lit("2024-01-01 00:00:00")
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("id"),
        "turn",
        (start + F.make_dt_interval(F.lit(0), F.col("turn").cast("int"))).alias("ts"),
        "text",
    )


def holdout_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    return users.filter(F.col("id") % 5 == 0).distinct()


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(
        entities=entities(spark, sf_dir),
        episodes=episodes(spark, sf_dir),
        scores=scores(spark, sf_dir),
        flags=flags(spark, sf_dir),
        labs=labs(spark, sf_dir),
        diagnoses=diagnoses(spark, sf_dir),
        medications=medications(spark, sf_dir),
        notes=notes(spark, sf_dir),
        holdout_ids=holdout_ids(spark, sf_dir),
    )


# --- the same roles as SQL -------------------------------------------------------------

ENTITIES_SQL = """
users AS (
  SELECT user_id AS id,
         min(CASE WHEN event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-20 00:00:00'
                  THEN ts END) AS first_late
  FROM events GROUP BY user_id),
entities AS (
  SELECT id, id % 2 = 0 AS is_male,
         TIMESTAMP '1950-01-01 00:00:00' + INTERVAL (100 * (id % 250)) DAY AS dob,
         CASE WHEN id % 3 <> 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS is_dead,
         CASE WHEN id % 3 <> 0 AND first_late IS NOT NULL THEN first_late
              ELSE TIMESTAMP '9000-01-01 00:00:00' END AS dod
  FROM users)"""

EPISODES_SQL = """
episodes AS (
  SELECT user_id AS id, event_id AS episode_id, ts AS in_ts, ts + INTERVAL 48 HOUR AS out_ts
  FROM events
  WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-20 00:00:00' AND user_id % 10 <> 0),
stays AS (
  SELECT id, episode_id, in_ts, out_ts FROM (
    SELECT *, row_number() OVER (
      PARTITION BY id ORDER BY out_ts DESC, in_ts DESC, episode_id DESC) AS rn
    FROM episodes) WHERE rn = 1)"""


def _spec_values() -> str:
    rows = [
        f"('{c.outcome.name}', '{c.horizon}', '{c.name}', {c.hours}, "
        f"{c.outcome.within_days or 0}, "
        f"{-1 if c.outcome.beyond_days is None else c.outcome.beyond_days})"
        for c in SPECS
    ]
    return ",\n  ".join(rows)


GRID_SQL = f"""{ENTITIES_SQL},{EPISODES_SQL},
anchored AS (
  SELECT e.*, s.in_ts, s.out_ts FROM entities e LEFT JOIN stays s ON e.id = s.id),
specs(outcome, horizon, cohort, hours, within_days, beyond_days) AS (VALUES
  {_spec_values()}),
labelled AS (
  SELECT a.*, specs.*,
    CASE WHEN is_dead <> 0 AND (
      CASE WHEN outcome = 'in_stay' THEN dod >= in_ts AND dod <= out_ts
           ELSE dod > out_ts AND date_sub('day', out_ts, dod) <= within_days
                AND date_sub('day', out_ts, dod) > beyond_days END)
    THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label
  FROM anchored a CROSS JOIN specs),
dated AS (
  SELECT *, CASE WHEN in_ts IS NULL THEN TIMESTAMP '1971-01-01 00:00:00'
    WHEN hours > 0 THEN least(in_ts + hours * INTERVAL 1 HOUR, out_ts, dod)
    WHEN label = 1 THEN dod
    ELSE out_ts + within_days * INTERVAL 1 DAY END AS index_ts
  FROM labelled),
grid AS (
  SELECT *, CAST(abs(date_sub('day', dob, index_ts)) // 365 AS DOUBLE) AS age FROM dated)"""

COHORT_SQL = f"""{GRID_SQL},
cohort AS (
  SELECT id, is_male, dob, dod, label, index_ts, age FROM grid
  WHERE outcome = 'in_stay' AND horizon = '24h')"""

CODES_SQL = """
diagnoses AS (
  SELECT user_id AS id, json_extract_string(props, '$.k') AS code
  FROM events WHERE event_type = 'click'),
medications AS (
  SELECT user_id AS id, ts, CAST(CAST(json_extract_string(props, '$.k') AS INT) % 10 AS VARCHAR) AS code
  FROM events WHERE event_type = 'view'),
labs AS (
  SELECT user_id AS id, ts, CAST(CAST(json_extract_string(props, '$.k') AS INT) % 20 AS VARCHAR) AS code,
         value
  FROM events WHERE event_type = 'error')"""

EVENT_TUPLES_SQL = """
diag_tuples AS (
  SELECT d.id, 'DIAG-' || code AS feature, CAST(count(*) AS DOUBLE) AS value
  FROM diagnoses d JOIN cohort c ON d.id = c.id GROUP BY d.id, code),
med_tuples AS (
  SELECT m.id, 'MED-' || code AS feature, CAST(count(*) AS DOUBLE) AS value
  FROM medications m JOIN cohort c ON m.id = c.id AND m.ts <= c.index_ts GROUP BY m.id, code),
lab_tuples AS (
  SELECT l.id, 'LAB-' || code AS feature, avg(value) AS value
  FROM labs l JOIN cohort c ON l.id = c.id AND l.ts <= c.index_ts GROUP BY l.id, code)"""

SCORES_SQL = """
score_rows AS (
  SELECT o_custkey AS id, l_orderkey, l_linenumber, l_partkey, l_suppkey,
         l_quantity, l_extendedprice, l_discount, l_tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
latest_scores AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY l_orderkey DESC, l_linenumber DESC,
      l_partkey DESC, l_suppkey DESC) AS rn FROM score_rows) WHERE rn = 1)"""

FLAGS_SQL = """
flag_rows AS (
  SELECT o_custkey AS id, o_orderkey,
         CAST(o_orderpriority = '1-URGENT' AS DOUBLE) AS is_urgent,
         CAST(o_orderstatus = 'O' AS DOUBLE) AS is_open,
         CAST(o_orderstatus = 'F' AS DOUBLE) AS is_finished,
         CAST(o_totalprice > 200000 AS DOUBLE) AS is_large
  FROM orders),
latest_flags AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY o_orderkey DESC) AS rn FROM flag_rows)
  WHERE rn = 1)"""


def unpivot_sql(source: str, names: dict[str, str], key: str = "id") -> str:
    """A UNION ALL that turns columns into ``(id, feature, value)`` rows."""
    return "\n  UNION ALL ".join(
        f"SELECT {key}, '{name}' AS feature, CAST({column} AS DOUBLE) AS value FROM {source}"
        for column, name in names.items()
    )

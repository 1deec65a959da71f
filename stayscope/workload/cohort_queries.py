"""Cohort construction on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayscope.config import IN_STAY, OUTCOMES
from stayscope.operators import cohort as co
from stayscope.workload import roles
from stayscope.workload.registry import query


def cohort(spark, sf_dir, outcome=IN_STAY, hours=24):
    return co.build_cohort(
        roles.entities(spark, sf_dir), roles.episodes(spark, sf_dir), outcome, hours
    )


def grid(spark, sf_dir, specs=None):
    return co.cohort_grid(
        roles.entities(spark, sf_dir), roles.episodes(spark, sf_dir), specs or roles.SPECS
    )


@query(
    "latest_episode",
    f"WITH {roles.EPISODES_SQL} SELECT id, episode_id, in_ts, out_ts FROM stays",
)
def latest_episode(spark, sf_dir):
    return co.latest_episode(roles.episodes(spark, sf_dir), tie_break=["episode_id"])


@query(
    "cohort_left_outer",
    f"WITH {roles.GRID_SQL} SELECT id, is_male, dob, is_dead, dod, in_ts, out_ts FROM anchored",
)
def cohort_left_outer(spark, sf_dir):
    return co.anchored_entities(roles.entities(spark, sf_dir), roles.episodes(spark, sf_dir))


@query(
    "cohort_build",
    f"WITH {roles.COHORT_SQL} SELECT id, is_male, dob, dod, label, index_ts, age FROM cohort",
)
def cohort_build(spark, sf_dir):
    return cohort(spark, sf_dir)


@query(
    "cohort_grid",
    f"""WITH {roles.GRID_SQL}
    SELECT id, is_male, dob, dod, cohort, outcome, horizon, label, index_ts, age FROM grid""",
)
def cohort_grid(spark, sf_dir):
    return grid(spark, sf_dir)


@query(
    "cohort_positive_counts",
    f"""WITH {roles.GRID_SQL}
    SELECT outcome, horizon, count(*) AS n_entities,
           CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_positive
    FROM grid GROUP BY outcome, horizon""",
)
def cohort_positive_counts(spark, sf_dir):
    return co.positive_counts(grid(spark, sf_dir))


def _label_sql(outcome: str) -> str:
    return f"""WITH {roles.GRID_SQL}
    SELECT id, label FROM grid WHERE outcome = '{outcome}' AND horizon = '24h'"""


@query("label_in_stay", _label_sql("in_stay"))
def label_in_stay(spark, sf_dir):
    return cohort(spark, sf_dir, roles.IN_STAY).select("id", "label")


@query("label_30d", _label_sql("short_term"))
def label_30d(spark, sf_dir):
    return cohort(spark, sf_dir, roles.SHORT_TERM).select("id", "label")


@query("label_1y", _label_sql("long_term"))
def label_1y(spark, sf_dir):
    return cohort(spark, sf_dir, roles.LONG_TERM).select("id", "label")


@query(
    "outcome_labels",
    f"""WITH {roles.GRID_SQL}
    SELECT id, CAST(abs(date_sub('day', out_ts, dod)) AS INT) AS days_after,
      max(CASE WHEN outcome = 'in_stay' THEN label END) AS in_stay,
      max(CASE WHEN outcome = 'short_term' THEN label END) AS short_term,
      max(CASE WHEN outcome = 'long_term' THEN label END) AS long_term
    FROM grid WHERE horizon = '24h' GROUP BY id, out_ts, dod""",
)
def outcome_labels(spark, sf_dir):
    anchored = co.anchored_entities(roles.entities(spark, sf_dir), roles.episodes(spark, sf_dir))
    gap = co.dates.full_days(F.col("dod"), F.col("out_ts"))
    labels = [co.label_of(o).alias(o.name) for o in roles.OUTCOMES]
    return anchored.select("id", gap.cast("int").alias("days_after"), *labels)


@query(
    "labels_by_year",
    """WITH stays AS (
      SELECT o_custkey AS id, o_orderdate AS in_ts, o_orderdate + INTERVAL 2 DAY AS out_ts FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1),
    people AS (
      SELECT o_custkey AS id, o_custkey % 3 <> 0 AS dead,
        max(o_orderdate) + to_days(CAST(o_custkey % 400 AS INT)) + to_hours(CAST(o_custkey % 24 AS INT)) AS dod
      FROM orders GROUP BY o_custkey),
    gaps AS (
      SELECT id, dead, dod, in_ts, out_ts, (epoch_us(dod) - epoch_us(out_ts)) / 86400e6 AS days
      FROM people JOIN stays USING (id))
    SELECT id, CAST(dead AND dod >= in_ts AND dod <= out_ts AS DOUBLE) AS in_icu,
      CAST(dead AND days > 0 AND floor(days) <= 30 AS DOUBLE) AS in_30d,
      CAST(dead AND days > 0 AND floor(days) > 30 AND floor(days) <= 365 AS DOUBLE) AS in_1y FROM gaps""",
)
def labels_by_year(spark, sf_dir):
    """The standard outcomes, up to 30 and 31 to 365 days after a stay, on order dates."""
    orders = roles.table(spark, sf_dir, "orders")
    two_days = F.make_dt_interval(F.lit(2))
    stays = orders.select(
        F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("in_ts"), (F.col("o_orderdate") + two_days).alias("out_ts")
    )
    later = F.make_dt_interval((F.col("id") % 400).cast("int"), (F.col("id") % 24).cast("int"))
    people = orders.groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderdate").alias("last")).select(
        "id",
        F.lit(True).alias("is_male"),
        co.dates.timestamp_lit("1950-01-01 00:00:00").alias("dob"),
        (F.col("id") % 3 != 0).cast("int").alias("is_dead"),
        (F.col("last") + later).alias("dod"),
    )
    anchored = co.anchored_entities(people, stays)
    names = ("in_icu", "in_30d", "in_1y")
    return anchored.select("id", *[co.label_of(o).alias(n) for o, n in zip(OUTCOMES, names, strict=True)])


@query(
    "index_date_hourly",
    f"""WITH {roles.GRID_SQL}
    SELECT id, horizon, index_ts FROM grid WHERE outcome = 'in_stay' AND hours > 0""",
)
def index_date_hourly(spark, sf_dir):
    specs = [c for c in roles.SPECS if c.outcome == IN_STAY and c.hours]
    return grid(spark, sf_dir, specs).select("id", "horizon", "index_ts")


@query(
    "index_date_retro",
    f"""WITH {roles.GRID_SQL}
    SELECT id, outcome, index_ts FROM grid WHERE hours = 0""",
)
def index_date_retro(spark, sf_dir):
    specs = [c for c in roles.SPECS if not c.hours]
    return grid(spark, sf_dir, specs).select("id", "outcome", "index_ts")


@query(
    "entity_age",
    f"WITH {roles.GRID_SQL} SELECT id, cohort, age FROM grid",
)
def entity_age(spark, sf_dir):
    return grid(spark, sf_dir).select("id", "cohort", "age")

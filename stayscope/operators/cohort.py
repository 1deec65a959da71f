"""Cohorts: outcome label, index date and age of every entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stayscope import schemas
from stayscope.config import RETROSPECTIVE, Cohort, Outcome, cohort_specs
from stayscope.functions import dates


def latest_by(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row with the greatest ``order`` of each key; ties fall to the greater other columns.

    The maximum combines on the map side, so a frequent key costs one row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(F.struct(*order).alias("_order"), F.struct(*rest).alias("_row")))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best._row.*")


def latest_episode(
    episodes: DataFrame, id_col: str = "id", tie_break: Sequence[str | Column] = ()
) -> DataFrame:
    """Each entity's stay with the latest out time, then in time, then ``tie_break``."""
    return latest_by(episodes, id_col, ["out_ts", "in_ts", *tie_break])


def anchored_entities(
    entities: DataFrame, episodes: DataFrame, id_col: str = "id", precision: str = "timestamp"
) -> DataFrame:
    """Entities with the in and out time of their latest stay, null if they have none.

    ``precision="day"`` drops the time of day from every date first.
    """
    day = precision == "day"
    if day:
        for c in ("in_ts", "out_ts"):
            episodes = episodes.withColumn(c, F.col(c).cast("date").cast("timestamp_ntz"))
    stays = (
        episodes.groupBy(id_col)
        .agg(F.max(F.struct("out_ts", "in_ts")).alias("_stay"))
        .select(id_col, "_stay.in_ts", "_stay.out_ts")
    )
    people = entities.select(id_col, "is_male", "dob", "is_dead", "dod")
    joined = people.join(stays, id_col, "left")
    if day:
        for c in ("dob", "dod"):
            joined = joined.withColumn(c, F.col(c).cast("date").cast("timestamp_ntz"))
    return joined


def outcome_sql(outcome: Outcome) -> str:
    """Condition: flagged, and the terminal date falls into the outcome's window."""
    if outcome.in_stay:
        window = "dod BETWEEN in_ts AND out_ts"
    else:
        days = "extract(DAY FROM dod - out_ts)"
        window = f"dod > out_ts AND {days} <= {outcome.within_days}"
        if outcome.beyond_days is not None:
            window += f" AND {days} > {outcome.beyond_days}"
    return f"coalesce(is_dead <> 0 AND {window}, false)"


def label_of(outcome: Outcome, excluding: Sequence[Outcome] = ()) -> Column:
    """1.0 for a positive, else 0.0; null for entities positive under ``excluding``."""
    label = f"CAST({outcome_sql(outcome)} AS DOUBLE)"
    for other in excluding:
        label = f"CASE WHEN NOT {outcome_sql(other)} THEN {label} END"
    return F.expr(label)


def index_sql(cohort: Cohort) -> str:
    """The moment up to which a cohort may know things; fixed for entities with no stay."""
    if cohort.hours == RETROSPECTIVE:
        window = cohort.outcome.within_days or 0
        known = (
            f"CASE WHEN {outcome_sql(cohort.outcome)} THEN dod "
            f"ELSE out_ts + INTERVAL '{window}' DAY END"
        )
    else:
        known = f"least(in_ts + INTERVAL '{cohort.hours}' HOUR, out_ts, dod)"
    unset = f"TIMESTAMP_NTZ '{schemas.UNSET_INDEX}'"
    return f"CASE WHEN in_ts IS NULL THEN {unset} ELSE {known} END"


def index_date(cohort: Cohort) -> Column:
    return F.expr(index_sql(cohort))


def members(
    anchored: DataFrame,
    specs: Sequence[Cohort],
    id_col: str = "id",
    excluding: Sequence[Outcome] = (),
) -> DataFrame:
    """Cohorts of :func:`anchored_entities` in one pass: one row per entity and cohort."""
    outcomes = list(dict.fromkeys(c.outcome for c in specs))
    labels = [
        label_of(o, [e for e in excluding if e != o]).alias(f"_label_{k}")
        for k, o in enumerate(outcomes)
    ]
    rows = ", ".join(
        f"struct('{c.name}' AS cohort, '{c.outcome.name}' AS outcome, '{c.horizon}' AS horizon, "
        f"_label_{outcomes.index(c.outcome)} AS label, {index_sql(c)} AS index_ts)"
        for c in specs
    )
    spread = anchored.select("*", *labels).select(
        id_col, "is_male", "dob", "dod", F.expr(f"inline(array({rows}))")
    )
    return spread.filter("label IS NOT NULL").withColumn(
        "age", dates.full_years(F.col("index_ts"), F.col("dob"))
    )


def cutoffs(anchored: DataFrame, specs: Sequence[Cohort], id_col: str = "id") -> DataFrame:
    """Index dates of :func:`anchored_entities`, one column per cohort."""
    return anchored.select(id_col, *[index_date(c).alias(c.name) for c in specs])


def cohort_grid(
    entities: DataFrame,
    episodes: DataFrame,
    specs: Sequence[Cohort] | None = None,
    id_col: str = "id",
    precision: str = "timestamp",
    exclude_prior_outcome: Sequence[Outcome] = (),
) -> DataFrame:
    """Every cohort in one plan: the join runs once, the cohorts are exploded after it.

    Entities positive under an outcome of ``exclude_prior_outcome`` leave the cohorts of
    the other outcomes; by default they stay as negatives.
    """
    anchored = anchored_entities(entities, episodes, id_col, precision)
    return members(anchored, specs or cohort_specs(), id_col, exclude_prior_outcome)


def build_cohort(
    entities: DataFrame,
    episodes: DataFrame,
    outcome: Outcome,
    hours: int,
    id_col: str = "id",
    precision: str = "timestamp",
    exclude_prior_outcome: Sequence[Outcome] = (),
) -> DataFrame:
    """One cohort: id, is_male, dob, dod, label, index_ts and age."""
    grid = cohort_grid(
        entities, episodes, [Cohort(outcome, hours)], id_col, precision, exclude_prior_outcome
    )
    return grid.drop("cohort", "outcome", "horizon")


def cohort_cutoffs(
    entities: DataFrame,
    episodes: DataFrame,
    specs: Sequence[Cohort] | None = None,
    id_col: str = "id",
    precision: str = "timestamp",
) -> DataFrame:
    """One row per entity with one index date column per cohort, for one-pass event scans."""
    anchored = anchored_entities(entities, episodes, id_col, precision)
    return cutoffs(anchored, specs or cohort_specs(), id_col)


def positive_counts(grid: DataFrame) -> DataFrame:
    """Members and positives of each cohort."""
    return grid.groupBy("outcome", "horizon").agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.count_if(F.col("label") == 1.0).alias("n_positive"),
    )

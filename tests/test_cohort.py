import datetime as dt

import pytest
from pyspark.sql import functions as F

from stayscope import config
from stayscope.config import IN_STAY, WITHIN_1_YEAR, WITHIN_30_DAYS
from stayscope.operators import cohort as co

IN = dt.datetime(2020, 1, 1, 10)
OUT = dt.datetime(2020, 1, 5, 10)
OPEN = dt.datetime(9000, 1, 1)
DAY, SECOND = dt.timedelta(days=1), dt.timedelta(seconds=1)

# id -> (terminal date, flag, expected in-stay, 30-day and 1-year label)
CASES = {
    "before": (IN - SECOND, 1.0, 0, 0, 0),
    "at_in": (IN, 1.0, 1, 0, 0),
    "at_out": (OUT, 1.0, 1, 0, 0),
    "after_out": (OUT + SECOND, 1.0, 0, 1, 0),
    "last_of_day_30": (OUT + 31 * DAY - SECOND, 1.0, 0, 1, 0),
    "day_31": (OUT + 31 * DAY, 1.0, 0, 0, 1),
    "last_of_day_365": (OUT + 366 * DAY - SECOND, 1.0, 0, 0, 1),
    "day_366": (OUT + 366 * DAY, 1.0, 0, 0, 0),
    "unflagged": (IN + DAY, 0.0, 0, 0, 0),
    "open": (OPEN, 0.0, 0, 0, 0),
}
PEOPLE = "id string, is_male boolean, dob timestamp_ntz, is_dead double, dod timestamp_ntz"
STAYS = "id string, in_ts timestamp_ntz, out_ts timestamp_ntz"
BORN = dt.datetime(1960, 1, 1)


@pytest.fixture(scope="module")
def people(spark):
    rows = [(k, True, BORN, v[1], v[0]) for k, v in CASES.items()]
    rows.append(("no_stay", False, BORN, 1.0, IN))
    return spark.createDataFrame(rows, PEOPLE)


@pytest.fixture(scope="module")
def stays(spark):
    rows = [(k, IN, OUT) for k in CASES]
    # Earlier out times never win, whatever the in time.
    rows += [(k, IN + DAY, OUT - DAY) for k in CASES]
    return spark.createDataFrame(rows, STAYS)


def collected(cohort, column):
    return {r["id"]: r[column] for r in cohort.collect()}


@pytest.mark.parametrize("outcome,place", [(IN_STAY, 2), (WITHIN_30_DAYS, 3), (WITHIN_1_YEAR, 4)])
def test_labels_at_the_window_edges(people, stays, outcome, place):
    labels = collected(co.build_cohort(people, stays, outcome, 24), "label")
    expected = {k: float(v[place]) for k, v in CASES.items()}
    assert labels == {**expected, "no_stay": 0.0}


def test_hourly_index_is_the_earliest_of_three(people, stays):
    index = collected(co.build_cohort(people, stays, IN_STAY, 48), "index_ts")
    for k, (dod, *_rest) in CASES.items():
        assert index[k] == min(IN + 2 * DAY, OUT, dod)
    assert index["no_stay"] == dt.datetime(1971, 1, 1)


def test_retrospective_index(people, stays):
    for outcome, days, place in ((IN_STAY, 0, 2), (WITHIN_30_DAYS, 30, 3), (WITHIN_1_YEAR, 365, 4)):
        index = collected(co.build_cohort(people, stays, outcome, 0), "index_ts")
        for k, case in CASES.items():
            assert index[k] == (case[0] if case[place] else OUT + days * DAY), (outcome.name, k)


def test_age_counts_365_day_years(people, stays):
    ages = collected(co.build_cohort(people, stays, IN_STAY, 24), "age")
    assert ages["open"] == (IN + DAY - BORN).days // 365
    assert ages["no_stay"] == (dt.datetime(1971, 1, 1) - BORN).days // 365


def test_grid_equals_single_cohorts(people, stays):
    grid = co.cohort_grid(people, stays)
    assert grid.count() == 12 * (len(CASES) + 1)
    for c in config.cohort_specs():
        one = co.build_cohort(people, stays, c.outcome, c.hours)
        same = grid.filter(F.col("cohort") == c.name).select(one.columns)
        assert same.exceptAll(one).count() == 0 and one.exceptAll(same).count() == 0
    cut = co.cohort_cutoffs(people, stays)
    long = cut.unpivot(["id"], [c.name for c in config.cohort_specs()], "cohort", "index_ts")
    assert long.exceptAll(grid.select("id", "cohort", "index_ts")).count() == 0


def test_labels_exclude_each_other(people, stays):
    grid = co.cohort_grid(people, stays).filter("horizon = '24h'")
    per_entity = grid.groupBy("id").agg(F.sum("label").alias("n"))
    assert per_entity.filter("n > 1").count() == 0


def test_prior_outcomes_can_be_excluded(people, stays):
    kept = co.build_cohort(people, stays, WITHIN_30_DAYS, 24, exclude_prior_outcome=[IN_STAY])
    assert {"at_in", "at_out"}.isdisjoint(collected(kept, "label"))
    assert kept.count() == len(CASES) + 1 - 2


def test_day_precision_truncates(people, stays):
    index = collected(co.build_cohort(people, stays, IN_STAY, 24, precision="day"), "index_ts")
    assert index["open"] == dt.datetime(2020, 1, 2)


def test_latest_episode_breaks_ties(spark):
    rows = [("a", 1, IN, OUT), ("a", 2, IN, OUT), ("a", 3, IN + DAY, OUT - DAY), ("b", 4, IN, OPEN)]
    stays = spark.createDataFrame(
        rows, "id string, episode_id int, in_ts timestamp_ntz, out_ts timestamp_ntz"
    )
    latest = co.latest_episode(stays, tie_break=["episode_id"])
    assert collected(latest, "episode_id") == {"a": 2, "b": 4}


def test_positive_counts(people, stays):
    counts = co.positive_counts(co.cohort_grid(people, stays)).collect()
    found = {(r["outcome"], r["horizon"]): r["n_positive"] for r in counts}
    assert len(found) == 12
    assert {found[("in_stay", h)] for h in ("12h", "24h", "48h", "retro")} == {2}
    assert found[("in_30d", "24h")] == 2 and found[("in_1y", "24h")] == 2


def test_names():
    names = {config.export_name(c, config.FEATURE_SETS[0]) for c in config.cohort_specs()}
    assert "svlight_inICU12Hr_baseline" in names and "svlight_in1YrRetro_baseline" in names

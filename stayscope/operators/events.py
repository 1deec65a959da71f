"""Dated events up to an index date, and the features counted from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stayscope.operators.skew import skew_join


def in_cohort(df: DataFrame, cohort: DataFrame, id_col: str = "id", **skew: int) -> DataFrame:
    """Rows whose entity belongs to the cohort, which holds one row per entity."""
    return skew_join(df, cohort.select(id_col), id_col, how="left_semi", **skew)


def at_precision(ts_col: str, precision: str) -> Column:
    """A time as it is, or with ``precision="day"`` its day; cohort dates are cut alike."""
    if precision not in ("timestamp", "day"):
        raise ValueError(f"unknown precision: {precision}")
    ts = F.col(ts_col)
    return ts if precision == "timestamp" else ts.cast("date").cast("timestamp_ntz")


def as_of(
    events: DataFrame,
    cohort: DataFrame,
    id_col: str = "id",
    ts_col: str = "ts",
    lookback: Column | None = None,
    precision: str = "timestamp",
    **skew: int,
) -> DataFrame:
    """Events no later than the entity's index date, which is added as ``index_ts``.

    ``precision`` is that of the cohort: with ``"day"``, an event of the index day counts,
    whatever its time.

    ``lookback`` (an interval) also drops what happened longer before. ``cohort`` holds
    one row per entity; a frequent entity is handled by :func:`skew_join`.
    """
    ts = at_precision(ts_col, precision)
    known = ts <= F.col("index_ts")
    if lookback is not None:
        known = known & (ts >= F.col("index_ts") - lookback)
    return skew_join(events, cohort.select(id_col, "index_ts"), id_col, known, **skew)


def _named(events: DataFrame, prefix: str, code_col: str) -> DataFrame:
    coded = events.filter(F.length(code_col) > 0)
    return coded.withColumn("feature", F.concat(F.lit(prefix), F.col(code_col)))


def count_features(
    events: DataFrame, prefix: str, id_col: str = "id", code_col: str = "code"
) -> DataFrame:
    """How often each entity had each code."""
    counted = _named(events, prefix, code_col).groupBy(id_col, "feature")
    return counted.agg(F.count(F.lit(1)).cast("double").alias("value"))


def mean_features(
    events: DataFrame,
    prefix: str,
    id_col: str = "id",
    code_col: str = "code",
    value_col: str = "value",
    measured_col: str | None = None,
) -> DataFrame:
    """Mean value per entity and code.

    Missing values are stored as 0.0 and count as such, unless ``measured_col`` names the
    flag that tells them apart.
    """
    named = _named(events, prefix, code_col)
    if measured_col is not None:
        named = named.filter(F.col(measured_col))
    return named.groupBy(id_col, "feature").agg(F.avg(value_col).alias("value"))


def _known_events(
    events: DataFrame,
    cutoffs: DataFrame,
    names: Sequence[str],
    id_col: str,
    ts_col: str,
    precision: str,
    skew: dict,
) -> DataFrame:
    events = events.withColumn(ts_col, at_precision(ts_col, precision))
    last = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    return skew_join(events, cutoffs, id_col, F.col(ts_col) <= last, **skew)


def _spread(wide: DataFrame, id_col: str, names: Sequence[str], value: str) -> DataFrame:
    """One row per cohort from per-cohort columns; cohorts that saw nothing drop out."""
    cells = ", ".join(
        f"struct('{n}' AS cohort, {value.format(f'`{n}`')} AS value)" for n in names
    )
    long = wide.select(id_col, "feature", F.expr(f"inline(array({cells}))"))
    return long.filter("value IS NOT NULL").select("cohort", id_col, "feature", "value")


def count_features_grid(
    events: DataFrame,
    cutoffs: DataFrame,
    names: Sequence[str],
    prefix: str,
    id_col: str = "id",
    ts_col: str = "ts",
    code_col: str = "code",
    precision: str = "timestamp",
    **skew: int,
) -> DataFrame:
    """:func:`count_features` for all cohorts at once.

    An event is read, joined and shuffled once, whatever the number of cohorts: the
    cutoffs sit side by side in one row per entity and become conditional counts.
    """
    known = _known_events(_named(events, prefix, code_col), cutoffs, names, id_col, ts_col, precision, skew)
    seen = [F.expr(f"count_if(`{ts_col}` <= `{n}`) AS `{n}`") for n in names]
    wide = known.groupBy(id_col, "feature").agg(*seen)
    return _spread(wide, id_col, names, "CAST(nullif({0}, 0) AS DOUBLE)")


def mean_features_grid(
    events: DataFrame,
    cutoffs: DataFrame,
    names: Sequence[str],
    prefix: str,
    id_col: str = "id",
    ts_col: str = "ts",
    code_col: str = "code",
    value_col: str = "value",
    measured_col: str | None = None,
    precision: str = "timestamp",
    **skew: int,
) -> DataFrame:
    """:func:`mean_features` for all cohorts at once, in the same single pass."""
    named = _named(events, prefix, code_col)
    if measured_col is not None:
        named = named.filter(F.col(measured_col))
    known = _known_events(named, cutoffs, names, id_col, ts_col, precision, skew)
    means = [
        F.expr(f"avg(CASE WHEN `{ts_col}` <= `{n}` THEN `{value_col}` END) AS `{n}`") for n in names
    ]
    wide = known.groupBy(id_col, "feature").agg(*means)
    return _spread(wide, id_col, names, "{0}")

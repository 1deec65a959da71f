"""Features that do not depend on time: latest score rows, flags, age and sex."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stayscope.operators.cohort import latest_by


def numeric_order(*columns: str) -> list[Column]:
    """Order text ids by their number, so that "10" follows "9"."""
    return [F.col(c).try_cast("double") for c in columns]


def latest_scores(scores: DataFrame, id_col: str = "id", tie_break: Sequence[str] = ()) -> DataFrame:
    """Score row of each entity's last admission and, inside it, last stay."""
    order = numeric_order("admission_id", "episode_id")
    return latest_by(scores, id_col, [*order, *tie_break])


def latest_flags(flags: DataFrame, id_col: str = "id", tie_break: Sequence[str] = ()) -> DataFrame:
    """Flag row of each entity's last admission."""
    return latest_by(flags, id_col, [*numeric_order("admission_id"), *tie_break])


def wide_to_tuples(df: DataFrame, names: Mapping[str, str], keys: Sequence[str] = ("id",)) -> DataFrame:
    """Columns to ``(keys, feature, value)`` rows, renamed, from a single scan."""
    renamed = df.select(*keys, *[F.col(c).cast("double").alias(n) for c, n in names.items()])
    return renamed.unpivot(list(keys), list(names.values()), "feature", "value")


def base_tuples(cohort: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Age at the index date and sex of every cohort member."""
    return wide_to_tuples(cohort, {"age": "patient_age", "is_male": "patient_sex"}, keys)

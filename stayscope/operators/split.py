"""Train and test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stayscope.operators.skew import skew_join

_BUCKETS = 10_000


def split_by_ids(
    df: DataFrame, held_out_ids: DataFrame, id_col: str = "id", **skew: int
) -> tuple[DataFrame, DataFrame]:
    """``(train, held_out)``: rows whose entity is not, or is, in the held-out list."""
    ids = held_out_ids.select(id_col).distinct()
    train = skew_join(df, ids, id_col, how="left_anti", **skew)
    return train, skew_join(df, ids, id_col, how="left_semi", **skew)


def split_bucket(id_col: Column, seed: int = 11) -> Column:
    """A bucket in ``[0, 10000)`` that depends on the id and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), id_col.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % _BUCKETS


def split_by_hash(
    df: DataFrame, id_col: str = "id", fraction: float = 0.7, seed: int = 11
) -> tuple[DataFrame, DataFrame]:
    """A repeatable random split: the same id falls on the same side however data is laid out."""
    first = split_bucket(F.col(id_col), seed) < round(fraction * _BUCKETS)
    return df.filter(first), df.filter(~first)


def with_fold(df: DataFrame, folds: int = 5, id_col: str = "id", seed: int = 11, name: str = "fold") -> DataFrame:
    """``df`` plus the fold of each row, from 0; an id has the same fold however data is laid out."""
    return df.withColumn(name, (split_bucket(F.col(id_col), seed) % folds).cast("int"))


def split_random(
    df: DataFrame, fraction: float = 0.7, seed: int = 11
) -> tuple[DataFrame, DataFrame]:
    """Spark's row-wise random split; its outcome depends on the partitioning."""
    train, test = df.randomSplit([fraction, 1.0 - fraction], seed=seed)
    return train, test

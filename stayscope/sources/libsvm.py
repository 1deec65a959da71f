"""LIBSVM text files of labelled sparse vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_libsvm(spark: SparkSession, path: str, n_features: int) -> DataFrame:
    """``label`` and ``features``; the width is given so that two files always agree."""
    return spark.read.format("libsvm").option("numFeatures", n_features).load(path)


def read_libsvm_entries(spark: SparkSession, path: str) -> DataFrame:
    """The same files in long form: one row ``(label, idx, value)`` per stored entry."""
    parts = F.split(F.trim(F.col("value")), r"\s+")
    rows = spark.read.text(path).select(
        F.element_at(parts, 1).cast("double").alias("label"),
        F.explode(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))).alias("entry"),
    )
    pair = F.split("entry", ":")
    return rows.select(
        "label",
        (F.element_at(pair, 1).cast("int") - 1).alias("idx"),
        F.element_at(pair, 2).cast("double").alias("value"),
    )

"""Scan helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread_scan(scan: DataFrame, key: str) -> DataFrame:
    """Shuffle a just-read table by ``key`` if it has fewer splits than there are cores.

    A small table in one row group would keep a single core busy with costly expressions.
    A table with enough splits is returned as it is. ``scan`` must not hold a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, key)

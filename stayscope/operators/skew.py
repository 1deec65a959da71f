"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stayscope.storage import materialise

MAX_HOT_KEYS = 10_000
MIN_HOT_ROWS = 1_000_000
SMALL_BYTES = 256 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; for scans and filters it follows from the file sizes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_scan(df: DataFrame) -> bool:
    """Whether ``df`` only reads, filters and projects one table, so that reading it again is cheap."""
    plan = str(df._jdf.queryExecution().optimizedPlan().toString())
    nodes = [re.match(r"[\s:+\-]*(\w+)", line)[1] for line in plan.splitlines() if line.strip()]
    return all(n in ("Project", "Filter", "Relation", "LocalRelation", "LogicalRDD") for n in nodes)


def hot_keys(
    df: DataFrame,
    key: str | Sequence[str],
    max_keys: int = MAX_HOT_KEYS,
    min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """The most frequent keys with at least ``min_rows`` rows, ``max_keys`` at most.

    Any key left out holds less than ``1 / max_keys`` of all rows or less than
    ``min_rows``, so the bound on this table is also a bound on what one shuffle partition
    receives for a single key. The limit picks a join strategy for a key; no row is lost
    by it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    frequent = counted.filter(F.col("_rows") >= min_rows)
    for k in keys:
        frequent = frequent.filter(F.col(k).isNotNull())
    return frequent.orderBy(F.desc("_rows"), *keys).limit(max_keys).select(*keys)


def skew_join(
    many: DataFrame,
    one: DataFrame,
    key: str | Sequence[str],
    residual: Column | None = None,
    how: str = "inner",
    max_keys: int = MAX_HOT_KEYS,
    min_rows: int = MIN_HOT_ROWS,
    small_bytes: int = SMALL_BYTES,
) -> DataFrame:
    """Inner, semi or anti equi-join of ``many`` with ``one``, which holds one row per key.

    Rows with a hot key never travel: the few matching rows of ``one`` (no more than
    ``max_keys``) are broadcast to them. The rest is an ordinary join on the key, for
    which Catalyst and AQE choose the strategy. Below ``small_bytes`` even a single key
    fits one task, and looking for hot keys would only cost another scan.

    ``many`` is read up to three times and ``one`` twice, so either is written first if it is more
    than a scan; the size of ``many`` is then that of its files and no longer a guess.
    """
    if how not in ("inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    keys = [key] if isinstance(key, str) else list(key)
    small = estimated_bytes(many) <= small_bytes
    if not small and not is_scan(many):
        many = materialise(many, "skew-many")
        small = estimated_bytes(many) <= small_bytes
    if not small and not is_scan(one):
        one = materialise(one, "skew-one")
    if small:
        joined = many.join(one, keys, how)
    else:
        hot = F.broadcast(hot_keys(many, keys, max_keys, min_rows))
        hot_one = F.broadcast(one.join(hot, keys, "left_semi"))
        hot_rows = many.join(hot, keys, "left_semi").join(hot_one, keys, how)
        cold_rows = many.join(hot, keys, "left_anti").join(one, keys, how)
        joined = hot_rows.unionByName(cold_rows)
    return joined if residual is None else joined.filter(residual)

"""Positions and running totals over a total order, without a single-task window.

The rows are range-partitioned, so each partition is one block of the order. Blocks are
summed into one small row each; a block's offset plus the position inside the block gives
the global value. The partitioned rows are written once, because the block a row fell
into must not change between the two passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stayscope.storage import materialise

_BLOCK = "_block"
# monotonically_increasing_id keeps the row position of a partition in its low 33 bits.
_ROW_BITS = 33


def _offsets(stored: DataFrame, totals: dict[str, Column]) -> dict[str, Column]:
    """Per total, the sum over all earlier blocks as a lookup by block number.

    The block sums come to the driver: one row of numbers per partition of the range
    shuffle, so never more than ``spark.sql.shuffle.partitions`` rows.
    """
    sums = [total.alias(name) for name, total in totals.items()]
    blocks = sorted(stored.groupBy(_BLOCK).agg(*sums).collect(), key=lambda r: r[_BLOCK])
    size = blocks[-1][_BLOCK] + 1 if blocks else 1
    lookups = {}
    for name in totals:
        before, table, at = 0, [0] * size, 0
        for block in blocks:
            for gap in range(at, block[_BLOCK] + 1):
                table[gap] = before
            at = block[_BLOCK] + 1
            before += block[name] or 0
        numbers = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")
        lookups[name] = F.get(numbers, F.col(_BLOCK).cast("int"))
    return lookups


def with_position(df: DataFrame, order: Sequence[str | Column], name: str = "idx") -> DataFrame:
    """Add the 0-based position of each row in ``order``, dense over the whole table."""
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn(_BLOCK, F.shiftright("_row", _ROW_BITS))
    )
    stored = materialise(placed, "positions")
    local = F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    offset = _offsets(stored, {"n": F.count(F.lit(1))})["n"]
    return stored.select(*df.columns, (offset + local).alias(name))


def with_running_totals(
    df: DataFrame, order: Sequence[str | Column], totals: dict[str, Column]
) -> DataFrame:
    """Add, per entry of ``totals``, the integer sum over all rows strictly earlier in ``order``.

    ``order`` must be unique per row; aggregate ties first.
    """
    placed = df.repartitionByRange(*order).withColumn(_BLOCK, F.spark_partition_id())
    stored = materialise(placed, "totals")
    offsets = _offsets(stored, {name: F.sum(value) for name, value in totals.items()})
    earlier = (
        Window.partitionBy(_BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    before = [
        (offsets[name] + F.coalesce(F.sum(value).over(earlier), F.lit(0))).alias(name)
        for name, value in totals.items()
    ]
    return stored.select(*df.columns, *before)

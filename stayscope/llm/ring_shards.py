"""Sharding by a consistent-hash ring with virtual nodes and bounded loads; DataFrame functions only.

Each shard owns ``vnodes`` points of a 64-bit ring. A row's hash lies on the arc that ends at the
next point clockwise, its home. A shard takes at most its capacity; rows that overflow a full
shard continue clockwise, first come first served, and take the first shards with room. With
``slack`` 0 the capacities add up to the number of rows, so counts differ by one at most; with
``slack`` e a shard takes up to (1 + e) times its share and fewer rows leave their home.

Scale. What flows along the ring is decided from one count per arc: ``shards * vnodes`` numbers,
fixed by parameters, are all that reaches the driver. Rows need only their rank on their arc,
from one narrow shuffle (no text) by arc, and then find their shard and slot among the few
segments that their arc was cut into.

Moves. Adding a shard moves the arcs that its points cut off, and, as the capacities shrink, rows
at the ends of the queues of full shards; rows inside their home's capacity stay.

Edge cases: null text has no bytes; a null id is placed by its text. Rows of one id lie on one
arc next to each other, ordered by size and checksum; identical rows are interchangeable. An empty
table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayscope.llm.common import text_or_empty

SHARDS = 40
VNODES = 128
ROW_OVERHEAD = 16
#: The ring is cut into 2^CELL_BITS equal cells to find the next point without a search.
CELL_BITS = 14


def ring(spark, shards: int, vnodes: int) -> list[tuple[int, int]]:
    """``(point, shard)`` of every virtual node in ring order."""
    points = spark.range(shards * vnodes).select(
        F.xxhash64(F.lit("point"), (F.col("id") / vnodes).cast("int"), F.col("id") % vnodes).alias("point"),
        F.floor(F.col("id") / vnodes).cast("int").alias("shard"),
    )
    return sorted((r.point, r.shard) for r in points.collect())


def _cells(spark, points: list[tuple[int, int]]) -> DataFrame:
    """For each cell the points in it and the first one after it, in order, with their arcs."""
    per_cell: dict[int, list[tuple[int, int]]] = {}
    for arc, (point, _) in enumerate(points):
        per_cell.setdefault(point >> (64 - CELL_BITS), []).append((point, arc))
    rows, following = [], 0
    for cell in range((1 << (CELL_BITS - 1)) - 1, -(1 << (CELL_BITS - 1)) - 1, -1):
        inside = per_cell.get(cell, [])
        # Beyond the last point of all, the ring continues at its first.
        rows.append((cell, [*inside, ((1 << 63) - 1, following)]))
        following = inside[0][1] if inside else following
    return spark.createDataFrame(rows, "cell bigint, points array<struct<point:bigint,arc:int>>")


def placed(docs: DataFrame, points: list[tuple[int, int]]) -> DataFrame:
    """Rows with their place on the ring: ``doc_id, size, text_crc32, at, arc``."""
    text = text_or_empty()
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit("text"), text))
        .otherwise(F.xxhash64(F.lit("row"), "doc_id"))
        .alias("at"),
    )
    return _on_arcs(rows, points)


def _on_arcs(rows: DataFrame, points: list[tuple[int, int]]) -> DataFrame:
    """``rows`` plus ``arc``, the arc of the ring that ``at`` lies on."""
    spark = rows.sparkSession
    cells = F.broadcast(_cells(spark, points))  # 2^CELL_BITS rows at any size of the input
    cell = F.shiftright("at", 64 - CELL_BITS)
    arc = F.get(F.filter("points", lambda p: p["point"] >= F.col("at")), 0)["arc"]
    return rows.withColumn("cell", cell).join(cells, "cell", "left").select(*rows.columns, arc.alias("arc"))


def capacities(n: int, shards: int, slack: float) -> list[int]:
    """Rows each shard takes at most; at ``slack`` 0 they add up to ``n``."""
    if slack:
        return [-(-int(n * (1 + slack)) // shards)] * shards
    return [n // shards + (k < n % shards) for k in range(shards)]


def flow(
    homes: dict[int, int], points: list[tuple[int, int]], room: list[int]
) -> list[tuple[int, int, int, int, int]]:
    """Segments ``(arc, from_rank, to_rank, shard, first_slot)`` that together hold every row.

    One walk of at most two turns. At each point its own arc's rows go first, then those that
    earlier points sent on, in the order in which they were sent.
    """
    filled = [0] * len(room)
    room = list(room)
    segments, queue = [], []
    for turn in range(2):
        for arc, (_, shard) in enumerate(points):
            if turn == 0 and (n := homes.get(arc, 0)):
                take = min(n, room[shard])
                if take:
                    segments.append((arc, 0, take, shard, filled[shard]))
                    filled[shard] += take
                    room[shard] -= take
                if take < n:
                    queue.append((arc, take, n))
            while queue and room[shard]:
                source, start, end = queue[0]
                take = min(end - start, room[shard])
                segments.append((source, start, start + take, shard, filled[shard]))
                filled[shard] += take
                room[shard] -= take
                if start + take == end:
                    queue.pop(0)
                else:
                    queue[0] = (source, start + take, end)
    if queue:
        raise ValueError("the capacities are smaller than the number of rows")
    return segments


def shard_rows(
    docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, slack: float = 0.0
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: slots of a shard run from 0 without gaps."""
    spark = docs.sparkSession
    points = ring(spark, shards, vnodes)
    rows = placed(docs, points)
    # Rows with an id are counted without reading their text; those without one apart.
    with_id = docs.where(F.col("doc_id").isNotNull()).select(F.xxhash64(F.lit("row"), "doc_id").alias("at"))
    without = placed(docs.where(F.col("doc_id").isNull()), points)
    homes: dict[int, int] = {}
    for part in (_on_arcs(with_id, points), without):
        for r in part.groupBy("arc").count().collect():
            homes[r.arc] = homes.get(r.arc, 0) + r["count"]
    segments = flow(homes, points, capacities(sum(homes.values()), shards, slack))
    by_arc: dict[int, list] = {}
    for arc, *segment in segments:
        by_arc.setdefault(arc, []).append(tuple(segment))
    cuts = spark.createDataFrame(
        list(by_arc.items()),
        "arc int, segments array<struct<start:bigint,end:bigint,shard:int,slot:bigint>>",
    )
    order = Window.partitionBy("arc").orderBy("at", "doc_id", "size", "text_crc32")
    ranked = rows.withColumn("rank", F.row_number().over(order) - 1)
    own = F.get(F.filter("segments", lambda s: (s["start"] <= F.col("rank")) & (F.col("rank") < s["end"])), 0)
    return (
        ranked.join(F.broadcast(cuts), "arc")
        .withColumn("own", own)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.col("own.shard").alias("shard"),
            (F.col("own.slot") + F.col("rank") - F.col("own.start")).alias("slot"),
        )
    )

"""Benchmark passages in training text: a broadcast hash set of test n-grams, verified hits.

Words are runs of ASCII letters and digits and characters beyond ASCII, A-Z lower-cased. A
benchmark item's windows are its runs of ``width`` words; an item of fewer words is one window.
A document word inside any occurrence of a window is hit.

Method. The windows of the benchmark, with their hashes and items, go to every task as one
broadcast; a task scans all windows of its documents with numpy, looks their hashes up in a bit
table and then in the set, and compares the words themselves before a hit counts. Documents are
not shuffled.

The broadcast is bounded: windows are counted first, and beyond ``block_windows`` they are cut
into blocks by hash that are scanned one after another, the hits so far carried along in the
rows, so any benchmark gives the whole result.

Edge cases: a null or wordless text has no words, no hits, and as an item no window. The windows of an
item with a null id hit words like any other; ``hit_items`` leaves the null out. Repeated rows
and ids are judged row by row; repeated items with one id count once. An empty benchmark hits
nothing, an empty table gives none. Other columns pass through; clashing names are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.llm.common import map_text, prefixed, ship
from stayscope.llm.hashing import BY_ALNUM, Words, window_hashes
from stayscope.storage import materialise

WIDTH = 10
#: Windows in one broadcast: about 200 bytes each in a Python worker, so 50 MB.
BLOCK_WINDOWS = 250_000
OUTPUTS = [
    ("n_words", "bigint"),
    ("hit_words", "array<struct<start:int,end:int>>"),
    ("hit_spans", "array<struct<start:int,end:int>>"),
    ("hit_items", "array<string>"),
]


def benchmark_windows(benchmark: DataFrame, width: int) -> DataFrame:
    """``hash, words, n, items``: each distinct window of the benchmark once."""

    def start():
        def kernel(texts):
            found = []
            for text in texts:
                w = Words(text, BY_ALNUM)
                n = min(width, len(w))
                hashes = window_hashes(w.hashes, n) if n else []
                found.append([(int(h.view(np.int64)), w.joined(i, i + n), n) for i, h in enumerate(hashes)])
            return [found]

        return kernel

    items = benchmark.select("item_id", "text")
    windows = map_text(
        items, "text", [("windows", "array<struct<hash:bigint,words:binary,n:int>>")], start, keep_text=False
    )
    each = windows.select(F.col("item_id").cast("string").alias("item"), F.inline("windows"))
    # A set of null ids is empty: such a window hits words and names no item.
    return each.groupBy("hash", "words", "n").agg(F.sort_array(F.collect_set("item")).alias("items"))


class Index:
    """The windows of one block: a bit table over hashes, then the words and items by hash."""

    def __init__(self, rows):
        self.by_hash: dict[int, list[tuple[bytes, int, list[str]]]] = {}
        lengths: dict[int, list[int]] = {}
        for r in rows:
            self.by_hash.setdefault(r.hash, []).append((bytes(r.words), r.n, list(r.items)))
            lengths.setdefault(r.n, []).append(r.hash)
        self.bits = max(20, len(self.by_hash).bit_length() + 5)
        self.tables = {}
        for n, hashes in lengths.items():
            table = np.zeros(1 << self.bits, dtype=bool)
            table[self._slot(np.array(hashes, dtype=np.int64).view(np.uint64))] = True
            self.tables[n] = table

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def hits(self, words: Words) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges of the verified occurrences, and the items whose windows occur."""
        ranges, items = [], set()
        for n, table in self.tables.items():
            hashes = window_hashes(words.hashes, n)
            for i in np.flatnonzero(table[self._slot(hashes)]):
                for text, length, holders in self.by_hash.get(int(hashes[i].view(np.int64)), ()):
                    if length == n and words.joined(i, i + n) == text:
                        ranges.append((int(i), int(i) + n))
                        items.update(holders)
        return ranges, items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint ranges in order that cover the same words; touching ranges become one."""
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _spans(text: str, words: Words, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point spans of word ranges."""
    raw, spans, chars, at = text.encode("utf-8", "surrogatepass"), [], 0, 0
    for first, last in ranges:
        start, end = int(words.starts[first]), int(words.ends[last - 1])
        begin = chars + len(raw[at:start].decode("utf-8", "surrogatepass"))
        chars = begin + len(raw[start:end].decode("utf-8", "surrogatepass"))
        spans.append((begin, chars))
        at = end
    return spans


def _scan(docs: DataFrame, text_col: str, rows, keep_text: bool = True) -> DataFrame:
    """``docs`` plus the outputs for one block of windows."""
    index = Index(rows)  # goes to the tasks with the function; Spark broadcasts large ones

    def start():
        def kernel(texts):
            columns = [[], [], [], []]
            for text in texts:
                words = Words(text, BY_ALNUM)
                ranges, items = index.hits(words)
                ranges = merged(ranges)
                row = len(words), ranges, _spans(text, words, ranges), sorted(items)
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            return columns

        return kernel

    return map_text(docs, text_col, OUTPUTS, start, keep_text)


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    width: int = WIDTH,
    block_windows: int = BLOCK_WINDOWS,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` plus ``n_words``, ``hit_words``, ``hit_spans`` and ``hit_items``.

    Ranges of words and spans of code points are disjoint and in order, ends exclusive.
    """
    windows = materialise(benchmark_windows(benchmark, width), "benchmark-windows")
    n_blocks = max(1, -(-windows.count() // block_windows))
    if n_blocks == 1:
        return _scan(docs, text_col, windows.collect(), keep_text)
    names = [name for name, _ in OUTPUTS]
    held = docs.drop(*names)
    for b in range(n_blocks):
        rows = windows.where(F.pmod("hash", F.lit(n_blocks)) == b).collect()
        so_far = [F.col(c).alias(f"{c}_so_far") for c in names if b]
        found = _scan(held.select(*held.drop(*(names if b else [])).columns, *so_far), text_col, rows)
        if b:
            found = found.withColumns(
                {
                    "hit_words": F.concat("hit_words_so_far", "hit_words"),
                    "hit_items": F.array_sort(F.array_union("hit_items_so_far", "hit_items")),
                    "hit_spans": F.concat("hit_spans_so_far", "hit_spans"),
                }
            ).withColumns({c: _merged_column(c) for c in ("hit_words", "hit_spans")})
            found = found.drop(*[f"{c}_so_far" for c in names])
        # One block's scan ends before the next begins, so a task never holds two blocks.
        held = materialise(found, "benchmark-block")
    return held if keep_text else held.drop(text_col)


def _merged_column(name: str):
    """``merged`` over an array column; a span ends where the next begins at the latest."""
    nothing = F.slice(name, 1, 0)

    def add(acc, x):
        last = F.element_at(acc, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        meets = (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= x["start"])
        return F.when(
            meets, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(grown))
        ).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.array_sort(name), nothing, add)


def n_hit():
    """Words hit, from the ranges of ``scan``."""
    return F.aggregate(
        "hit_words", F.lit(0).cast("bigint"), lambda acc, r: acc + (r["end"] - r["start"]).cast("bigint")
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, action: str = "document", text_col: str = "text", **limits
) -> DataFrame:
    """``docs`` without contaminated documents, or (``action="span"``) without their hit spans."""
    held, own = prefixed(docs, docs.columns, "own_")
    text = f"own_{text_col}"
    found = scan(held, benchmark, text, **limits)
    if action == "document":
        cleaned = found.where(F.size("hit_words") == 0)
    elif action == "span":
        cleaned = found.withColumn(text, _without_spans(F.col(f"`{text}`")))
    else:
        raise ValueError(f"unknown action: {action}")
    return cleaned.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(own, docs.columns, strict=True)])


def _without_spans(text: Column) -> Column:
    """The text without its ``hit_spans``; as it is, null included, if there are none."""
    pieces = F.aggregate(
        "hit_spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            s["end"].alias("at"),
            F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"])).alias("out"),
        ),
    )
    rest = F.substring(text, pieces["at"] + 1, F.char_length(text))
    return F.when(F.size("hit_words") == 0, text).otherwise(F.concat(pieces["out"], rest))


ship(__name__)

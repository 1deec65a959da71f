"""Lines repeated across documents, as compressed per-document bitmaps; DataFrame functions only.

A line's key is the line stripped of white space at both ends, A-Z lower-cased. A key of at
least ``min_chars`` code points that at least ``min_documents`` documents hold loses its lines
in all of them but the one with the largest id.

Method. Only 128-bit hashes of keys travel, never text. They are range-partitioned by hash and
document, so a line that a third of the corpus repeats is spread over many tasks, and sorted
within the partition by hash, document and position, once; a row number that restarts with every
hash and document streams the first occurrences out of that order, without a second exchange, and a
map-side combined aggregation leaves one row per hash. The lines to drop come back as sparse bitmaps, the non-zero 64-bit
words only, one row per document.

The text is shuffled once, and only by ``apply_bitmaps``, which needs both sides together.

Edge cases: a null or empty text is one empty line, which is never dropped for being short.
A very long text is split whole: its lines are rows of their own until they are bits again.
A null id is smaller than any other; if all holders of a key have null ids the lines stay.
Rows are told apart by id and text: identical rows share one bitmap, and rows of one id count as
one document. Columns of the caller are kept, whatever their names; an empty table gives none.
Two different keys meet in 128 bits of hash with a chance of n^2 / 2^129.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayscope.llm.common import WHITE, ascii_lower, let, text_or_empty
from stayscope.storage import materialise

MIN_CHARS = 20
MIN_DOCUMENTS = 3
HASH = ["h1", "h2"]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(F.col(f"`{text_col}`"))
    return docs.select(
        F.col(f"`{id_col}`").alias("doc"), F.xxhash64(text).alias("row"), F.split(text, "\n").alias("lines")
    )


def keyed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One narrow row per line whose key is long enough: document, row, position, key hash."""
    exploded = _rows(docs, id_col, text_col).select("doc", "row", F.posexplode("lines").alias("pos", "line"))
    keyed = exploded.select(
        "doc", "row", "pos", ascii_lower(F.btrim("line", F.lit(WHITE))).alias("key")
    ).where(F.char_length("key") >= min_chars)
    return keyed.select(
        "doc", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(min_chars), "key").alias("h2")
    )


def first_occurrences(lines: DataFrame) -> DataFrame:
    """The first of each document's rows of a hash, streamed from the rows in order.

    A window's group is one line of one document, so no group grows with the corpus.
    """
    in_order = lines.repartitionByRange(*HASH, "doc").sortWithinPartitions(*HASH, "doc", "pos")
    place = F.row_number().over(Window.partitionBy(*HASH, "doc").orderBy("pos"))
    return in_order.withColumn("place", place).where("place = 1").drop("place")


def keep_bitmaps(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """``doc, row, dropped, n_dropped`` for each row that loses lines.

    ``dropped`` holds the non-zero words of the row's bitmap as (word, bits), bit ``pos % 64`` of
    word ``pos / 64`` set where the line at ``pos`` goes; all other lines stay. ``row`` hashes the
    text, to tell rows of one id apart.
    """
    lines = materialise(keyed_lines(docs, id_col, text_col, min_chars), "dedup-lines")
    # Both the range partitioning and the order within serve the window: one exchange, one sort.
    first_in_doc = first_occurrences(lines)
    repeated = (
        first_in_doc.groupBy(*HASH)
        .agg(F.count("*").alias("n_docs"), F.max("doc").alias("keeper"))
        .where((F.col("n_docs") >= min_documents) & F.col("keeper").isNotNull())
    )
    # Stored, so that both sides of the join are dealt for it and Spark can split a hot hash.
    repeated = materialise(repeated, "dedup-repeated")
    dropped = lines.join(repeated, HASH).where(F.coalesce(F.col("doc") < F.col("keeper"), F.lit(True)))
    words = dropped.groupBy("doc", "row", F.shiftright("pos", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits")
    )
    return words.groupBy("doc", "row").agg(
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped"),
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
    )


def _dense(dropped: Column) -> Column:
    """All words of a sparse bitmap up to its last, so that a bit is found by position."""

    def padded(x: Column, i: Column) -> Column:
        before = F.coalesce(F.get(dropped, i - 1)["word"], F.lit(-1))
        return F.concat(
            F.array_repeat(F.lit(0).cast("long"), x["word"] - before - 1), F.array(x["bits"])
        )

    return F.flatten(F.transform(dropped, padded))


def _kept_text(text: Column, dropped: Column) -> Column:
    def without(bits: Column) -> Column:
        def stays(_: Column, i: Column) -> Column:
            word = F.coalesce(F.get(bits, F.shiftright(i, 6)), F.lit(0).cast("long"))
            return F.getbit(word, i % 64) == 0

        return F.array_join(F.filter(F.split(text, "\n"), stays), "\n")

    return F.when(dropped.isNull(), text).otherwise(let(_dense(dropped), without))


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row of ``docs`` with its text replaced by the lines that stay.

    Adds ``n_lines`` (before) and ``n_dropped``, replacing columns of those names. A row without
    dropped lines keeps its text as it is, null included.
    """
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    text = text_or_empty(F.col("held")[text_col])
    left = docs.select(held.alias("held")).withColumns(
        {"join_id": F.col("held")[id_col], "join_row": F.xxhash64(text)}
    )
    joined = left.join(
        bitmaps.hint("shuffle_hash"),
        F.col("join_id").eqNullSafe(F.col("doc")) & (F.col("join_row") == F.col("row")),
        "left",
    )
    out = {c: F.col("held")[c] for c in docs.columns}
    out[text_col] = F.when(F.col("dropped").isNull(), F.col("held")[text_col]).otherwise(
        _kept_text(text, F.col("dropped"))
    )
    out["n_lines"] = F.size(F.split(text, "\n")).cast("long")
    out["n_dropped"] = F.coalesce("n_dropped", F.lit(0)).cast("long")
    return joined.select(*[c.alias(name) for name, c in out.items()])


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with repeated lines removed, and ``n_lines`` and ``n_dropped``."""
    return apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, **limits), id_col, text_col)

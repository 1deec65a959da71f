"""Readers and column expressions that several operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
#: Bytes of text that a Python kernel holds at once, unless one text alone is longer.
BATCH_CHARS = 4_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table, so that the scan reads no others."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def ship(module: str) -> None:
    """Send a module's functions to the workers by value: they need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; all-ASCII strings take the byte-wise path of lower()."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it.

    A plain column would be copied into every lambda that mentions it and evaluated per
    element; a lambda's own variable is bound once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def prefixed(df: DataFrame, columns: list[str], prefix: str) -> tuple[DataFrame, list[str]]:
    """``df`` cut to ``columns`` under names that cannot clash with the caller's own."""
    names = [prefix + c for c in columns]
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names, strict=True)]), names


def map_text(
    docs: DataFrame, text_col: str, outputs: list[tuple[str, str]], start: Callable, keep_text: bool = True
) -> DataFrame:
    """``docs`` plus the columns that a Python kernel computes from each whole text, in Arrow batches.

    ``start()`` runs once per task and returns the kernel, a function from a list of strings
    (null given as empty) to one list or Arrow array per output. ``outputs`` are (name, type) pairs; they
    replace columns of those names. Nothing is shuffled; all other columns pass through as they
    are. Spark bounds an Arrow batch by rows; what the kernel sees of it at once is cut further by
    characters, as texts vary.
    """
    made = {name for name, _ in outputs}
    kept = [c for c in docs.columns if c not in made and (keep_text or c != text_col)]
    given = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    # A text that is kept anyway travels once.
    at_text = kept.index(text_col) if text_col in kept and docs.schema[text_col].dataType == StringType() else len(kept)
    if at_text == len(kept):
        given = docs.select(
            *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(f"`{text_col}`").cast("string").alias("t")
        )
    schema = StructType(
        [
            *[StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(kept)],
            *[StructField(f"o{i}", _parse_datatype_string(kind)) for i, (_, kind) in enumerate(outputs)],
        ]
    )
    arrow = [to_arrow_schema(StructType([f])).field(0).type for f in schema.fields[len(kept) :]]
    names = schema.names
    limit, n_kept = BATCH_CHARS, len(kept)

    def run(batches):
        kernel = start()
        for batch in batches:
            n, at = batch.num_rows, 0
            sizes = pc.fill_null(pc.binary_length(batch.column(at_text)), 0).to_pylist()
            while at < n:
                end, held = at + 1, sizes[at]
                while end < n and held + sizes[end] <= limit:
                    held += sizes[end]
                    end += 1
                part = batch.slice(at, end - at)
                texts = [x or "" for x in part.column(at_text).to_pylist()]
                columns = zip(kernel(texts), arrow, strict=True)
                made_now = [x if isinstance(x, pa.Array) else pa.array(x, type=t) for x, t in columns]
                yield pa.RecordBatch.from_arrays([*part.columns[:n_kept], *made_now], names=names)
                at = end

    out = given.mapInArrow(run, schema)
    return out.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)],
        *[F.col(f"o{i}").alias(name) for i, (name, _) in enumerate(outputs)],
    )


ship(__name__)

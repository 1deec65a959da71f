"""The corpus pipeline: stages that each apply one operator to all that the one before kept.

Every stage takes and returns whole documents with the columns of the input table; the last gives
the pieces of each remaining text. ``run`` writes each stage's result as Parquet into the shared
folder and reads it again, so a lost executor never costs more than the stage that is running.

Edge cases are those of the operators: a null text has too few words and goes in the first stage.
Columns besides ``doc_id`` and ``text`` pass through; ``n_chars``, if there is one, follows the text.
Rows of one id are one document: near-duplicate rows of the kept id stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayscope.llm import decontaminate, line_dedup, ngram_join, quality_ledger, sentence_pieces
from stayscope.llm.common import table
from stayscope.llm.queries import model_path
from stayscope.storage import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the production policy of quality rules."""
    return quality_ledger.apply_policy(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that the line rule drops."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    own = [f"own_{c}" for c in others]
    kept = line_dedup.dedup_lines(docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(n) for c, n in zip(others, own)]))
    new = dict(zip(others, own, strict=True)) | {"doc_id": "doc_id", "text": "text"}
    length = {"n_chars": F.char_length("text").cast("long")}
    return kept.select(*[length.get(c, F.col(f"`{new[c]}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of linked ones."""
    found = ngram_join.near_duplicates(docs)
    gone = materialise(
        found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct(), "near-duplicates"
    )
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text's pieces, their number, and the text that they decode to."""
    return sentence_pieces.round_trip(docs.select("doc_id", "text"), model_path(), keep_text=False).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded"
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("decontamination", decontaminated),
    ("sentencepiece", pieces),
]
#: SQL cannot express the last stage, so run() has no SQL twin.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": run}
ORACLES: dict[str, str] = {}

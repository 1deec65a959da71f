"""Free text per entity: concatenation, term counts, vocabulary, topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from stayscope import schemas
from stayscope.functions import text as tx
from stayscope.operators.events import at_precision
from stayscope.operators.matrix import as_vectors, join_lookup, sparse_rows
from stayscope.operators.ordered import with_position, with_running_totals
from stayscope.operators.skew import skew_join
from stayscope.storage import materialise, use_checkpoints

# Topic model size.
TOPICS = 50
TOPIC_ITERATIONS = 25

MAX_CUTOFFS = 63


def concat_notes(
    notes: DataFrame, order: Sequence[str], id_col: str = "id", text_col: str = "text"
) -> DataFrame:
    """An entity's whole text in reading order, as ``(id, position, start_char, text)``.

    One row per note at any size: ``position`` counts from 0 within the entity, and
    ``start_char`` is where the note begins in the entity's texts joined by one space. So no
    row and no task has to hold an entity's whole history, and a reader may join as much of
    it as fits. A null text counts as empty. Every note comes out once: null ids are one entity, a
    null in ``order`` comes first, and notes with equal keys follow each other in any order.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    numbers = notes.select(id_col, *order, text.alias("_text"), F.monotonically_increasing_id().alias("_note"))
    # Written once, so that a note has the same number on both sides of the join.
    stored = materialise(numbers, "notes")
    # Only keys and lengths are sorted and numbered; the texts travel once, to meet their number.
    lengths = stored.select(id_col, *order, "_note", (F.length("_text") + 1).alias("_chars"))
    placed = with_running_totals(
        lengths, [id_col, *order, "_note"], {"_before": F.col("_chars"), "_place": F.lit(1)}
    ).withColumn("_entity", F.struct(id_col))  # a struct is never null, and equal if its fields are null
    starts = placed.groupBy("_entity").agg(
        F.min("_before").alias("_first_before"), F.min("_place").alias("_first_place")
    )
    numbered = skew_join(placed, starts, "_entity").select(
        "_note",
        (F.col("_place") - F.col("_first_place")).alias("position"),
        (F.col("_before") - F.col("_first_before")).alias("start_char"),
    )
    return stored.select(id_col, "_note", F.col("_text").alias("text")).join(numbered, "_note").select(
        id_col, "position", "start_char", "text"
    )


def note_tokens(
    notes: DataFrame,
    keep: Sequence[str],
    text_col: str = "text",
    stop_words: Sequence[str] = (),
    inner: bool = False,
) -> DataFrame:
    """One row per cleaned token that is not a stop word, with the columns of ``keep``.

    Each text is cleaned on its own, so an entity's texts never need to be joined first.
    ``inner=True`` says that a text is one of several of its entity: a lone letter at its
    edge then counts as surrounded by spaces, as it would be in the joined text.
    """
    text = F.col(text_col)
    if inner:
        text = F.concat(F.lit(" "), text, F.lit(" "))
    words = tx.tokens(tx.clean_text(text), stop_words)
    return notes.select(*keep, F.explode(words).alias("term"))


def term_counts(
    notes: DataFrame,
    id_col: str = "id",
    text_col: str = "text",
    stop_words: Sequence[str] = (),
    inner: bool = False,
) -> DataFrame:
    """How often each term occurs per entity: ``(id, term, n)``."""
    words = note_tokens(notes, [id_col], text_col, stop_words, inner)
    return words.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("n"))


def term_counts_grid(
    notes: DataFrame,
    cutoffs: DataFrame,
    names: Sequence[str],
    id_col: str = "id",
    ts_col: str = "ts",
    text_col: str = "text",
    stop_words: Sequence[str] = (),
    precision: str = "timestamp",
    **skew: int,
) -> DataFrame:
    """Term counts up to several cutoffs from one pass over the notes.

    One column per cutoff holds the count, so a note is joined, cleaned and split once.
    A long has a bit for each of at most 63 cutoffs.
    """
    if len(names) > MAX_CUTOFFS:
        raise ValueError(f"at most {MAX_CUTOFFS} cutoffs fit one pass, got {len(names)}")
    notes = notes.withColumn(ts_col, at_precision(ts_col, precision))
    last = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    known = skew_join(notes, cutoffs, id_col, F.col(ts_col) <= last, **skew)
    # One bit per cutoff, set before the text is split, keeps the token rows narrow.
    bits = " + ".join(
        f"CASE WHEN `{ts_col}` <= `{n}` THEN {1 << k}L ELSE 0L END" for k, n in enumerate(names)
    )
    seen = known.select(id_col, F.expr(f"{bits} AS _seen"), F.col(text_col).alias("_text"))
    words = note_tokens(seen, [id_col, "_seen"], "_text", stop_words, inner=True)
    return words.groupBy(id_col, "term").agg(
        *[F.expr(f"count_if(_seen & {1 << k}L <> 0) AS `{n}`") for k, n in enumerate(names)]
    )


def vocabulary(
    counts: DataFrame, size: int | None = None, min_documents: int = 1
) -> DataFrame:
    """Terms by descending total count, indexed in that order.

    All terms by default. ``size`` keeps only the most frequent ones and ``min_documents``
    those of enough documents; both leave terms out, as :func:`dropped_terms` tells.
    """
    totals = counts.groupBy("term").agg(F.sum("n").alias("total"), F.count("n").alias("documents"))
    frequent = totals.filter(F.col("documents") >= min_documents)
    placed = with_position(frequent, [F.desc("total"), F.asc("term")])
    return placed if size is None else placed.filter(F.col("idx") < size)


def dropped_terms(counts: DataFrame, vocab: DataFrame) -> int:
    """How many terms a limited vocabulary leaves out."""
    return counts.select("term").distinct().join(vocab, "term", "left_anti").count()


def corpus_stats(counts: DataFrame, id_col: str = "id") -> DataFrame:
    """Documents, stored document-term pairs and tokens of a corpus."""
    per_document = counts.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("n").alias("tokens")
    )
    return per_document.agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.sum("pairs").alias("n_pairs"),
        F.sum("tokens").alias("n_tokens"),
    )


def index_terms(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """Term counts as ``(id, idx, value)``; terms outside the vocabulary drop out."""
    indexed = join_lookup(counts, vocab.select("term", "idx"), ["term"])
    return indexed.withColumn("value", F.col("n").cast("double")).drop("term", "n")


def note_vectors(
    counts: DataFrame, vocab: DataFrame, id_col: str = "id", size: int | None = None
) -> DataFrame:
    """Count vectors per entity over the vocabulary."""
    width = vocab.count() if size is None else size
    return as_vectors(sparse_rows(index_terms(counts, vocab), width, [id_col]))


def fit_topics(
    vectors: DataFrame, k: int = TOPICS, iterations: int = TOPIC_ITERATIONS, seed: int = 11
) -> LDAModel:
    """Topic model by expectation maximisation; its growing graph is checkpointed on the way."""
    use_checkpoints(vectors.sparkSession)
    lda = LDA(k=k, maxIter=iterations, optimizer="em", seed=seed, featuresCol="features")
    return lda.fit(vectors)


def topic_weights(
    model: LDAModel, vectors: DataFrame, id_col: str = "id", top: int | None = None
) -> DataFrame:
    """Feature tuples ``topic-<i>`` with the weight of each entity's strongest topics."""
    weights = vector_to_array("topicDistribution")
    ranked = F.transform(weights, lambda w, i: F.struct(w.alias("value"), i.alias("topic")))
    if top is not None:
        ranked = F.slice(F.reverse(F.array_sort(ranked)), 1, top)
    rows = model.transform(vectors).select(id_col, F.inline(ranked))
    name = F.concat(F.lit(schemas.TOPIC_PREFIX), F.col("topic").cast("string"))
    return rows.select(id_col, name.alias("feature"), "value")


def topic_terms(model: LDAModel, vocab: DataFrame, n_terms: int = 10) -> DataFrame:
    """The strongest terms of each topic: ``(topic, rank, term, weight)``."""
    pairs = F.arrays_zip("termIndices", "termWeights")
    described = model.describeTopics(n_terms).select("topic", F.posexplode(pairs).alias("rank", "_t"))
    rows = described.select(
        "topic",
        "rank",
        F.col("_t.termIndices").cast("long").alias("idx"),
        F.col("_t.termWeights").alias("weight"),
    )
    # k times n_terms rows.
    named = vocab.select("idx", "term").join(F.broadcast(rows), "idx")
    return named.select("topic", "rank", "term", "weight")

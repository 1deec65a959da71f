"""Feature tuples to sparse matrices: dictionary, indexing, vectors, labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stayscope.config import FeatureSet
from stayscope.operators.ordered import with_position, with_running_totals
from stayscope.operators.skew import skew_join
from stayscope.storage import materialise, new_path

#: Most bytes of a lookup table, counted as JSON text, that are sent to every task.
MAX_BROADCAST_BYTES = 128 * 1024 * 1024


def feature_set(tuples: DataFrame, families: Sequence[str]) -> DataFrame:
    """The bag of tuples that belong to the given families."""
    return tuples.filter(F.col("family").isin(list(families)))


def feature_dictionary(tuples: DataFrame) -> DataFrame:
    """Distinct feature names in ascending order with a dense 0-based ``idx``."""
    return with_position(tuples.select("feature").distinct(), ["feature"])


def join_lookup(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], max_broadcast: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Inner join with a measured lookup table: broadcast if small, else skew-safe.

    Its size in bytes is measured, not its rows: a term may be of any length.

    Names such as age and sex occur for every entity, so a plain shuffle on the name would
    put a large share of all rows into one task.
    """
    size = lookup.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    if size <= max_broadcast:
        return rows.join(F.broadcast(lookup), list(keys))
    return skew_join(rows, lookup, keys)


def index_tuples(
    tuples: DataFrame, dictionary: DataFrame, max_broadcast: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Replace feature names by their index."""
    indexed = join_lookup(tuples, dictionary, ["feature"], max_broadcast)
    return indexed.drop("feature")


def sparse_struct(size: Column, entries: Column) -> Column:
    """A sparse vector in storage form, from index-sorted ``(idx, value)`` entries."""
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        size.cast("int").alias("size"),
        F.transform(entries, lambda e: e["idx"].cast("int")).alias("indices"),
        F.transform(entries, lambda e: e["value"]).alias("values"),
    )


def unique_entries(entries: Column) -> Column:
    """The entries as they are; a repeated ``idx`` is an error."""
    positions = F.transform(entries, lambda e: e["idx"])
    repeated = F.size(F.array_distinct(positions)) < F.size(positions)
    complaint = F.raise_error(F.lit("a feature occurs twice for one entity"))
    return F.when(repeated, complaint).otherwise(entries)


def sparse_rows(
    indexed: DataFrame, n_features: int, keys: Sequence[str] = ("id",), name: str = "features"
) -> DataFrame:
    """One row per entity with its sparse vector in storage form.

    An entity has at most one entry per feature, which bounds the collected list by the
    width of the dictionary.
    """
    grouped = indexed.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("idx", "value"))).alias("_entries")
    )
    checked = grouped.withColumn("_entries", unique_entries(F.col("_entries")))
    return checked.select(*keys, sparse_struct(F.lit(n_features), F.col("_entries")).alias(name))


def vector_schema(schema: T.StructType, name: str = "features") -> T.StructType:
    """``schema`` with the storage-form column declared as a vector."""
    return T.StructType(
        [T.StructField(f.name, VectorUDT()) if f.name == name else f for f in schema.fields]
    )


def as_vectors(rows: DataFrame, name: str = "features", path: str | None = None) -> DataFrame:
    """Write storage-form rows as Parquet and scan them back as ML vectors.

    The vector type is a struct underneath, so declaring it at the scan needs no Python
    conversion, and iterative training then reads the stored table.
    """
    path = path or new_path(rows.sparkSession, "vectors")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(vector_schema(rows.schema, name)).parquet(path)


def join_labels(
    vectors: DataFrame, labels: DataFrame, keys: Sequence[str] = ("id",), missing: str = "error"
) -> DataFrame:
    """Add the label of each row's entity; a row without one is an error or is dropped."""
    known = labels.select(*keys, "label")
    if missing == "drop":
        return vectors.join(known, list(keys))
    joined = vectors.join(known, list(keys), "left")
    complaint = F.raise_error(F.lit("an entity of the matrix has no label")).cast("double")
    return joined.withColumn("label", F.coalesce("label", complaint))


def to_vectors(
    indexed: DataFrame, n_features: int, labels: DataFrame | None = None, id_col: str = "id"
) -> DataFrame:
    """Sparse vectors per entity, labelled if ``labels`` are given."""
    rows = sparse_rows(indexed, n_features, [id_col])
    if labels is not None:
        rows = join_labels(rows, labels, [id_col])
    return as_vectors(rows)


def feature_matrix(tuples: DataFrame, labels: DataFrame, id_col: str = "id") -> DataFrame:
    """Dictionary, indexing, grouping and labels in one call.

    The tuples are written once: both the dictionary and the indexing read them.
    """
    stored = materialise(tuples.select(id_col, "feature", "value"), "tuples")
    dictionary = feature_dictionary(stored)
    return to_vectors(index_tuples(stored, dictionary), dictionary.count(), labels, id_col)


def set_dictionaries(tuples: DataFrame, sets: Sequence[FeatureSet]) -> DataFrame:
    """Dictionaries of every cohort and feature set, from one sort.

    One row per ``(cohort, family, feature)`` with its position ``idx`` among all names of the
    cohort and two arrays aligned to ``sets``: ``set_idx``, the feature's index in the set
    (null outside it), and ``width``, the size of that dictionary.
    """
    names = tuples.select("cohort", "family", "feature").distinct()
    member = [F.col("family").isin(list(s.families)).cast("int") for s in sets]
    totals = {f"_p{k}": m for k, m in enumerate(member)}
    placed = with_running_totals(
        names, ["cohort", "feature", "family"], {**totals, "_place": F.lit(1)}
    )
    bounds = placed.groupBy("cohort").agg(
        F.min("_place").alias("_first_place"),
        *[F.min(p).alias(f"_first{p}") for p in totals],
        *[F.sum(m).alias(f"_width{p}") for p, m in totals.items()],
    )
    # One row per cohort of the study.
    joined = placed.join(F.broadcast(bounds), "cohort")
    idx = [F.when(m == 1, F.col(p) - F.col(f"_first{p}")).cast("int") for p, m in totals.items()]
    width = [F.col(f"_width{p}").cast("int") for p in totals]
    return joined.select(
        "cohort",
        "family",
        "feature",
        (F.col("_place") - F.col("_first_place")).alias("idx"),
        F.array(*idx).alias("set_idx"),
        F.array(*width).alias("width"),
    )


def set_rows(
    tuples: DataFrame,
    dictionaries: DataFrame,
    sets: Sequence[FeatureSet],
    id_col: str = "id",
    max_broadcast: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Sparse rows of every cohort and feature set: ``(cohort, feature_set, id, features)``.

    Tuples are indexed and grouped once per entity and cohort; the sets are cut out of the
    grouped entries afterwards, so their overlap costs no extra shuffle.
    """
    indexed = join_lookup(tuples, dictionaries, ["cohort", "family", "feature"], max_broadcast)
    grouped = indexed.groupBy("cohort", id_col).agg(
        F.sort_array(F.collect_list(F.struct("idx", "set_idx", "value"))).alias("_entries"),
        F.first("width").alias("_width"),
    )
    # Names keep their order in every set, so the entries are sorted and checked once.
    checked = grouped.withColumn("_entries", unique_entries(F.col("_entries")))
    cut = checked.select(
        "cohort",
        id_col,
        "_width",
        *[
            F.expr(f"filter(_entries, e -> e.set_idx[{k}] IS NOT NULL) AS _set_{k}")
            for k in range(len(sets))
        ],
    )
    vectors = ", ".join(
        f"""struct('{s.name}' AS feature_set, struct(
            0Y AS type, _width[{k}] AS size,
            transform(_set_{k}, e -> e.set_idx[{k}]) AS indices,
            transform(_set_{k}, e -> e.value) AS values) AS features)"""
        for k, s in enumerate(sets)
    )
    exploded = cut.select("cohort", id_col, F.expr(f"inline(array({vectors}))"))
    return exploded.filter("size(features.indices) > 0")

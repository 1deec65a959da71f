"""Loaders for the input tables: string columns in, typed columns with sentinels out."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from stayscope import schemas
from stayscope.functions import dates, values
from stayscope.sources.delimited import read_csv_table, read_multiline_table
from stayscope.storage import materialise


@dataclass
class Inputs:
    """The tables of a study; a family that is switched off is ``None``."""

    entities: DataFrame
    episodes: DataFrame
    scores: DataFrame | None = None
    flags: DataFrame | None = None
    labs: DataFrame | None = None
    diagnoses: DataFrame | None = None
    medications: DataFrame | None = None
    notes: DataFrame | None = None
    holdout_ids: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        present = ((f.name, getattr(self, f.name)) for f in fields(self))
        return {name: table for name, table in present if table is not None}


def _path(directory: str, table: str) -> str:
    return f"{directory.rstrip('/')}/{schemas.SOURCE_FILES[table]}"


def _source(spark: SparkSession, directory: str, table: str) -> DataFrame:
    return read_csv_table(spark, _path(directory, table))


def _ids(*columns: str) -> list[Column]:
    aliases = {"subject_id": "id", "hadm_id": "admission_id", "icustay_id": "episode_id"}
    return [F.trim(F.col(c)).alias(aliases[c]) for c in columns]


def load_entities(spark: SparkSession, directory: str) -> DataFrame:
    """One row per entity; the terminal date counts only when the flag is set."""
    return entities_from(_source(spark, directory, "entities"))


def entities_from(raw: DataFrame) -> DataFrame:
    flag = values.number_or(F.col("expire_flag"))
    known = F.when(flag == 1, dates.parse_timestamp(F.col("dod")))
    return raw.select(
        *_ids("subject_id"),
        values.is_male(F.col("gender")).alias("is_male"),
        dates.parse_timestamp(F.col("dob")).alias("dob"),
        flag.alias("is_dead"),
        dates.first_date(known, default=dates.open_end()).alias("dod"),
        dates.unset_index().alias("index_ts"),
        F.lit(0.0).alias("age"),
    )


def load_holdout_ids(spark: SparkSession, directory: str) -> DataFrame:
    return _source(spark, directory, "holdout_ids").select(*_ids("subject_id"))


def load_episodes(spark: SparkSession, directory: str) -> DataFrame:
    """Stays; a blank in or out time sorts last."""
    return episodes_from(_source(spark, directory, "episodes"))


def episodes_from(raw: DataFrame) -> DataFrame:
    def at(column: str) -> Column:
        return dates.first_date(dates.parse_timestamp(F.col(column)), default=dates.open_end())

    return raw.select(
        *_ids("subject_id", "icustay_id"), at("intime").alias("in_ts"), at("outtime").alias("out_ts")
    )


def load_chart_events(spark: SparkSession, directory: str) -> DataFrame:
    return _source(spark, directory, "chart_events").select(
        *_ids("subject_id"), dates.parse_timestamp(F.col("charttime")).alias("ts")
    )


def _numeric(columns) -> list[Column]:
    return [values.number_or(F.col(c)).alias(c) for c in columns]


def load_scores(spark: SparkSession, directory: str) -> DataFrame:
    return _source(spark, directory, "scores").select(
        *_ids("subject_id", "hadm_id", "icustay_id"), *_numeric(schemas.SCORE_FEATURES)
    )


def load_flags(spark: SparkSession, directory: str) -> DataFrame:
    return _source(spark, directory, "flags").select(
        *_ids("subject_id", "hadm_id"), *_numeric(schemas.FLAG_COLUMNS)
    )


def load_labs(spark: SparkSession, directory: str) -> DataFrame:
    """Dated measurements; ``measured`` tells a real zero from a missing value."""
    return labs_from(_source(spark, directory, "labs"))


def labs_from(raw: DataFrame) -> DataFrame:
    number = values.blank_to_null(F.col("valuenum")).try_cast("double")
    return raw.select(
        *_ids("subject_id", "hadm_id"),
        dates.parse_timestamp(F.col("charttime")).alias("ts"),
        F.coalesce(F.trim(F.col("itemid")), F.lit("")).alias("code"),
        F.coalesce(number, F.lit(0.0)).alias("value"),
        number.isNotNull().alias("measured"),
    )


def load_diagnoses(spark: SparkSession, directory: str) -> DataFrame:
    """Undated codes: they carry a date before every cutoff."""
    return diagnoses_from(_source(spark, directory, "diagnoses"))


def diagnoses_from(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_ids("subject_id", "hadm_id"),
        dates.undated().alias("ts"),
        F.coalesce(F.trim(F.col("icd9_code")), F.lit("")).alias("code"),
        values.integer_or(F.col("seq_num")).alias("sequence"),
    )


def load_medications(spark: SparkSession, directory: str) -> DataFrame:
    return medications_from(_source(spark, directory, "medications"))


def medications_from(raw: DataFrame) -> DataFrame:
    started, ended = (dates.parse_timestamp(F.col(c)) for c in ("startdate", "enddate"))
    return raw.select(
        *_ids("subject_id", "hadm_id"),
        dates.first_date(started, ended, default=dates.undated()).alias("ts"),
        F.coalesce(F.trim(F.col("drug")), F.lit("")).alias("code"),
    )


def load_notes(spark: SparkSession, directory: str) -> DataFrame:
    """Free text without discharge summaries, dated by chart time or else chart date.

    Texts come out on one line; a large file is still read by many tasks.
    """
    return notes_from(read_multiline_table(spark, _path(directory, "notes")))


def notes_from(raw: DataFrame) -> DataFrame:
    charted, day = (dates.parse_mixed_timestamp(F.col(c)) for c in ("charttime", "chartdate"))
    kept = raw.filter(~values.contains_ignoring_case(F.col("category"), "discharge summary"))
    return kept.select(
        *_ids("subject_id", "hadm_id"),
        F.coalesce(charted, day).alias("ts"),
        "category",
        "description",
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def load_all(
    spark: SparkSession,
    directory: str,
    scores: bool = True,
    flags: bool = True,
    events: bool = True,
    notes: bool = True,
    holdout: bool = False,
) -> Inputs:
    """All tables of one directory, with whole families switched on or off."""
    return Inputs(
        entities=load_entities(spark, directory),
        episodes=load_episodes(spark, directory),
        scores=load_scores(spark, directory) if scores else None,
        flags=load_flags(spark, directory) if flags else None,
        labs=load_labs(spark, directory) if events else None,
        diagnoses=load_diagnoses(spark, directory) if events else None,
        medications=load_medications(spark, directory) if events else None,
        notes=load_notes(spark, directory) if notes else None,
        holdout_ids=load_holdout_ids(spark, directory) if holdout else None,
    )


def row_counts(inputs: Inputs) -> DataFrame:
    """One row per loaded table: its name and row count, in a single job."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, table in inputs.tables().items()
    ]
    merged = counts[0]
    for count in counts[1:]:
        merged = merged.unionByName(count)
    return merged


def store_counted(inputs: Inputs) -> tuple[Inputs, DataFrame]:
    """Every table written once as Parquet, and ``(table_name, n_rows)`` as the writing tasks counted them.

    The counts are observed on the way, so no job reads a table again to count it. A table without rows
    counts 0.
    """
    stored, counts = {}, []
    for name, table in inputs.tables().items():
        seen = Observation()
        stored[name] = materialise(table.observe(seen, F.count(F.lit(1)).alias("n_rows")), name)
        counts.append((name, seen.get.get("n_rows", 0)))
    spark = inputs.entities.sparkSession
    # One row per table of the study.
    return Inputs(**stored), spark.createDataFrame(counts, "table_name string, n_rows bigint")

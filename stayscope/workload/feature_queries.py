"""Features, matrices and splits on the benchmark tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stayscope import config, schemas
from stayscope.operators import cohort as co
from stayscope.operators import events as ev
from stayscope.operators import matrix as mx
from stayscope.operators import scaling, split, static
from stayscope.plans import study
from stayscope.sources import libsvm, sinks
from stayscope.storage import materialise, new_path
from stayscope.workload import roles, text_queries
from stayscope.workload.cohort_queries import cohort, grid
from stayscope.workload.registry import query


def rounded(df, *columns):
    for c in columns or ("value",):
        df = df.withColumn(c, F.round(c, 6))
    return df


def _cutoffs(spark, sf_dir):
    return co.cohort_cutoffs(
        roles.entities(spark, sf_dir), roles.episodes(spark, sf_dir), roles.SPECS
    )


def event_tuples(spark, sf_dir, members):
    """Diagnosis, medication and lab tuples of a cohort, each a plan of its own."""
    diag = ev.count_features(ev.as_of(roles.diagnoses(spark, sf_dir), members), "DIAG-")
    med = ev.count_features(ev.as_of(roles.medications(spark, sf_dir), members), "MED-")
    lab = ev.mean_features(ev.as_of(roles.labs(spark, sf_dir), members), "LAB-")
    return {"diag": diag, "med": med, "lab": lab}


#: Topics and rounds of the checked store: few, as its twin spells every round out.
STORE_TOPICS, STORE_ROUNDS = 4, 3
STORE_STOP_WORDS = (*text_queries.ENGLISH, *text_queries.STOP_WORDS)


def store_config(spark, **changes):
    """All cohorts and families, with the default English stop words and further ones."""
    settings = dict(
        feature_dir=new_path(spark, "features"),
        output_dir=new_path(spark, "output"),
        outcomes=roles.OUTCOMES,
        score_names=roles.SCORE_NAMES,
        flag_names=roles.FLAG_NAMES,
        stop_words=(*study.stop_words_with(spark, None), *text_queries.STOP_WORDS),
        topics=STORE_TOPICS,
        topic_iterations=STORE_ROUNDS,
    )
    return study.StudyConfig(**{**settings, **changes})


def all_tuples(spark, sf_dir):
    """Every family of every cohort in one table: ``(cohort, family, id, feature, value)``."""
    return study.study_tuples(roles.inputs(spark, sf_dir), store_config(spark))[0]


_ALL_TUPLES_SQL = f"""{roles.GRID_SQL},{roles.CODES_SQL},{roles.SCORES_SQL},{roles.FLAGS_SQL},
members AS MATERIALIZED (SELECT cohort, id, is_male, age, index_ts FROM grid),
score_tuples AS (
  {roles.unpivot_sql("latest_scores", roles.SCORE_NAMES)}),
flag_tuples AS (
  {roles.unpivot_sql("latest_flags", roles.FLAG_NAMES)}),{text_queries.note_words_sql(STORE_STOP_WORDS)},
edges AS MATERIALIZED (
  SELECT g.cohort AS corpus, w.id, w.term, count(*) AS n
  FROM note_words w JOIN members g ON w.id = g.id AND w.ts <= g.index_ts GROUP BY g.cohort, w.id, w.term),
{text_queries.topics_sql(STORE_TOPICS, STORE_ROUNDS)},
tuples AS MATERIALIZED (
  SELECT cohort, 'base' AS family, id, 'patient_age' AS feature, age AS value FROM members
  UNION ALL SELECT cohort, 'base', id, 'patient_sex', CAST(is_male AS DOUBLE) FROM members
  UNION ALL SELECT g.cohort, 'scores', t.id, t.feature, t.value FROM score_tuples t JOIN members g ON t.id = g.id
  UNION ALL SELECT g.cohort, 'flags', t.id, t.feature, t.value FROM flag_tuples t JOIN members g ON t.id = g.id
  UNION ALL SELECT g.cohort, 'diag', d.id, 'DIAG-' || code, CAST(count(*) AS DOUBLE)
    FROM diagnoses d JOIN members g ON d.id = g.id GROUP BY g.cohort, d.id, code
  UNION ALL SELECT g.cohort, 'med', m.id, 'MED-' || code, CAST(count(*) AS DOUBLE)
    FROM medications m JOIN members g ON m.id = g.id AND m.ts <= g.index_ts GROUP BY g.cohort, m.id, code
  UNION ALL SELECT g.cohort, 'lab', l.id, 'LAB-' || code, avg(value)
    FROM labs l JOIN members g ON l.id = g.id AND l.ts <= g.index_ts GROUP BY g.cohort, l.id, code
  UNION ALL SELECT corpus, 'notes', id, 'topic-' || CAST(topic AS VARCHAR), w / sum(w) OVER (PARTITION BY corpus, id)
    FROM d{STORE_ROUNDS})"""


def dynamic_tuples(spark, sf_dir):
    """Diagnosis, medication, lab and base tuples of one cohort."""
    members = materialise(cohort(spark, sf_dir), "cohort")
    tuples = event_tuples(spark, sf_dir, members)
    dynamic = tuples["diag"].unionByName(tuples["med"]).unionByName(tuples["lab"])
    return dynamic.unionByName(static.base_tuples(members))


def stored_tuples(spark, sf_dir):
    """The same, written once for queries that read them more than once."""
    return materialise(dynamic_tuples(spark, sf_dir), "tuples")


_DYNAMIC_SQL = f"""{roles.COHORT_SQL},{roles.CODES_SQL},{roles.EVENT_TUPLES_SQL},
tuples AS (
  SELECT * FROM diag_tuples UNION ALL SELECT * FROM med_tuples UNION ALL SELECT * FROM lab_tuples
  UNION ALL SELECT id, 'patient_age', age FROM cohort
  UNION ALL SELECT id, 'patient_sex', CAST(is_male AS DOUBLE) FROM cohort),
dictionary AS (
  SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS idx
  FROM (SELECT DISTINCT feature FROM tuples)),
indexed AS (
  SELECT t.id, d.idx, t.value FROM tuples t JOIN dictionary d ON t.feature = d.feature)"""


@query(
    "asof_events",
    f"""WITH {roles.COHORT_SQL},{roles.CODES_SQL}
    SELECT l.id, l.ts, l.code, l.value, c.index_ts
    FROM labs l JOIN cohort c ON l.id = c.id AND l.ts <= c.index_ts""",
)
def asof_events(spark, sf_dir):
    return ev.as_of(roles.labs(spark, sf_dir), cohort(spark, sf_dir))


@query(
    "asof_events_day",
    f"""WITH {roles.GRID_SQL},{roles.CODES_SQL},
    cut AS (
      SELECT id, CASE WHEN in_ts IS NULL THEN TIMESTAMP '1971-01-01 00:00:00'
        ELSE least(date_trunc('day', in_ts) + INTERVAL 24 HOUR, date_trunc('day', out_ts),
                   date_trunc('day', dod)) END AS index_ts
      FROM anchored)
    SELECT l.id, l.ts, l.code, l.value, c.index_ts
    FROM labs l JOIN cut c ON l.id = c.id AND date_trunc('day', l.ts) <= c.index_ts""",
)
def asof_events_day(spark, sf_dir):
    """Events of the index day count whatever their time."""
    members = co.build_cohort(
        roles.entities(spark, sf_dir), roles.episodes(spark, sf_dir), config.IN_STAY, 24, precision="day"
    )
    return ev.as_of(roles.labs(spark, sf_dir), members, precision="day")


@query(
    "lookback_events",
    f"""WITH {roles.COHORT_SQL},{roles.CODES_SQL}
    SELECT l.id, l.ts, l.code, l.value, c.index_ts
    FROM labs l JOIN cohort c ON l.id = c.id AND l.ts <= c.index_ts
      AND l.ts >= c.index_ts - INTERVAL 5 DAY""",
)
def lookback_events(spark, sf_dir):
    window = F.make_dt_interval(F.lit(5))
    return ev.as_of(roles.labs(spark, sf_dir), cohort(spark, sf_dir), lookback=window)


@query(
    "cohort_semi_join",
    f"""WITH {roles.COHORT_SQL},{roles.SCORES_SQL}
    SELECT id, CAST(l_orderkey AS VARCHAR) AS admission_id,
           CAST(l_linenumber AS VARCHAR) AS episode_id,
           l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax
    FROM score_rows WHERE id IN (SELECT id FROM cohort)""",
)
def cohort_semi_join(spark, sf_dir):
    return ev.in_cohort(roles.scores(spark, sf_dir), cohort(spark, sf_dir))


def _tuples_sql(name: str) -> str:
    return f"""WITH {roles.COHORT_SQL},{roles.CODES_SQL},{roles.EVENT_TUPLES_SQL}
    SELECT id, feature, round(value, 6) AS value FROM {name}"""


@query("diag_counts", _tuples_sql("diag_tuples"))
def diag_counts(spark, sf_dir):
    return ev.count_features(
        ev.as_of(roles.diagnoses(spark, sf_dir), cohort(spark, sf_dir)), schemas.DIAGNOSIS_PREFIX
    )


@query("med_counts", _tuples_sql("med_tuples"))
def med_counts(spark, sf_dir):
    return ev.count_features(
        ev.as_of(roles.medications(spark, sf_dir), cohort(spark, sf_dir)), schemas.MEDICATION_PREFIX
    )


@query("lab_means", _tuples_sql("lab_tuples"))
def lab_means(spark, sf_dir):
    return rounded(
        ev.mean_features(ev.as_of(roles.labs(spark, sf_dir), cohort(spark, sf_dir)), schemas.LAB_PREFIX)
    )


@query(
    "med_counts_grid",
    f"""WITH {roles.GRID_SQL},{roles.CODES_SQL}
    SELECT g.cohort, m.id, 'MED-' || code AS feature, CAST(count(*) AS DOUBLE) AS value
    FROM medications m JOIN grid g ON m.id = g.id AND m.ts <= g.index_ts
    GROUP BY g.cohort, m.id, code""",
)
def med_counts_grid(spark, sf_dir):
    names = [c.name for c in roles.SPECS]
    return ev.count_features_grid(
        roles.medications(spark, sf_dir), _cutoffs(spark, sf_dir), names, "MED-"
    )


@query(
    "lab_means_grid",
    f"""WITH {roles.GRID_SQL},{roles.CODES_SQL}
    SELECT g.cohort, l.id, 'LAB-' || code AS feature, round(avg(value), 6) AS value
    FROM labs l JOIN grid g ON l.id = g.id AND l.ts <= g.index_ts
    GROUP BY g.cohort, l.id, code""",
)
def lab_means_grid(spark, sf_dir):
    names = [c.name for c in roles.SPECS]
    return rounded(
        ev.mean_features_grid(roles.labs(spark, sf_dir), _cutoffs(spark, sf_dir), names, "LAB-")
    )


@query(
    "base_features",
    f"""WITH {roles.GRID_SQL}
    SELECT cohort, id, 'patient_age' AS feature, age AS value FROM grid
    UNION ALL SELECT cohort, id, 'patient_sex', CAST(is_male AS DOUBLE) FROM grid""",
)
def base_features(spark, sf_dir):
    return static.base_tuples(grid(spark, sf_dir), ["cohort", "id"])


@query(
    "latest_scores",
    f"""WITH {roles.SCORES_SQL}
    SELECT id, CAST(l_orderkey AS VARCHAR) AS admission_id,
           CAST(l_linenumber AS VARCHAR) AS episode_id,
           l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax
    FROM latest_scores""",
)
def latest_scores(spark, sf_dir):
    return static.latest_scores(roles.scores(spark, sf_dir), tie_break=["l_partkey", "l_suppkey"])


@query(
    "latest_flags",
    f"""WITH {roles.FLAGS_SQL}
    SELECT id, CAST(o_orderkey AS VARCHAR) AS admission_id,
           is_urgent, is_open, is_finished, is_large FROM latest_flags""",
)
def latest_flags(spark, sf_dir):
    return static.latest_flags(roles.flags(spark, sf_dir))


@query(
    "unpivot_scores",
    f"WITH {roles.SCORES_SQL} {roles.unpivot_sql('latest_scores', roles.SCORE_NAMES)}",
)
def unpivot_scores(spark, sf_dir):
    return static.wide_to_tuples(latest_scores(spark, sf_dir), roles.SCORE_NAMES)


@query(
    "unpivot_flags",
    f"WITH {roles.FLAGS_SQL} {roles.unpivot_sql('latest_flags', roles.FLAG_NAMES)}",
)
def unpivot_flags(spark, sf_dir):
    return static.wide_to_tuples(latest_flags(spark, sf_dir), roles.FLAG_NAMES)


def _set_members_sql() -> str:
    rows = [
        f"('{s.name}', '{family}')" for s in config.FEATURE_SETS for family in s.families
    ]
    return f"set_members(feature_set, family) AS (VALUES {', '.join(rows)})"


@query(
    "feature_sets",
    f"""WITH {_ALL_TUPLES_SQL}, {_set_members_sql()}
    SELECT cohort, feature_set, count(*) AS n_tuples, count(DISTINCT id) AS n_entities,
           count(DISTINCT feature) AS n_features, round(sum(value), 4) AS total
    FROM tuples JOIN set_members USING (family) GROUP BY cohort, feature_set""",
)
def feature_sets(spark, sf_dir):
    tuples = all_tuples(spark, sf_dir)
    members = F.explode(
        F.array_compact(
            F.array(
                *[
                    F.when(F.col("family").isin(list(s.families)), F.lit(s.name))
                    for s in config.FEATURE_SETS
                ]
            )
        )
    )
    summary = tuples.withColumn("feature_set", members).groupBy("cohort", "feature_set").agg(
        F.count(F.lit(1)).alias("n_tuples"),
        F.countDistinct("id").alias("n_entities"),
        F.countDistinct("feature").alias("n_features"),
        F.round(F.sum("value"), 4).alias("total"),
    )
    return summary


@query(
    "feature_dictionary",
    f"""WITH {_ALL_TUPLES_SQL}
    SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS idx
    FROM (SELECT DISTINCT feature FROM tuples)""",
)
def feature_dictionary(spark, sf_dir):
    return mx.feature_dictionary(all_tuples(spark, sf_dir)).select("feature", "idx")


@query(
    "feature_indexing",
    f"WITH {_DYNAMIC_SQL} SELECT id, idx, round(value, 6) AS value FROM indexed",
)
def feature_indexing(spark, sf_dir):
    tuples = stored_tuples(spark, sf_dir)
    return rounded(mx.index_tuples(tuples, mx.feature_dictionary(tuples)))


def entries(vectors, *keys):
    """Stored entries of sparse vectors as sorted long rows."""
    pairs = F.arrays_zip("features.indices", "features.values")
    return vectors.select(*keys, F.explode(pairs).alias("_e")).select(
        *keys, F.col("_e.indices").alias("idx"), F.round("_e.values", 6).alias("value")
    )


@query(
    "sparse_vectors",
    f"""WITH {_DYNAMIC_SQL}
    SELECT id, CAST(idx AS INT) AS idx, round(value, 6) AS value FROM indexed""",
)
def sparse_vectors(spark, sf_dir):
    tuples = stored_tuples(spark, sf_dir)
    dictionary = mx.feature_dictionary(tuples)
    rows = mx.sparse_rows(mx.index_tuples(tuples, dictionary), dictionary.count())
    return entries(rows, "id")


@query(
    "label_join",
    f"""WITH {_DYNAMIC_SQL}
    SELECT i.id, c.label, count(*) AS n_entries, round(sum(i.value), 4) AS total
    FROM indexed i JOIN cohort c ON i.id = c.id GROUP BY i.id, c.label""",
)
def label_join(spark, sf_dir):
    tuples = stored_tuples(spark, sf_dir)
    dictionary = mx.feature_dictionary(tuples)
    rows = mx.sparse_rows(mx.index_tuples(tuples, dictionary), dictionary.count())
    labelled = mx.join_labels(rows, cohort(spark, sf_dir))
    total = F.aggregate("features.values", F.lit(0.0), lambda a, v: a + v)
    return labelled.select(
        "id",
        "label",
        F.size("features.indices").cast("long").alias("n_entries"),
        F.round(total, 4).alias("total"),
    )


def dynamic_matrix(spark, sf_dir):
    """Labelled ML vectors of the 24-hour in-stay cohort."""
    return mx.feature_matrix(dynamic_tuples(spark, sf_dir), cohort(spark, sf_dir))


@query(
    "feature_matrix",
    f"""WITH {_DYNAMIC_SQL}
    SELECT i.id, c.label, CAST(i.idx AS INT) AS idx, round(i.value, 6) AS value
    FROM indexed i JOIN cohort c ON i.id = c.id WHERE i.value <> 0""",
)
def feature_matrix(spark, sf_dir):
    # Densified here only to show the vectors row by row.
    cells = F.posexplode(vector_to_array("features")).alias("idx", "value")
    long = dynamic_matrix(spark, sf_dir).select("id", "label", cells)
    return rounded(long.filter(F.col("value") != 0))


@query(
    "libsvm_roundtrip",
    f"""WITH {_DYNAMIC_SQL}
    SELECT c.label, CAST(i.idx AS INT) AS idx, round(i.value, 6) AS value
    FROM indexed i JOIN cohort c ON i.id = c.id""",
)
def libsvm_roundtrip(spark, sf_dir):
    path = new_path(spark, "libsvm")
    sinks.write_libsvm(dynamic_matrix(spark, sf_dir), path)
    return rounded(libsvm.read_libsvm_entries(spark, path))


@query(
    "holdout_vectors",
    f"""WITH {_DYNAMIC_SQL}
    SELECT CAST(id AS DOUBLE) AS label, CAST(idx AS INT) AS idx, round(value, 6) AS value
    FROM indexed WHERE id % 5 = 0""",
)
def holdout_vectors(spark, sf_dir):
    matrix = dynamic_matrix(spark, sf_dir)
    _, held_out = split.split_by_ids(matrix, roles.holdout_ids(spark, sf_dir))
    path = new_path(spark, "libsvm")
    sinks.write_libsvm(held_out, path, F.col("id"))
    return rounded(libsvm.read_libsvm_entries(spark, path))


@query(
    "train_split_anti",
    f"""WITH {_DYNAMIC_SQL}
    SELECT id, feature, round(value, 6) AS value FROM tuples WHERE id % 5 <> 0""",
)
def train_split_anti(spark, sf_dir):
    tuples = dynamic_tuples(spark, sf_dir)
    return rounded(split.split_by_ids(tuples, roles.holdout_ids(spark, sf_dir))[0])


_HASH_SQL = """CAST(('0x' || substr(md5('11:' || CAST(id AS VARCHAR)), 1, 8)) AS BIGINT) % 10000 < 7000"""


@query(
    "hash_split",
    f"""WITH {roles.ENTITIES_SQL}
    SELECT id, CASE WHEN {_HASH_SQL} THEN 'train' ELSE 'test' END AS side FROM entities""",
)
def hash_split(spark, sf_dir):
    train, test = split.split_by_hash(roles.entities(spark, sf_dir).select("id"))
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )


@query("random_split")
def random_split(spark, sf_dir):
    train, test = split.split_random(roles.entities(spark, sf_dir).select("id"))
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )


_STDDEV_SQL = """
sizes AS (SELECT count(*) AS n FROM cohort),
stddevs AS (
  SELECT feature, sqrt((sum(value * value) - sum(value) * sum(value) / n) / (n - 1)) AS stddev
  FROM tuples CROSS JOIN sizes GROUP BY feature, n)"""


@query(
    "feature_stddev",
    f"WITH {_DYNAMIC_SQL},{_STDDEV_SQL} SELECT feature, round(stddev, 5) AS stddev FROM stddevs",
)
def feature_stddev(spark, sf_dir):
    n_entities = cohort(spark, sf_dir).count()
    deviations = scaling.feature_stddev(dynamic_tuples(spark, sf_dir), n_entities)
    return deviations.withColumn("stddev", F.round("stddev", 5))


@query(
    "scaled_features",
    f"""WITH {_DYNAMIC_SQL},
known AS MATERIALIZED (SELECT id, feature, value FROM tuples),
moments AS MATERIALIZED (
  SELECT feature, sum(value) AS s1, sum(value * value) AS s2, (SELECT count(*) FROM cohort) AS n
  FROM known GROUP BY feature),
stddevs AS MATERIALIZED (
  SELECT feature, sqrt(greatest((s2 - s1 * s1 / n) / (n - 1), 0)) AS stddev FROM moments)
SELECT t.id, t.feature, round(CASE WHEN s.stddev > 1e-9 THEN t.value / s.stddev ELSE 0 END, 4) AS value
FROM known t JOIN stddevs s USING (feature)""",
)
def scaled_features(spark, sf_dir):
    tuples = stored_tuples(spark, sf_dir)
    deviations = scaling.feature_stddev(tuples, cohort(spark, sf_dir).count())
    scaled = scaling.scale_tuples(tuples, deviations)
    return scaled.select("id", "feature", F.round("value", 4).alias("value"))


@query(
    "scaled_features_split",
    f"""WITH {_DYNAMIC_SQL},
sided AS (SELECT *, id % 5 = 0 AS held_out FROM tuples),
sizes AS (SELECT id % 5 = 0 AS held_out, count(*) AS n FROM cohort GROUP BY 1),
moments AS (
  SELECT held_out, feature, n, sum(value) AS s1, sum(value * value) AS s2
  FROM sided JOIN sizes USING (held_out) GROUP BY held_out, feature, n),
stddevs AS (
  SELECT held_out, feature, sqrt(greatest((s2 - s1 * s1 / n) / (n - 1), 0)) AS stddev FROM moments)
SELECT t.id, d.idx, t.held_out,
       round(CASE WHEN s.stddev > 1e-9 THEN t.value / s.stddev ELSE 0 END, 4) AS value
FROM sided t JOIN stddevs s ON t.held_out = s.held_out AND t.feature = s.feature
JOIN (SELECT feature, CAST(idx AS INT) AS idx FROM dictionary) d ON t.feature = d.feature
WHERE s.stddev > 1e-9 AND t.value <> 0""",
)
def scaled_features_split(spark, sf_dir):
    matrix = dynamic_matrix(spark, sf_dir)
    train, held_out = split.split_by_ids(matrix, roles.holdout_ids(spark, sf_dir))
    train, held_out = scaling.scale_features(train, held_out, fit_on="each")
    both = train.withColumn("held_out", F.lit(False)).unionByName(
        held_out.withColumn("held_out", F.lit(True))
    )
    # Densified here only to show the vectors row by row.
    cells = F.posexplode(vector_to_array("scaled")).alias("idx", "value")
    long = both.select("id", "held_out", cells).filter(F.col("value") != 0)
    return long.select("id", "idx", "held_out", F.round("value", 4).alias("value"))


@query(
    "normalized_features",
    f"""WITH {_DYNAMIC_SQL},
norms AS (SELECT id, sqrt(sum(value * value)) AS l2, sum(abs(value)) AS l1 FROM tuples GROUP BY id)
SELECT t.id, t.feature, round(t.value / l2, 6) AS l2_value, round(t.value / l1, 6) AS l1_value
FROM tuples t JOIN norms n ON t.id = n.id""",
)
def normalized_features(spark, sf_dir):
    tuples = stored_tuples(spark, sf_dir)
    doubled = scaling.normalize_tuples(tuples.withColumn("raw", F.col("value")), 2.0)
    both = scaling.normalize_tuples(
        doubled.withColumnRenamed("value", "l2_value").withColumnRenamed("raw", "value"), 1.0
    )
    return rounded(both.withColumnRenamed("value", "l1_value"), "l1_value", "l2_value").select(
        "id", "feature", "l2_value", "l1_value"
    )


@query(
    "feature_store",
    f"""WITH {_ALL_TUPLES_SQL}, {_set_members_sql()},
chosen AS (SELECT feature_set, t.* FROM tuples t JOIN set_members USING (family)),
named AS (
  SELECT cohort, feature_set, feature,
    row_number() OVER (PARTITION BY cohort, feature_set ORDER BY feature) - 1 AS idx
  FROM (SELECT DISTINCT cohort, feature_set, feature FROM chosen)),
sizes AS (SELECT cohort, feature_set, count(*) AS n FROM named GROUP BY cohort, feature_set)
SELECT c.cohort, c.feature_set, c.id, CAST(s.n AS INT) AS n_features,
       CAST(n.idx AS INT) AS idx, round(c.value, 6) AS value
FROM chosen c JOIN named n USING (cohort, feature_set, feature) JOIN sizes s USING (cohort, feature_set)""",
)
def feature_store(spark, sf_dir):
    """Every cohort and feature set, notes included, as the stored rows hold them."""
    rows, _ = study.feature_rows(roles.inputs(spark, sf_dir), store_config(spark))
    path = new_path(spark, "store")
    sinks.write_feature_store(rows, path)
    stored = spark.read.schema(rows.schema).parquet(path)
    width = F.col("features.size").alias("n_features")
    return entries(
        stored.select("cohort", "feature_set", "id", width, "features"),
        "cohort",
        "feature_set",
        "id",
        "n_features",
    )


@query(
    "flagship",
    f"""WITH {_DYNAMIC_SQL}
    SELECT i.id, c.label, i.idx, d.feature, round(i.value, 6) AS value
    FROM indexed i JOIN cohort c ON i.id = c.id JOIN dictionary d ON i.idx = d.idx""",
)
def flagship(spark, sf_dir):
    """Medications, measurements, age and sex known 24 hours into the last stay."""
    members = cohort(spark, sf_dir)
    tuples = stored_tuples(spark, sf_dir)
    named = mx.join_lookup(tuples, mx.feature_dictionary(tuples), ["feature"])
    labelled = mx.join_labels(named, members)
    return labelled.select("id", "label", "idx", "feature", F.round("value", 6).alias("value"))

"""Classifiers trained on the benchmark tables; rows only, as training is iterative."""

from __future__ import annotations

from statistics import fmean

from pyspark.sql import functions as F

from stayscope.operators import gradient, matrix, metrics, models, scaling, split, topics
from stayscope.plans import study
from stayscope.sources import libsvm, sinks
from stayscope.storage import materialise, new_path
from stayscope.workload import roles
from stayscope.workload.cohort_queries import cohort
from stayscope.workload.feature_queries import (
    _DYNAMIC_SQL,
    _HASH_SQL,
    dynamic_matrix,
    dynamic_tuples,
    store_config,
    stored_tuples,
)
from stayscope.workload.registry import query


def _scaled_split(spark, sf_dir):
    train, test = split.split_by_hash(dynamic_matrix(spark, sf_dir))
    return scaling.scale_features(train, test)


@query("svm_scores")
def svm_scores(spark, sf_dir):
    train, test = _scaled_split(spark, sf_dir)
    model = models.train_svm(train, "scaled")
    return models.score(model, test, models.margin())


_DESCENT_SQL = f"""WITH RECURSIVE {_DYNAMIC_SQL},
sided AS MATERIALIZED (SELECT t.id, i.idx, t.value, c.label, t.id % 10 < 7 AS train
  FROM tuples t JOIN dictionary i USING (feature) JOIN cohort c ON c.id = t.id),
n AS MATERIALIZED (SELECT count(DISTINCT id) AS n FROM sided WHERE train),
deviations AS MATERIALIZED (
  SELECT idx, sqrt(greatest((sum(value * value) - sum(value) * sum(value) / n) / (n - 1), 0)) AS d
  FROM sided, n WHERE train GROUP BY idx, n),
x AS MATERIALIZED (SELECT id, idx, value / d AS v, CASE WHEN label > 0.5 THEN 1 ELSE -1 END AS y
  FROM sided JOIN deviations USING (idx) WHERE train AND d > 1e-9),
w(i, idx, w, moved) AS (
  SELECT 0, idx, 0.0::DOUBLE, NULL::DOUBLE FROM dictionary
  UNION ALL
  SELECT i + 1, idx, new, new - old FROM (
    SELECT w.i, w.idx, w.w AS old,
      w.w * (1 - {gradient.REG} / sqrt(w.i + 1)) + coalesce(g.g, 0) / n.n * {gradient.STEP} / sqrt(w.i + 1) AS new
    FROM w CROSS JOIN n LEFT JOIN (
      SELECT x.idx, sum(x.v * x.y) AS g FROM x JOIN (
        SELECT x.id FROM x JOIN w USING (idx) GROUP BY x.id, x.y HAVING x.y * sum(x.v * w.w) < 1) wrong USING (id)
      GROUP BY x.idx) g ON g.idx = w.idx
    WHERE w.i < {{iterations}} AND (w.i < 2 OR (SELECT sqrt(sum(moved * moved)) >=
      {gradient.TOLERANCE} * greatest(sqrt(sum(w * w)), 1.0) FROM w)))),
final AS MATERIALIZED (SELECT idx, w FROM w WHERE i = (SELECT max(i) FROM w))
SELECT s.id, s.label, round(coalesce(sum(CASE WHEN d.d > 1e-9 THEN s.value / d.d * f.w END), 0), 6) AS score
FROM sided s LEFT JOIN deviations d USING (idx) LEFT JOIN final f USING (idx) WHERE NOT s.train GROUP BY s.id, s.label"""


@query("svm_sgd", _DESCENT_SQL.format(iterations=gradient.ITERATIONS))
def svm_sgd(spark, sf_dir):
    """Margins of the rows held back, by gradient descent to its end; the split is by id."""
    rows = _stored_matrix(spark, sf_dir)
    train = rows.where(F.col("id").cast("long") % 10 < 7)
    fitted = gradient.train_svms(train, scale_by=train)
    scored = gradient.margins(rows.where(F.col("id").cast("long") % 10 >= 7), fitted)
    return scored.select("id", "label", F.round("score", 6).alias("score"))


def _stored_matrix(spark, sf_dir):
    """The labelled matrix with vectors in storage form."""
    tuples = stored_tuples(spark, sf_dir)
    dictionary = matrix.feature_dictionary(tuples)
    rows = matrix.sparse_rows(matrix.index_tuples(tuples, dictionary), dictionary.count())
    return materialise(matrix.join_labels(rows, cohort(spark, sf_dir)), "matrix")


@query("lr_scores")
def lr_scores(spark, sf_dir):
    train, test = _scaled_split(spark, sf_dir)
    model = models.train_lr(train, "scaled")
    return models.score(model, test, models.probability())


@query("dt_scores")
def dt_scores(spark, sf_dir):
    train, test = _scaled_split(spark, sf_dir)
    return models.score(models.train_dt(train, "scaled"), test, models.predicted_class())


@query("rf_scores")
def rf_scores(spark, sf_dir):
    train, test = _scaled_split(spark, sf_dir)
    return models.score(models.train_rf(train, "scaled"), test, models.predicted_class())


@query(
    "string_index",
    f"""WITH {roles.COHORT_SQL},
    sizes AS (SELECT label, count(*) AS n FROM cohort GROUP BY label)
    SELECT id, label, CAST(dense_rank() OVER (ORDER BY n DESC) - 1 AS DOUBLE) AS indexed_label
    FROM cohort JOIN sizes USING (label)""",
)
def string_index(spark, sf_dir):
    labels = cohort(spark, sf_dir).select("id", "label")
    indexed = models.index_labels(labels).transform(labels)
    return indexed.select("id", "label", F.col("indexed_label").cast("double").alias("indexed_label"))


@query("indexed_lr")
def indexed_lr(spark, sf_dir):
    data = dynamic_matrix(spark, sf_dir)
    train, test = split.split_by_hash(data)
    fitted = models.fit_indexed_lr(train, data).transform(test)
    return fitted.select("id", "label", "prediction", "predicted_label")


def _sex_matrix(spark, sf_dir):
    """Vectors whose label is one of their own features, so that predictions are known."""
    labels = cohort(spark, sf_dir).select("id", F.col("is_male").cast("double").alias("label"))
    return matrix.feature_matrix(dynamic_tuples(spark, sf_dir), labels)


_SEX_SQL = f"WITH {roles.COHORT_SQL} SELECT id, CAST(is_male AS DOUBLE) AS label, {{}} FROM cohort"


@query("planted_dt", _SEX_SQL.format("CAST(is_male AS DOUBLE) AS score"))
def planted_dt(spark, sf_dir):
    data = _sex_matrix(spark, sf_dir)
    return models.score(models.train_dt(data), data, models.predicted_class())


@query("planted_indexed_lr", _SEX_SQL.format("CASE WHEN is_male THEN '1.0' ELSE '0.0' END AS predicted_label"))
def planted_indexed_lr(spark, sf_dir):
    data = _sex_matrix(spark, sf_dir)
    fitted = models.fit_indexed_lr(data, data).transform(data)
    return fitted.select("id", "label", "predicted_label")


_HELD_OUT_SEX_SQL = f"""WITH {roles.COHORT_SQL}
    SELECT id, CAST(is_male AS DOUBLE) AS score FROM cohort WHERE NOT ({_HASH_SQL})"""


def _held_out(spark, sf_dir, fit, value):
    """Scores of rows that training did not see."""
    train, test = scaling.scale_features(*split.split_by_hash(_sex_matrix(spark, sf_dir)))
    return models.score(fit(train, "scaled"), test, value, keep=("id",))


@query("heldout_dt", _HELD_OUT_SEX_SQL)
def heldout_dt(spark, sf_dir):
    return _held_out(spark, sf_dir, models.train_dt, models.predicted_class())


@query("libsvm_train", _HELD_OUT_SEX_SQL)
def libsvm_train(spark, sf_dir):
    """Trained and scored from LIBSVM text alone; the held-out file carries ids in place of labels."""
    data = _sex_matrix(spark, sf_dir)
    width = data.select("features").first()[0].size
    train, test = split.split_by_hash(data)
    train_path, test_path = new_path(spark, "libsvm"), new_path(spark, "libsvm")
    sinks.write_libsvm(train, train_path)
    sinks.write_libsvm(test, test_path, F.col("id"))
    fitted = models.train_dt(libsvm.read_libsvm(spark, train_path, width))
    held_out = libsvm.read_libsvm(spark, test_path, width)
    scored = models.score(fitted, held_out, models.predicted_class(), keep=("label",))
    return scored.select(F.col("label").cast("bigint").alias("id"), "score")


@query(
    "cv_folds",
    f"""WITH {roles.COHORT_SQL},
    placed AS (SELECT CAST(('0x' || substr(md5('11:' || CAST(id AS VARCHAR)), 1, 8)) AS BIGINT) % 10000 % 5 AS fold, label
      FROM cohort)
    SELECT CAST(fold AS INT) AS fold, count(*) AS n, count(*) FILTER (label > 0.5) AS n_pos,
      count(*) FILTER (label <= 0.5) AS n_neg FROM placed GROUP BY fold""",
)
def cv_folds(spark, sf_dir):
    """Rows and classes of each fold of the cross-validation."""
    placed = split.with_fold(cohort(spark, sf_dir).select("id", "label"))
    positive = F.col("label") > 0.5
    return placed.groupBy("fold").agg(
        F.count("*").alias("n"), F.count_if(positive).alias("n_pos"), F.count_if(~positive).alias("n_neg")
    )


@query(
    "store_overwrite",
    f"""WITH {_DYNAMIC_SQL}, sizes AS (SELECT id, count(*) AS n FROM tuples GROUP BY id)
    SELECT 'in_stay_24h' AS cohort, 'first' AS feature_set, id, n FROM sizes
    UNION ALL SELECT 'in_stay_24h', 'second', id, n FROM sizes WHERE id % 2 = 0""",
)
def store_overwrite(spark, sf_dir):
    """A store of two feature sets of which one is written anew, with half its rows."""
    rows = _stored_matrix(spark, sf_dir).withColumn("cohort", F.lit("in_stay_24h"))
    first, second = (rows.withColumn("feature_set", F.lit(name)) for name in ("first", "second"))
    path = new_path(spark, "store")
    sinks.write_feature_store(first.unionByName(second), path)
    sinks.write_feature_store(second.where(F.col("id").cast("long") % 2 == 0), path, replace="sets")
    stored = spark.read.parquet(path)
    return stored.select("cohort", "feature_set", "id", F.size("features.indices").cast("long").alias("n"))


@query("cv_grid")
def cv_grid(spark, sf_dir):
    """Mean cross-validated area per regularisation strength."""
    data = dynamic_matrix(spark, sf_dir)
    train, _ = split.split_by_hash(data)
    train = split.with_fold(train)
    areas = models.fold_areas(train, models.indexed_lr_stages(data), parallelism=8, fold_col="fold")
    rows = [
        F.struct(F.lit(float(reg)).alias("reg"), F.lit(fmean(held_out)).alias("mean_auc"))
        for reg, held_out in zip(models.REG_GRID, areas, strict=True)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


@query("model_run")
def model_run(spark, sf_dir):
    """One SVM from split to area under the curve."""
    train, test = _scaled_split(spark, sf_dir)
    model = models.train_svm(train, "scaled")
    return metrics.auc(models.score(model, test, models.margin()))


def _config(spark, **changes):
    full = {"topics": topics.TOPICS, "topic_iterations": topics.ROUNDS, "parallelism": 8}
    return store_config(spark, **{**full, **changes})


@query("model_grid")
def model_grid(spark, sf_dir):
    """Area under the curve of every cohort and feature set, notes included."""
    cfg = _config(spark)
    return study.run_all(spark, roles.inputs(spark, sf_dir), cfg)


@query("staged_run")
def staged_run(spark, sf_dir):
    """Features with notes and held-out predictions by logistic regression, all cohorts."""
    cfg = _config(spark, holdout=True)
    return study.run_all(spark, roles.inputs(spark, sf_dir), cfg)

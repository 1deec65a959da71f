"""Metrics over scores that both engines can compute exactly."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayscope.operators import metrics
from stayscope.sources import sinks
from stayscope.storage import new_path
from stayscope.workload import roles
from stayscope.workload.registry import query


def scored(spark, sf_dir):
    """Documents scored by length, labelled by quality, in groups by source."""
    documents = roles.table(spark, sf_dir, "documents")
    labels = roles.table(spark, sf_dir, "labels")
    return documents.join(labels, "doc_id").select(
        "source",
        F.round(F.col("n_chars") / 1000.0, 1).alias("score"),
        F.col("quality").cast("double").alias("label"),
    )


_SCORED_SQL = """
scored AS (
  SELECT source, round(n_chars / 1000.0, 1) AS score, CAST(quality AS DOUBLE) AS label
  FROM documents JOIN labels USING (doc_id))"""


def _ranked_sql(by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    keys = f"{by}, " if by else ""
    return f"""{_SCORED_SQL},
merged AS (
  SELECT {keys}score, count(*) FILTER (WHERE label > 0.5) AS pos,
         count(*) FILTER (WHERE label <= 0.5) AS neg
  FROM scored GROUP BY {keys}score),
ranked AS (
  SELECT *, sum(pos) OVER ({part}ORDER BY score DESC) AS tp,
         sum(neg) OVER ({part}ORDER BY score DESC) AS fp,
         row_number() OVER ({part}ORDER BY score DESC) AS step
  FROM merged)"""


_AUC = """CASE WHEN sum(pos) > 0 AND sum(neg) > 0
      THEN round(CAST(sum(neg * (tp - pos / 2.0)) AS DOUBLE) / (sum(pos) * sum(neg)), 9) END AS auc,
    CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg"""


@query("auc", f"WITH {_ranked_sql()} SELECT {_AUC} FROM ranked")
def auc(spark, sf_dir):
    return metrics.auc(scored(spark, sf_dir)).withColumn("auc", F.round("auc", 9))


@query("auc_by_group", f"WITH {_ranked_sql('source')} SELECT source, {_AUC} FROM ranked GROUP BY source")
def auc_by_group(spark, sf_dir):
    return metrics.auc(scored(spark, sf_dir), ["source"]).withColumn("auc", F.round("auc", 9))


_CURVE_SQL = f"""WITH {_ranked_sql()},
sizes AS (SELECT sum(pos) AS p, sum(neg) AS n, count(*) AS k FROM merged)
SELECT CAST(step AS BIGINT) AS step, score AS threshold,
       round(CAST(fp AS DOUBLE) / n, 9) AS fpr, round(CAST(tp AS DOUBLE) / p, 9) AS tpr
FROM ranked, sizes
UNION ALL SELECT 0, NULL, 0.0, 0.0
UNION ALL SELECT k + 1, NULL, 1.0, 1.0 FROM sizes"""


def _curve(spark, sf_dir):
    curve = metrics.roc_curve(scored(spark, sf_dir))
    return curve.withColumn("fpr", F.round("fpr", 9)).withColumn("tpr", F.round("tpr", 9))


@query("roc_curve", _CURVE_SQL)
def roc_curve(spark, sf_dir):
    return _curve(spark, sf_dir)


@query("roc_export", _CURVE_SQL)
def roc_export(spark, sf_dir):
    curve = _curve(spark, sf_dir)
    path = new_path(spark, "roc")
    sinks.write_roc(curve, path)
    return spark.read.option("header", True).schema(curve.schema).csv(path)


@query(
    "threshold_metrics",
    f"""WITH {_SCORED_SQL},
c AS (
  SELECT count(*) FILTER (WHERE label > 0.5 AND score > 1.5) AS tp,
         count(*) FILTER (WHERE label <= 0.5 AND score > 1.5) AS fp,
         count(*) FILTER (WHERE label <= 0.5 AND score <= 1.5) AS tn,
         count(*) FILTER (WHERE label > 0.5 AND score <= 1.5) AS fn
  FROM scored)
SELECT tp, fp, tn, fn, round(CAST(tp + tn AS DOUBLE) / (tp + fp + tn + fn), 9) AS accuracy,
       round(CAST(tp AS DOUBLE) / (tp + fp), 9) AS "precision",
       round(CAST(tp AS DOUBLE) / (tp + fn), 9) AS recall,
       round(2.0 * tp / (2 * tp + fp + fn), 9) AS f1 FROM c""",
)
def threshold_metrics(spark, sf_dir):
    found = metrics.threshold_metrics(scored(spark, sf_dir), 1.5)
    for c in ("accuracy", "precision", "recall", "f1"):
        found = found.withColumn(c, F.round(c, 9))
    return found

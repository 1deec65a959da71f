"""Areas of held-out folds against Spark's cross-validator."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from stayscope.operators import models


@pytest.fixture(scope="module")
def noisy(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        y = float(rng.random() < 0.4)
        rows.append((i, y, i % 3, Vectors.dense([y + rng.gauss(0, 1.2), rng.random(), float(i % 4)])))
    data = spark.createDataFrame(rows, ["id", "label", "fold", "features"])
    return data.withColumn("fold", F.col("fold").cast("int"))


def _jobs(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_areas_are_those_of_sparks_cross_validator_with_fewer_jobs(spark, noisy):
    grid = (0.5, 0.01)
    stages = models.indexed_lr_stages(noisy)
    lr = stages.getStages()[2]
    plain = CrossValidator(
        estimator=stages,
        estimatorParamMaps=ParamGridBuilder().addGrid(lr.regParam, list(grid)).build(),
        evaluator=BinaryClassificationEvaluator(labelCol="indexed_label", rawPredictionCol="prediction"),
        numFolds=3,
        foldCol="fold",
        parallelism=2,
    )
    theirs, their_jobs = _jobs(spark, "plain", lambda: plain.fit(noisy))
    ours, our_jobs = _jobs(spark, "ours", lambda: models.cross_validate(noisy, noisy, grid, folds=3, fold_col="fold"))
    assert ours.avgMetrics == pytest.approx(theirs.avgMetrics, abs=1e-12)
    assert ours.stdMetrics == pytest.approx(theirs.stdMetrics, abs=1e-12)
    assert 0 < our_jobs < their_jobs - 3 * len(grid)
    assert ours.bestModel.transform(noisy).select("prediction").collect() == (
        theirs.bestModel.transform(noisy).select("prediction").collect()
    )
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_random_folds_use_every_row_once(spark, noisy):
    stages = models.indexed_lr_stages(noisy)
    areas = models.fold_areas(noisy, stages, (0.01,), folds=2)
    assert [len(a) for a in areas] == [2] and all(0.5 < x < 1 for x in areas[0])


def test_a_missing_or_unknown_fold_is_an_error(noisy):
    stages = models.indexed_lr_stages(noisy)
    for folds in (2, 4):
        with pytest.raises(ValueError, match="folds"):
            models.fold_areas(noisy, stages, (0.01,), folds=folds, fold_col="fold")


@pytest.mark.parametrize(
    "labels,predicted,area",
    [([1, 1, 0, 0], [1, 0, 0, 0], 0.75), ([0, 0], [1, 0], 0.0), ([1, 1], [1, 0], 1.0), ([1, 0], [0, 0], 0.5), ([1, 0], [1, 1], 0.5)],
)
def test_area_of_hard_predictions(spark, labels, predicted, area):
    rows = spark.createDataFrame(list(zip(map(float, labels), map(float, predicted))), ["indexed_label", "prediction"])
    assert models._hard_area(rows) == pytest.approx(models.hard_auc(rows), abs=1e-12) == pytest.approx(area)

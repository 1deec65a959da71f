import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import Observation, functions as F

from stayscope.operators import models


@pytest.mark.parametrize("train", [models.train_svm, models.train_lr, models.train_dt, models.train_rf])
def test_models_score_after_an_observed_query(spark, train, tmp_path):
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).write.parquet(str(tmp_path / "seen"))
    assert seen.get["n"] == 3
    rows = [(i, float(i % 2), Vectors.dense([float(i % 2), 1.0])) for i in range(20)]
    df = spark.createDataFrame(rows, ["id", "label", "features"])
    assert models.score(train(df), df, models.predicted_class()).where("score = label").count() == 20


def test_indexed_lr_after_an_observed_query(spark, tmp_path):
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).write.parquet(str(tmp_path / "seen"))
    assert seen.get["n"] == 3
    rows = [(i, float(i % 2), Vectors.dense([float(i % 2), 1.0])) for i in range(20)]
    df = spark.createDataFrame(rows, ["id", "label", "features"])
    fitted = models.fit_indexed_lr(df, df).transform(df)
    assert fitted.where(F.col("predicted_label").cast("double") == F.col("label")).count() == 20

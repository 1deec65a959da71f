"""Binary classifiers on sparse vectors, and the scores they give."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import Column, DataFrame, functions as F

# Training parameters of the standard models.
SVM_ITERATIONS, SVM_REG, SVM_TOLERANCE = 1000, 0.01, 1e-6
LR_ITERATIONS, LR_REG = 10_000, 0.0001
TREE_DEPTH, TREE_BINS = 5, 32
FOREST_TREES, FOREST_DEPTH = 10, 10
INDEXED_LR = {"regParam": 0.001, "elasticNetParam": 0.0, "maxIter": 100, "tol": 1e-6}
REG_GRID = (0.1, 0.01, 0.001, 0.0001)

_BINARY = {"ml_attr": {"type": "nominal", "vals": ["0.0", "1.0"]}}


def two_classes(df: DataFrame, label: str = "label") -> DataFrame:
    """Declare the label binary, so that a sample with one class still trains."""
    return df.withColumn(label, F.col(label).alias(label, metadata=_BINARY))


def without_summary(model: Model) -> Model:
    """The model without the summary of its training, which holds the session.

    Once a query of the session was observed, the session cannot be sent to tasks, and so neither can a model that
    holds it.
    """
    nothing = SparkContext._active_spark_context._jvm.scala.Option.empty()
    for stage in model.stages if isinstance(model, PipelineModel) else [model]:
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(nothing)
    return model


def train_svm(
    train: DataFrame,
    features: str = "features",
    iterations: int = SVM_ITERATIONS,
    reg: float = SVM_REG,
    tolerance: float = SVM_TOLERANCE,
) -> Model:
    """Linear SVM: hinge loss, L2 penalty, no intercept, by a quasi-Newton optimiser.

    :func:`stayscope.operators.gradient.train_svms` descends by gradients instead, all samples at once.
    """
    svm = LinearSVC(
        featuresCol=features,
        maxIter=iterations,
        regParam=reg,
        tol=tolerance,
        fitIntercept=False,
        standardization=False,
    )
    return without_summary(svm.fit(two_classes(train)))


def train_lr(
    train: DataFrame, features: str = "features", iterations: int = LR_ITERATIONS, reg: float = LR_REG
) -> Model:
    """Logistic regression: L2 penalty, no intercept."""
    lr = LogisticRegression(
        featuresCol=features,
        maxIter=iterations,
        regParam=reg,
        elasticNetParam=0.0,
        fitIntercept=False,
        family="binomial",
    )
    return without_summary(lr.fit(two_classes(train)))


def train_dt(train: DataFrame, features: str = "features") -> Model:
    tree = DecisionTreeClassifier(
        featuresCol=features, maxDepth=TREE_DEPTH, maxBins=TREE_BINS, impurity="gini"
    )
    return tree.fit(two_classes(train))


def train_rf(train: DataFrame, features: str = "features", seed: int = 11) -> Model:
    forest = RandomForestClassifier(
        featuresCol=features,
        numTrees=FOREST_TREES,
        maxDepth=FOREST_DEPTH,
        maxBins=TREE_BINS,
        impurity="gini",
        featureSubsetStrategy="auto",
        seed=seed,
    )
    return without_summary(forest.fit(two_classes(train)))


def margin() -> Column:
    """Raw score of the positive class."""
    return vector_to_array("rawPrediction")[1]


def probability() -> Column:
    return vector_to_array("probability")[1]


def predicted_class() -> Column:
    return F.col("prediction")


def score(model: Model, df: DataFrame, value: Column, keep: Sequence[str] = ("id", "label")) -> DataFrame:
    """The columns of ``keep`` and the model's ``score``."""
    return model.transform(df).select(*keep, value.alias("score"))


def index_labels(df: DataFrame, label: str = "label", output: str = "indexed_label") -> StringIndexerModel:
    """Label values numbered by falling frequency."""
    return StringIndexer(inputCol=label, outputCol=output).fit(df)


def indexed_lr_stages(data: DataFrame, features: str = "features") -> Pipeline:
    """Label indexer, categorical feature indexer, logistic regression, label decoder."""
    labels = index_labels(data)
    columns = VectorIndexer(inputCol=features, outputCol="indexed_features").fit(data)
    lr = LogisticRegression(
        featuresCol="indexed_features", labelCol="indexed_label", fitIntercept=True, **INDEXED_LR
    )
    decoder = IndexToString(
        inputCol="prediction", outputCol="predicted_label", labels=labels.labels
    )
    return Pipeline(stages=[labels, columns, lr, decoder])


def fit_indexed_lr(train: DataFrame, data: DataFrame) -> PipelineModel:
    """Fit :func:`indexed_lr_stages`; the indexers see all of ``data``."""
    return without_summary(indexed_lr_stages(data).fit(train))


def hard_auc(predictions: DataFrame) -> float:
    """Area under the two-point curve of the predicted classes."""
    evaluator = BinaryClassificationEvaluator(
        labelCol="indexed_label", rawPredictionCol="prediction", metricName="areaUnderROC"
    )
    return evaluator.evaluate(predictions)


def _hard_area(predictions: DataFrame) -> float:
    """:func:`hard_auc` from the four counts, in one job; the rate of a missing class is 0."""
    actual, called = F.col("indexed_label") > 0.5, F.col("prediction") > 0.5
    tp, fp, p, n = predictions.agg(
        F.count_if(actual & called), F.count_if(~actual & called), F.count_if(actual), F.count_if(~actual)
    ).first()
    # Under the line from (0, 0) over the points of both predictions to (1, 1).
    tpr, fpr = tp / p if p else 0.0, fp / n if n else 0.0
    last_tpr, last_fpr = float(p > 0), float(n > 0)
    return fpr * tpr / 2 + (last_fpr - fpr) * (tpr + last_tpr) / 2 + (1 - last_fpr) * (last_tpr + 1) / 2


def fold_areas(
    train: DataFrame,
    stages: Pipeline,
    reg_grid: Sequence[float] = REG_GRID,
    folds: int = 5,
    seed: int = 11,
    parallelism: int = 4,
    fold_col: str = "",
) -> list[list[float]]:
    """Areas of held-out folds per L2 strength of :func:`indexed_lr_stages`.

    The indexers are fitted already, so rows are indexed once and kept; only the regressions are fitted
    per fold and strength, ``parallelism`` at a time over all of them.
    """
    labels, columns, lr, _ = stages.getStages()
    fold = F.col(f"`{fold_col}`") if fold_col else F.floor(F.rand(seed) * folds)
    rows = labels.transform(train.withColumn("_fold", fold.cast("int")))
    rows = columns.transform(rows).select("_fold", "indexed_label", "indexed_features").persist()

    def area(task: tuple[int, float]) -> float:
        held_out, reg = task
        model = without_summary(lr.copy({lr.regParam: reg}).fit(rows.where(F.col("_fold") != held_out)))
        return _hard_area(model.transform(rows.where(F.col("_fold") == held_out)))

    try:
        found = {r["_fold"] for r in rows.groupBy("_fold").count().collect()}
        if found != set(range(folds)):
            raise ValueError(f"rows fall into folds {sorted(found, key=str)}, not into each of 0 to {folds - 1}")
        tasks = [(k, reg) for k in range(folds) for reg in reg_grid]
        with ThreadPool(min(parallelism, len(tasks))) as pool:
            areas = pool.map(inheritable_thread_target(train.sparkSession)(area), tasks, chunksize=1)
    finally:
        rows.unpersist()
    return [areas[i :: len(reg_grid)] for i in range(len(reg_grid))]


def cross_validate(
    train: DataFrame,
    data: DataFrame,
    reg_grid: Sequence[float] = REG_GRID,
    folds: int = 5,
    seed: int = 11,
    parallelism: int = 4,
    fold_col: str = "",
) -> CrossValidatorModel:
    """Search the L2 strength of the indexed logistic regression by cross-validation.

    ``fold_col`` names a column of ``train`` with each row's fold (see
    :func:`stayscope.operators.split.with_fold`); by default rows fall into folds at random, which
    depends on how they are laid out.
    """
    stages = indexed_lr_stages(data)
    areas = fold_areas(train, stages, reg_grid, folds, seed, parallelism, fold_col)
    means = [fmean(a) for a in areas]
    lr = stages.getStages()[2]
    best = without_summary(stages.fit(train, {lr.regParam: reg_grid[means.index(max(means))]}))
    return CrossValidatorModel(best, means, [], [pstdev(a) for a in areas])

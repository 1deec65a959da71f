import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stayscope.operators import events as ev
from stayscope.operators import matrix as mx
from stayscope.operators import metrics, ordered, scaling, skew, split, static

HOT = {"min_rows": 5, "small_bytes": 0}
T0 = dt.datetime(2020, 1, 1)
HOUR, SECOND = dt.timedelta(hours=1), dt.timedelta(seconds=1)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the events belong to one entity."""
    rng = random.Random(3)
    data = []
    for i in range(600):
        who = "hot" if i % 3 == 0 else f"e{rng.randrange(40)}"
        data.append((who, T0 + rng.randrange(200) * HOUR, f"c{rng.randrange(6)}", float(rng.randrange(9))))
    return spark.createDataFrame(data, "id string, ts timestamp_ntz, code string, value double")


@pytest.fixture(scope="module")
def cohort(spark):
    ids = ["hot"] + [f"e{i}" for i in range(35)]
    data = [(k, T0 + (50 + 3 * i) * HOUR) for i, k in enumerate(ids)]
    return spark.createDataFrame(data, "id string, index_ts timestamp_ntz")


def test_hot_keys_are_the_frequent_ones(skewed):
    assert rows(skew.hot_keys(skewed, "id", max_keys=1, min_rows=5)) == [("hot",)]
    assert skew.hot_keys(skewed, "id", max_keys=10, min_rows=10_000).count() == 0


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("max_keys", [1, 100])
def test_skew_join_equals_plain_join(skewed, cohort, how, max_keys):
    plain = skewed.join(cohort, "id", how)
    split_join = skew.skew_join(skewed, cohort, "id", how=how, max_keys=max_keys, **HOT)
    assert rows(split_join.select(plain.columns)) == rows(plain)


def test_skew_join_runs_costly_inputs_once(skewed, cohort):
    counted = skewed.groupBy("id").count().join(skewed, "id")
    assert skew.is_scan(skewed.filter("id <> 'x'").select("id")) and not skew.is_scan(counted)
    one = cohort.groupBy("id").count().select("id")
    joined = skew.skew_join(counted, one, "id", how="left_semi", **HOT)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    # Only hot keys are still counted: once in each branch, over the written table.
    assert plan.count("Aggregate [id") == 3 and plan.count("Relation [") == 7
    assert sorted(rows(joined)) == sorted(rows(counted.join(one, "id", "left_semi")))


def test_skew_join_does_not_shuffle_hot_rows(skewed, cohort):
    plan = skew.skew_join(skewed, cohort, "id", **HOT)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_as_of_is_inclusive_and_looks_back(spark):
    events = spark.createDataFrame(
        [("a", T0 - SECOND, "x"), ("a", T0, "y"), ("a", T0 + SECOND, "z"), ("b", T0, "w")],
        "id string, ts timestamp_ntz, code string",
    )
    members = spark.createDataFrame([("a", T0)], "id string, index_ts timestamp_ntz")
    assert {r["code"] for r in ev.as_of(events, members).collect()} == {"x", "y"}
    recent = ev.as_of(events, members, lookback=F.expr("INTERVAL '0' SECOND"))
    assert {r["code"] for r in recent.collect()} == {"y"}


def test_counts_and_means_against_brute_force(skewed, cohort):
    cut = {r["id"]: r["index_ts"] for r in cohort.collect()}
    n, total = {}, {}
    for r in skewed.collect():
        if r["id"] in cut and r["ts"] <= cut[r["id"]]:
            key = (r["id"], r["code"])
            n[key] = n.get(key, 0) + 1
            total[key] = total.get(key, 0.0) + r["value"]
    for options in ({}, HOT):
        known = ev.as_of(skewed, cohort, **options)
        counted = {(r[0], r[1]): r[2] for r in ev.count_features(known, "").collect()}
        assert counted == n
        means = {(r[0], r[1]): r[2] for r in ev.mean_features(known, "").collect()}
        assert means == pytest.approx({k: total[k] / n[k] for k in n})


def test_grid_features_equal_single_cohorts(skewed, cohort):
    names = ["early", "late"]
    cutoffs = cohort.select(
        "id", (F.col("index_ts") - F.expr("INTERVAL '30' HOUR")).alias("early"), F.col("index_ts").alias("late")
    )
    for options in ({}, HOT):
        counted = ev.count_features_grid(skewed, cutoffs, names, "C-", **options)
        means = ev.mean_features_grid(skewed, cutoffs, names, "V-", **options)
        for n in names:
            one = ev.as_of(skewed, cutoffs.select("id", F.col(n).alias("index_ts")))
            same = counted.filter(F.col("cohort") == n).drop("cohort")
            assert rows(same) == rows(ev.count_features(one, "C-"))
            same = means.filter(F.col("cohort") == n).drop("cohort")
            assert rows(same) == rows(ev.mean_features(one, "V-"))


def test_empty_codes_and_missing_values(spark):
    events = spark.createDataFrame(
        [("a", "", 1.0, True), ("a", "x", 4.0, True), ("a", "x", 0.0, False)],
        "id string, code string, value double, measured boolean",
    )
    assert rows(ev.mean_features(events, "L-")) == [("a", "L-x", 2.0)]
    assert rows(ev.mean_features(events, "L-", measured_col="measured")) == [("a", "L-x", 4.0)]


def test_ids_are_compared_as_numbers(spark):
    scores = spark.createDataFrame(
        [("a", "9", "1", 1.0), ("a", "10", "2", 2.0), ("a", "10", "11", 3.0)],
        "id string, admission_id string, episode_id string, s double",
    )
    latest = static.latest_scores(scores)
    assert rows(latest.select("s")) == [(3.0,)]
    assert rows(static.wide_to_tuples(latest, {"s": "score"})) == [("a", "score", 3.0)]
    flags = scores.filter("episode_id <> '11'").drop("episode_id")
    assert rows(static.latest_flags(flags).select("s")) == [(2.0,)]


@pytest.mark.parametrize("n", [0, 1, 500])
def test_positions_are_dense_and_sorted(spark, n):
    names = [f"k{i * 7919 % 1000:04d}" for i in range(n)]
    df = spark.createDataFrame([(k,) for k in names], "k string")
    found = {r["k"]: r["idx"] for r in ordered.with_position(df, ["k"]).collect()}
    assert found == {k: i for i, k in enumerate(sorted(names))}


def test_running_totals(spark):
    rng = random.Random(5)
    data = [(f"g{i % 3}", i, rng.randrange(10)) for i in range(400)]
    df = spark.createDataFrame(data, "g string, i int, v int")
    totals = {"before": F.col("v"), "n": F.lit(1)}
    found = ordered.with_running_totals(df, ["g", F.desc("i")], totals).collect()
    seen = 0
    in_order = sorted(found, key=lambda r: (r["g"], -r["i"]))
    for place, r in enumerate(in_order):
        assert (r["before"], r["n"]) == (seen, place)
        seen += r["v"]


def test_matrix_round_trip(spark):
    tuples = spark.createDataFrame(
        [("a", "f2", 2.0), ("a", "f1", 1.0), ("b", "f2", 0.0)], "id string, feature string, value double"
    )
    labels = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "id string, label double")
    matrix = {r["id"]: r for r in mx.feature_matrix(tuples, labels).collect()}
    assert matrix["a"]["features"].toArray().tolist() == [1.0, 2.0]
    assert matrix["b"]["features"].indices.tolist() == [1] and matrix["b"]["label"] == 0.0


def test_large_dictionaries_are_joined_without_broadcast(spark):
    tuples = spark.createDataFrame(
        [(f"e{i}", "age" if i % 3 else f"f{i}", float(i)) for i in range(60)],
        "id string, feature string, value double",
    )
    dictionary = mx.feature_dictionary(tuples)
    small = mx.index_tuples(tuples, dictionary)
    large = mx.index_tuples(tuples, dictionary, max_broadcast=0)
    assert rows(small.select("id", "idx", "value")) == rows(large.select("id", "idx", "value"))


def test_repeated_features_and_missing_labels_are_errors(spark):
    twice = spark.createDataFrame([("a", 0, 1.0), ("a", 0, 2.0)], "id string, idx int, value double")
    with pytest.raises(Exception, match="occurs twice"):
        mx.sparse_rows(twice, 1).collect()
    vectors = mx.sparse_rows(twice.limit(1), 1)
    labels = spark.createDataFrame([("b", 1.0)], "id string, label double")
    with pytest.raises(Exception, match="no label"):
        mx.join_labels(vectors, labels).collect()
    assert mx.join_labels(vectors, labels, missing="drop").count() == 0


def test_stddev_counts_absent_entities_as_zero(spark):
    tuples = spark.createDataFrame([("a", "f", 3.0), ("b", "f", 1.0)], "id string, feature string, value double")
    found = scaling.feature_stddev(tuples, 4).collect()[0]["stddev"]
    values = [3.0, 1.0, 0.0, 0.0]
    mean = sum(values) / 4
    assert found == pytest.approx((sum((v - mean) ** 2 for v in values) / 3) ** 0.5)


def test_split_by_ids(spark, skewed):
    held = spark.createDataFrame([("hot",), ("absent",), ("e1",), ("e1",)], "id string")
    for options in ({}, HOT):
        train, test = split.split_by_ids(skewed, held, **options)
        assert {r["id"] for r in test.select("id").distinct().collect()} == {"hot", "e1"}
        assert train.count() + test.count() == skewed.count()


def test_hash_split_ignores_layout(spark):
    ids = spark.range(2000).select(F.col("id").cast("string").alias("id"))
    first, _ = split.split_by_hash(ids)
    again, rest = split.split_by_hash(ids.repartition(7))
    assert rows(first) == rows(again)
    assert 0.65 < first.count() / 2000 < 0.75 and first.count() + rest.count() == 2000


def brute_auc(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_and_roc_against_brute_force(spark):
    rng = random.Random(9)
    pairs = [(rng.randrange(12) / 4, float(rng.random() < 0.4)) for _ in range(300)]
    scored = spark.createDataFrame(pairs, "score double, label double")
    assert metrics.auc(scored).collect()[0]["auc"] == pytest.approx(brute_auc(pairs))
    curve = metrics.roc_curve(scored).orderBy("step").collect()
    assert (curve[0]["fpr"], curve[0]["tpr"]) == (0.0, 0.0)
    assert (curve[-1]["fpr"], curve[-1]["tpr"]) == (1.0, 1.0)
    assert [r["step"] for r in curve] == list(range(len(curve)))
    area = sum(
        (b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(curve, curve[1:])
    )
    assert area == pytest.approx(brute_auc(pairs))


def test_one_class_has_no_auc(spark):
    scored = spark.createDataFrame([("m", 0.1, 1.0), ("m", 0.2, 1.0)], "model string, score double, label double")
    assert metrics.auc(scored, ["model"]).collect()[0]["auc"] is None


def test_threshold_metrics(spark):
    scored = spark.createDataFrame(
        [(0.9, 1.0), (0.8, 0.0), (0.2, 1.0), (0.1, 0.0)], "score double, label double"
    )
    r = metrics.threshold_metrics(scored, 0.5).collect()[0]
    assert (r["tp"], r["fp"], r["tn"], r["fn"]) == (1, 1, 1, 1)
    assert r["accuracy"] == r["precision"] == r["recall"] == r["f1"] == 0.5

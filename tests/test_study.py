import dataclasses
import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from stayscope import config
from stayscope.operators import metrics, models, scaling, split
from stayscope.plans import study
from stayscope.sources import clinical, libsvm
from tests.test_sources import FILES


@pytest.fixture(scope="module")
def separable(spark):
    rng = random.Random(1)
    rows = []
    for i in range(200):
        y = float(i % 3 == 0)
        # The models have no intercept, so the classes are parted by a plane through 0.
        x = [2 * y + rng.random(), 2 * (1 - y) + rng.random()]
        rows.append((i, y, Vectors.sparse(4, [0, 2], x)))
    return spark.createDataFrame(rows, ["id", "label", "features"])


@pytest.mark.parametrize("kind", ["svm", "lr", "dt", "rf"])
def test_models_separate(separable, kind):
    train, test = split.split_by_hash(separable)
    train, test = scaling.scale_features(train, test)
    fit, value = {
        "svm": (models.train_svm, models.margin()),
        "lr": (models.train_lr, models.probability()),
        "dt": (models.train_dt, models.predicted_class()),
        "rf": (models.train_rf, models.predicted_class()),
    }[kind]
    options = {"iterations": 25} if kind in ("svm", "lr") else {}
    scored = models.score(fit(train, "scaled", **options), test, value)
    assert metrics.auc(scored).collect()[0]["auc"] > 0.95


def test_one_class_still_trains(separable):
    only = separable.filter("label = 0")
    assert models.score(models.train_svm(only, iterations=3), only, models.margin()).count() == only.count()


def test_indexed_lr_and_cross_validation(separable):
    train, test = split.split_by_hash(separable)
    fitted = models.fit_indexed_lr(train, separable)
    predictions = fitted.transform(test)
    assert models.hard_auc(predictions) > 0.9
    assert {r[0] for r in predictions.select("predicted_label").distinct().collect()} <= {"0.0", "1.0"}
    grid = models.cross_validate(train, separable, reg_grid=(0.1, 0.001), folds=2)
    assert len(grid.avgMetrics) == 2 and max(grid.avgMetrics) > 0.9


def test_scaling_modes(separable):
    train, test = split.split_by_hash(separable)
    for mode in ("train", "all", "each"):
        scaled_train, scaled_test = scaling.scale_features(train, test, mode)
        assert "scaled" in scaled_train.columns and "scaled" in scaled_test.columns
    alone, none = scaling.scale_features(train)
    assert none is None and alone.count() == train.count()
    with pytest.raises(ValueError):
        scaling.scale_features(train, test, "neither")
    row = scaling.normalize(separable, 1.0).first()
    assert sum(map(abs, row["normalized"].values)) == pytest.approx(1.0)


@pytest.fixture(scope="module")
def csv_dir(tmp_path_factory):
    """The hand-written edge rows plus entities enough to train on."""
    folder = tmp_path_factory.mktemp("csv")
    extra = {name: [] for name in FILES}
    rng = random.Random(2)
    for i in range(100, 160):
        dies = i % 3 == 0
        dod = "2020-01-03 00:00:00" if dies else ""
        extra["PATIENTS.csv"].append(f"{i},{i},{'MF'[i % 2]},1950-01-01 00:00:00,{dod},,,{int(dies)}")
        extra["ICUSTAYS.csv"].append(f"{i},1,1,2020-01-01 00:00:00,2020-01-05 00:00:00")
        lab = 5 + 4 * dies + rng.random()
        extra["LABEVENTS.csv"].append(f"{i},1,50900,2020-01-01 01:00:00,x,{lab:.3f}")
        extra["DIAGNOSES_ICD.csv"].append(f"{i},1,1,D{i % 4}")
        extra["PRESCRIPTIONS.csv"].append(f"{i},1,2020-01-01 00:00:00,,Drug {i % 5}")
        word = "septic shock" if dies else "resting well"
        extra["NOTEEVENTS.csv"].append(f'{i},1,2020-01-01,,"Nursing","x","{word}\npatient {word}"')
        extra["icu_mortality_test_patients.csv"] += [str(i)] if i % 5 == 0 else []
    for name, text in FILES.items():
        (folder / name).write_bytes((text + "".join(f"{line}\n" for line in extra[name])).encode())
    return str(folder)


@pytest.fixture(scope="module")
def cfg(tmp_path_factory):
    base = tmp_path_factory.mktemp("out")
    return study.StudyConfig(
        feature_dir=str(base / "features"),
        output_dir=str(base / "output"),
        outcomes=(config.IN_STAY, config.WITHIN_30_DAYS),
        hours=(24, config.RETROSPECTIVE),
        topics=2,
        topic_iterations=3,
        svm_iterations=20,
        lr_iterations=20,
    )


def test_stages_one_and_two(spark, csv_dir, cfg):
    assert study.run_stage(spark, 1, csv_dir, cfg) is None
    names = spark.read.parquet(f"{cfg.feature_dir}/dictionary")
    day = names.filter("cohort = 'in_stay_24h'")
    assert {r["family"] for r in day.collect()} == {"base", "scores", "flags", "diag", "med", "lab", "notes"}
    for k, s in enumerate(config.FEATURE_SETS):
        held = day.filter(F.col("family").isin(list(s.families)))
        found = sorted((r["feature"], r["set_idx"][k]) for r in held.collect())
        assert [i for _, i in found] == list(range(len(found)))
        assert {r["width"][k] for r in held.collect()} == {len(found)}

    matrix = {
        r["id"]: r
        for r in study.read_matrix(spark, f"{cfg.feature_dir}/train", "in_stay_24h", "all_features").collect()
    }
    index = {r["feature"]: r["set_idx"][4] for r in day.collect()}
    nine = matrix["9"]["features"]
    # One lab before the cutoff, one missing value counted as zero, one after the cutoff.
    assert nine[index["LAB-50800"]] == 2.0
    assert nine[index["DIAG-4280"]] == 2.0
    assert nine[index["MED-Aspirin"]] == 1.0 and nine[index["MED-Heparin"]] == 1.0
    assert nine[index["saps_score"]] == 2.5 and nine[index["com-congestiveHeartFailure"]] == 1.0
    assert nine[index["patient_age"]] == 70.0 and nine[index["patient_sex"]] == 1.0
    assert matrix["9"]["label"] == 1.0 and matrix["10"]["label"] == 0.0
    assert len(matrix) == 63

    areas = {(r["cohort"], r["feature_set"]): r["auc"] for r in study.run_stage(spark, 2, csv_dir, cfg).collect()}
    assert len(areas) == 4 * 5
    assert areas[("in_stay_24h", "all_features")] > 0.75
    roc = spark.read.option("header", True).csv(f"{cfg.output_dir}/roc")
    assert roc.select("cohort", "feature_set").distinct().count() == 20


def test_libsvm_export(spark, cfg, tmp_path):
    study.export_libsvm(spark, cfg, str(tmp_path))
    rows = libsvm.read_libsvm_entries(spark, f"{tmp_path}/svlight_inICU24Hr_baseline")
    assert rows.count() > 63 and (tmp_path / "svlight_in30dRetro_all_features").exists()


def test_stage_three_needs_held_out_rows(spark, csv_dir, cfg):
    with pytest.raises(ValueError):
        study.run_stage(spark, 3, csv_dir, cfg)
    with pytest.raises(ValueError):
        study.run_stage(spark, 7, csv_dir, cfg)


def test_stage_zero_with_held_out_ids(spark, csv_dir, cfg, tmp_path):
    held = dataclasses.replace(
        cfg,
        feature_dir=str(tmp_path / "f"),
        output_dir=str(tmp_path / "o"),
        outcomes=(config.IN_STAY,),
        hours=(24,),
        notes=False,
        holdout=True,
    )
    scored = study.run_stage(spark, 0, csv_dir, held)
    ids = {r["id"] for r in scored.select("id").distinct().collect()}
    assert ids == {"10"} | {str(i) for i in range(100, 160, 5)}
    train = study.read_matrix(spark, f"{held.feature_dir}/train", "in_stay_24h", "baseline")
    assert ids.isdisjoint({r["id"] for r in train.collect()})
    path = f"{held.output_dir}/predictions/in_stay_24h_baseline"
    lines = [r["value"].split(",") for r in spark.read.text(path).collect()]
    assert sorted(int(i) for i, _ in lines) == sorted(map(int, ids))
    assert all(0.0 <= float(p) <= 1.0 for _, p in lines)


def test_note_cutoff_choices(spark, csv_dir, cfg):
    own = study._note_groups(cfg)
    shared = study._note_groups(dataclasses.replace(cfg, note_cutoff="in_stay"))
    assert len(own) == 3 and len(shared) == 2
    assert sorted(n for g in own.values() for n in g) == sorted(c.name for c in cfg.cohorts)


def test_families_can_be_switched_off(spark, csv_dir, cfg):
    bare = dataclasses.replace(cfg, scores=False, flags=False, events=False, notes=False)
    assert [s.name for s in bare.feature_sets] == ["baseline"]
    inputs = clinical.load_all(spark, csv_dir, False, False, False, False)
    tuples, _ = study.study_tuples(inputs, bare)
    assert {r[0] for r in tuples.select("family").distinct().collect()} == {"base"}


def test_note_topics_of_all_cohorts(spark, csv_dir, cfg):
    """One model per cutoff, fitted together: shares add up to 1 and ids keep their type."""
    inputs = study.store_inputs(clinical.load_all(spark, csv_dir))
    tuples, grid = study.study_tuples(inputs, cfg)
    notes = tuples.filter("family = 'notes'")
    assert notes.schema["id"].dataType == grid.schema["id"].dataType
    found = notes.groupBy("cohort", "id").agg(F.sum("value").alias("s"), F.count("*").alias("n")).collect()
    assert {r["cohort"] for r in found} == {c.name for c in cfg.cohorts}
    assert all(r["s"] == pytest.approx(1.0) and r["n"] == cfg.topics for r in found)


def test_vocabulary_is_limited_per_cutoff(spark, cfg):
    rows = [("a", "1", "x", 5), ("a", "2", "x", 1), ("a", "1", "y", 2), ("b", "1", "y", 9), ("b", "2", "y", 1)]
    counts = spark.createDataFrame(rows + [("b", "1", "x", 1)], "corpus string, id string, term string, n bigint")
    one = study._in_vocabulary(counts, ["a", "b"], dataclasses.replace(cfg, vocabulary_size=1))
    assert sorted(map(tuple, one.collect())) == sorted(r for r in rows if (r[0], r[2]) in {("a", "x"), ("b", "y")})
    common = study._in_vocabulary(counts, ["a", "b"], dataclasses.replace(cfg, vocabulary_min_documents=2))
    assert sorted(map(tuple, common.collect())) == sorted(map(tuple, one.collect()))

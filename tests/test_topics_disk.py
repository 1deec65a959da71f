import time

import pyarrow as pa

from stayscope.operators import topics
from stayscope.storage import freed_shuffles

CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark) -> set[str]:
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (held.apply(i).getName() for i in range(held.size()))
    return {n.split("_")[1] for n in names if n.startswith("shuffle_")}


def test_rounds_leave_no_shuffle_files(spark):
    rows = [("c", f"{d}", f"t{(d * 7 + j * j) % 40}", 1 + j % 3) for d in range(30) for j in range(12)]
    counts = spark.createDataFrame(rows, "cohort string, id string, term string, n bigint")
    before = shuffle_files(spark)
    fitted = topics.fit_topics(counts, k=3, rounds=3, corpus_col="cohort")
    until = time.time() + 20
    # The shuffles of the kept edges may stay until the driver's memory is cleared, those of the rounds must not.
    while len(left := shuffle_files(spark) - before) > 2 and time.time() < until:
        time.sleep(0.5)
    assert len(left) <= 2
    assert fitted.documents.count() == 30


def test_the_setting_is_put_back(spark):
    before = spark.conf.get(CONF)
    with freed_shuffles(spark):
        assert spark.conf.get(CONF) == "true"
    assert spark.conf.get(CONF) == before


def test_own_weights_come_back_in_parts(monkeypatch, spark):
    rows = [("c", f"{d}", f"t{(d * 7 + j * j) % 40}", 1 + j % 3) for d in range(30) for j in range(12)]
    counts = spark.createDataFrame(rows, "cohort string, id string, term string, n bigint")

    def model():
        fitted = topics.fit_topics(counts, k=3, rounds=2, corpus_col="cohort")
        return {r.term: [round(x, 9) for x in r.w] for r in fitted.terms.collect()}

    whole = model()
    monkeypatch.setattr(topics, "PART_BYTES", 100)
    assert model() == whole


def test_edges_of_a_block_in_several_rows(monkeypatch, spark):
    """No row grows with its block, and the model is the same."""
    rows = [("c", f"{d}", f"t{(d * 7 + j * j) % 40}", 1 + j % 3) for d in range(30) for j in range(12)]
    edges = pa.table({"block": [7] * len(rows), **{n: [r[i] for r in rows] for i, n in enumerate(("corpus", "id", "term"))},
                      "n": [float(r[3]) for r in rows]})
    monkeypatch.setattr(topics, "ROW_EDGES", 100)
    made = pa.Table.from_batches(list(topics._read_blocks(3, 1)(edges.to_batches())))
    sizes = [len(x) for x in made.column("n").to_pylist() if x is not None]
    assert sum(sizes) == len(rows) and max(sizes) == 100
    counts = spark.createDataFrame(rows, "cohort string, id string, term string, n bigint")

    def model():
        fitted = topics.fit_topics(counts, k=3, rounds=2, corpus_col="cohort")
        return {r.id: [round(x, 9) for x in r.w] for r in fitted.documents.collect()}

    several = model()
    monkeypatch.setattr(topics, "ROW_EDGES", 10_000)
    assert model() == several

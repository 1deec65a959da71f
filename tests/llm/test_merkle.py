import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from stayscope.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def runs(nodes, fanout=3):
    return [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]


def climb(nodes):
    """All levels, from the leaves to the single top."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(r)) for r in runs(levels[-1])])
    return levels


def steps(levels, i):
    for level in levels[:-1]:
        run, slot = level[i // 3 * 3 : i // 3 * 3 + 3], i % 3
        yield "".join(run[:slot]), "".join(run[slot + 1 :])
        i //= 3


def expected(rows):
    groups = {}
    for doc_id, text, lang, source, n_chars in rows:
        changed = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            changed = text.replace("\n", "")
        key = b"" if source is None else b"g" + source.encode()
        one = (doc_id is not None, doc_id or 0, leaf(doc_id, source, lang, n_chars, text))
        groups.setdefault(key, []).append((*one, doc_id, leaf(doc_id, source, lang, n_chars, changed)))
    keys = sorted(groups)
    trees = [climb([r[2] for r in sorted(groups[k], key=lambda r: r[:3])]) for k in keys]
    over = climb([t[-1][0] for t in trees])
    out = []
    for g, key in enumerate(keys):
        for i, (_, _, own, doc_id, changed) in enumerate(sorted(groups[key], key=lambda r: r[:3])):
            path = [*steps(trees[g], i), *steps(over, g)]
            folded = changed
            for before, after in path:
                folded = sha(before + folded + after)
            root, proof = over[-1][0], sha("".join(a + b for a, b in path))
            out.append((doc_id, own, trees[g][-1][0], root, proof, folded, folded == root))
    return out


def write(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_merkle_manifest(spark, str(tmp_path))
    assert found.columns == "doc_id leaf subroot root proof_sha256 folded_root verified".split()
    return sorted(map(tuple, found.collect()), key=str)


AWKWARD = [
    *[(i, f"line {i}\nnext", "en", "s1", 11) for i in range(30)],
    *[(i, f"text {i}", None, None, None) for i in range(10)],
    (7, "a\nb", "de", "s2", 3),
    *[(i, "é\n\n" * i, "fr", "Z", i) for i in range(4)],
    *[(5, "same\nrow", "en", "s1", 8)] * 4,
    (None, None, None, None, None),
    (None, "x\ny", "en", "s1", 3),
    (3, "", "", "", 0),
    (4, "long\n" * 200_000, "en", "s3", 1_000_000),
]


def test_every_row_against_hashing_by_hand(spark, tmp_path):
    assert write(spark, tmp_path, AWKWARD) == sorted(expected(AWKWARD), key=str)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10])
def test_one_group(spark, tmp_path, n):
    rows = [(i, f"{i}\n", "en", "s", i) for i in range(n)]
    assert write(spark, tmp_path, rows) == sorted(expected(rows), key=str)


def test_groups_of_one_row(spark, tmp_path):
    rows = [(i, f"{i}\n", "en", f"s{i}", i) for i in range(11)]
    assert write(spark, tmp_path, rows) == sorted(expected(rows), key=str)


def test_no_rows(spark, tmp_path):
    assert write(spark, tmp_path, []) == []


def test_other_fanout_and_clashing_columns(spark):
    rows = spark.range(23).select(
        F.col("id").alias("idx"), (F.col("id") % 2).alias("tree"), F.lit("p").alias("path"), F.lit("q").alias("digest")
    )
    leaves = rows.withColumn("leaf", merkle.leaf(F.col("idx"), F.col("path")))
    for fanout in (2, 5):
        proven = merkle.manifest(leaves, "tree", "idx", ["digest"], fanout)
        found = merkle.verify(proven, F.when(F.col("idx") == 6, F.lit("wrong")).otherwise(F.col("leaf")))
        verdicts = {r["idx"]: (r["verified"], r["digest"]) for r in found.collect()}
        assert verdicts == {i: (i != 6, "q") for i in range(23)}


def test_leaves_are_shuffled_without_texts(spark, tmp_path):
    spark.createDataFrame(AWKWARD[:40], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    plan = queries.op11_merkle_manifest(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and "Python" not in plan and "Window" not in plan

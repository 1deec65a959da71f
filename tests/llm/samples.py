"""Awkward rows that every operator must take: nulls, empties, ties, repeats, clashing columns."""

from __future__ import annotations

import random

LONG = "lorem " * 30_000 + "x" * 50_000


def awkward(spark, extra: dict | None = None):
    """Documents with null ids and texts, blank and long ones, repeated rows and ids.

    ``extra`` names further columns, to clash with those that an operator adds.
    """
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t\n"),
        (None, "some text without an id, of more than five words"),
        (None, None),
        (4, LONG),
        (5, "the same line of more than twenty letters\nand another"),
        (5, "the same line of more than twenty letters\nand another"),
        (6, "The Same Line of more than twenty letters \nother"),
        (7, "the same line of more than twenty letters"),
        (7, "a second text under one id"),
        (8, "ünïcödé 🦄 日本語 text\x00with nul"),
    ]
    names = {"lang": "en", **(extra or {})}
    data = [(*r, *names.values()) for r in rows]
    kinds = {str: "string", int: "bigint"}
    ddl = ", ".join(f"{n} {kinds[type(v)]}" for n, v in names.items())
    return spark.createDataFrame(data, f"doc_id bigint, text string, {ddl}")


def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string")


def write_documents(docs, path) -> str:
    """A data folder whose documents table is ``docs``."""
    docs.write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return str(path)


def invented(seed: int, n: int, words: int = 60, vocabulary: int = 400) -> list[str]:
    rng = random.Random(seed)
    known = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(vocabulary)]
    return [" ".join(rng.choices(known, k=words)) for _ in range(n)]

"""License texts inside documents: MinHash bands retrieve, exact containment verifies; native.

Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased; shingles are five
words. A template of m shingles belongs to the size class L, the smallest power of two with
m <= L and L >= 4. For each class a document is cut into windows of 2L shingles every L shingles,
so any run of m shingles lies whole in a window. A document holds a template if in some window at
least ``containment`` of the template's distinct shingles occur.

Retrieval is by one-row MinHash bands over windows. If a window holds k of a template's m shingles,
their Jaccard similarity is at least k / (2L + m - k), and b bands miss it with probability
(1-j)^b, j being the least similarity over the sizes m of the class; b is taken so that this is
at most ``miss``, one in a million. A window with fewer distinct template shingles of its class than
``containment`` of the class's shortest template asks for cannot hold one and is left out beforehand,
which loses nothing and spares most documents the hashing.

Scale: documents are not shuffled; only the few windows with a template shingle are expanded,
and only matches are grouped. Template bands are joined by key; Spark broadcasts them if they are
small, and up to ``LITERAL_SHINGLES`` template shingles in any case. The set for leaving windows out
is part of the plan up to the same bound, and beyond it is not used.

Edge cases: null, empty and very short texts hold nothing. Templates of fewer than five words have
no shingle and are refused. Repeated rows and rows of one id give one result per id and template,
the best window's; null ids are one id. An empty table gives none. Further columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayscope.llm.common import ascii_lower, let, text_or_empty
from stayscope.llm.license_texts import known

WIDTH = 5
CONTAINMENT = 0.8
MISS = 1e-6
LITERAL_SHINGLES = 20_000
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Names and wording of public license notices.
_SHORT: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at",
    ),
    ("MIT", "Released under the MIT License"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction',
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
)
#: Those, and the full texts and notices of ``license_texts``.
TEMPLATES: tuple[tuple[str, str], ...] = known(_SHORT)


def size_class(n_shingles: int) -> int:
    return max(4, 1 << (n_shingles - 1).bit_length())


def bands(length: int, containment: float = CONTAINMENT, miss: float = MISS) -> int:
    """Bands that find a template of class ``length`` with a chance of at least 1 - ``miss``."""
    similarities = []
    for m in range(length // 2 + 1 if length > 4 else 1, length + 1):
        held = math.ceil(containment * m - 1e-9)
        similarities.append(held / (2 * length + m - held))
    return math.ceil(math.log(miss) / math.log1p(-min(similarities)))


def template_table(spark: SparkSession, templates=TEMPLATES) -> tuple[DataFrame, dict[int, list[list[str]]]]:
    """``template, license, class, shingles`` as a DataFrame, and word lists by class."""
    rows, by_class = [], {}
    for k, (name, text) in enumerate(templates):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words = [w for w in re.split(BETWEEN_WORDS, lowered) if w]
        shingles = list(dict.fromkeys(" ".join(words[i : i + WIDTH]) for i in range(len(words) - WIDTH + 1)))
        if not shingles:
            raise ValueError(f"template of fewer than {WIDTH} words: {text!r}")
        length = size_class(len(words) - WIDTH + 1)
        rows.append((k, name, length, shingles))
        by_class.setdefault(length, []).append(shingles)
    schema = "template int, license string, class int, shingles array<string>"
    return spark.createDataFrame(rows, schema), by_class


def _shingles(words: Column) -> Column:
    n = F.size(words) - WIDTH
    return F.when(
        n >= 0,
        F.transform(
            F.sequence(F.lit(0), n),
            lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(WIDTH)]),
        ),
    ).otherwise(F.array().cast("array<string>"))


def _hashed(words: Column) -> Column:
    """Hashes of the shingles, straight from the words."""
    n = F.size(words) - WIDTH
    return F.when(
        n >= 0,
        F.transform(
            F.sequence(F.lit(0), n), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WIDTH)])
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _hashes_of(spark: SparkSession, shingles: list[str]) -> list[int]:
    """The numbers that ``_hashed`` gives these shingles."""
    words = spark.createDataFrame([(s.split(" "),) for s in shingles], "w array<string>")
    return [r[0] for r in words.select(F.element_at(_hashed(F.col("w")), 1)).collect()]


def _listed(numbers) -> str:
    return ", ".join(f"{n}L" if n > -(2**63) else "(-9223372036854775807L - 1L)" for n in sorted(set(numbers)))


def _minima(shingles: Column, n_bands: Column) -> Column:
    """Band number and minimum of the band's hash over the shingles."""
    return let(
        F.transform(shingles, lambda s: F.xxhash64(s)),
        lambda hashes: F.transform(
            F.sequence(F.lit(0), n_bands - 1),
            lambda j: F.struct(
                j.alias("band"), F.array_min(F.transform(hashes, lambda h: F.xxhash64(j, h))).alias("low")
            ),
        ),
    )


def scan(
    docs: DataFrame,
    templates=TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
    containment: float = CONTAINMENT,
    miss: float = MISS,
) -> DataFrame:
    """``doc_id, template, license, containment, first_word, n_windows`` of each license found.

    ``containment`` is that of the best window, ``first_word`` where the first matching window
    begins, ``n_windows`` how many match.
    """
    spark = docs.sparkSession
    table, by_class = template_table(spark, templates)
    lowered = ascii_lower(text_or_empty(F.col(f"`{text_col}`")))
    words = F.filter(F.split(lowered, BETWEEN_WORDS), lambda w: w != "")
    texts = docs.select(F.col(f"`{id_col}`").alias("doc"), words.alias("words"))
    in_class = {c: sorted({s for x in lists for s in x}) for c, lists in by_class.items()}
    n_known = len({s for part in in_class.values() for s in part})
    classes = sorted(by_class)
    n_bands = F.element_at(
        F.create_map(*[F.lit(x) for c in classes for x in (c, bands(c, containment, miss))]), F.col("class")
    )

    def parts(w: Column) -> Column:
        """Windows of all classes, as (class, first_word, words)."""

        def of(length: int) -> Column:
            last = F.greatest(F.lit(0), F.floor((F.size(w) - WIDTH) / length).cast("int"))
            return F.transform(
                F.sequence(F.lit(0), last),
                lambda k: F.struct(
                    F.lit(length).alias("class"),
                    (k * length).alias("first_word"),
                    F.slice(w, k * length + 1, 2 * length + WIDTH - 1).alias("part"),
                ),
            )

        return F.concat(*[of(c) for c in classes])

    literal = n_known <= LITERAL_SHINGLES
    if literal:
        numbers = {c: _hashes_of(spark, part) for c, part in in_class.items()}
        least = {c: min(math.ceil(containment * len(x) - 1e-9) for x in lists) for c, lists in by_class.items()}
        any_known = f"exists(hashes, h -> h IN ({_listed(h for x in numbers.values() for h in x)}))"
        texts = texts.withColumn("hashes", let(F.col("words"), _hashed)).where(F.expr(any_known)).drop("hashes")
    windows = texts.select("doc", F.inline(let(F.col("words"), parts)))
    if literal:
        # As text, since thousands of literals take seconds one by one.
        cases = " ".join(
            f"WHEN {c} THEN size(array_distinct(filter(hashes, h -> h IN ({_listed(numbers[c])})))) >= {least[c]}"
            for c in classes
        )
        windows = windows.withColumn("hashes", let(F.col("part"), _hashed))
        windows = windows.where(F.expr(f"CASE class {cases} END")).drop("hashes")
    windows = windows.select("doc", "class", "first_word", let(F.col("part"), _shingles).alias("shingles"))
    ours = windows.withColumn("key", F.explode(_minima(F.col("shingles"), n_bands)))
    # Narrow rows meet, so that no window's words travel with each of its bands.
    keys = table.select("template", "class", F.explode(_minima(F.col("shingles"), n_bands)).alias("key"))
    wanted = table.select("template", "license", F.col("shingles").alias("wanted"))
    if literal:  # the same bound holds for both
        keys, wanted = F.broadcast(keys), F.broadcast(wanted)
    candidates = (
        ours.join(keys, ["class", "key"])
        .dropDuplicates(["doc", "class", "first_word", "shingles", "template"])
        .join(wanted, "template")
    )
    share = F.size(F.array_intersect("wanted", "shingles")) / F.size("wanted")
    found = candidates.withColumn("containment", share).where(F.col("containment") >= containment)
    return found.groupBy(F.col("doc").alias("doc_id"), "template", "license").agg(
        F.max("containment").alias("containment"),
        F.min("first_word").cast("long").alias("first_word"),
        F.countDistinct("first_word").alias("n_windows"),
    )

"""The registered scan over common licenses: notices that the generator lacks, edited notices, full texts."""

from stayscope.llm import license_scan as ls
from stayscope.llm import license_texts


def names(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = [set() for _ in texts]
    for r in ls.scan(docs).collect():
        out[r.doc_id].add(r.license)
    return out


def test_notices_full_texts_and_edited_ones(spark):
    full = dict(license_texts.full_texts())
    around = "some words stand before it here {} and others follow after it there"
    cases = [
        ("Released under an MIT License", "MIT"),
        ("Licensed under CC BY-SA 4.0", "CC-BY-SA-4.0"),
        ("This is free and unencumbered software released into the public domain.", "Unlicense"),
        ("Licensed under the Eclipse Public License 2.0", "EPL-2.0"),
        ("Licensed under the GNU Affero General Public License version 3", "AGPL-3.0"),
        *((text, name) for name, text in full.items()),
    ]
    for name in ("ISC", "GPL-2.0", "LGPL-2.1", "MPL-2.0"):  # every fortieth word changed
        words = full[name].split()
        words[20::40] = ["changed"] * len(words[20::40])
        cases.append((" ".join(words), name))
    got = names(spark, [around.format(text) for text, _ in cases])
    assert [name for (_, name), found in zip(cases, got) if name not in found] == []
    assert names(spark, ["a license is needed", "free software for all of us and more"]) == [set(), set()]

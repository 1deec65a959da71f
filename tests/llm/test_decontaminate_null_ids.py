import pytest

from stayscope.llm import decontaminate as d
from tests.llm.samples import awkward
from tests.llm.test_decontaminate import brute, result


@pytest.mark.parametrize("block", [250_000, 1])
def test_items_with_a_null_id_hit_words(spark, block):
    docs = awkward(spark)
    items = [(1, "a second text under"), (None, "and another"), (None, "twenty letters"), (3, "twenty letters")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    # The brute force names a null id "None".
    want = [
        (doc, n, hit, [x for x in found if x != "None"])
        for doc, n, hit, found in brute([(r.doc_id, r.text) for r in docs.collect()], items)
    ]
    assert result(d.scan(docs, bench, block_windows=block)) == sorted(want, key=repr)
    assert any(hit and not found for _, _, hit, found in want) or any("3" in found for *_, found in want)
    only = spark.createDataFrame([(None, "a second text under")], "item_id bigint, text string")
    assert d.decontaminate(docs, only).count() == docs.count() - 1

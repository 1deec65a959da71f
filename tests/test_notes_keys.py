from collections import Counter

from stayscope.operators import notes as nt


def test_null_and_repeated_keys_give_every_note_once(spark):
    data = [("a", 1, "x"), ("a", 1, "yy"), ("a", 1, "yy"), ("a", None, "first"), ("a", None, None), ("b", 2, "z")]
    data += [(None, 1, "no id"), (None, None, "none"), ("a", 2, "last")]
    notes = spark.createDataFrame(data, "id string, seq int, text string").repartition(4)
    rows = nt.concat_notes(notes, ["seq"]).collect()
    assert Counter((r["id"], r["text"]) for r in rows) == Counter((i, t or "") for i, _, t in data)
    for who in ("a", "b", None):
        mine = sorted((r for r in rows if r["id"] == who), key=lambda r: r["position"])
        assert [r["position"] for r in mine] == list(range(len(mine)))
        at = 0
        for r in mine:
            assert r["start_char"] == at
            at += len(r["text"]) + 1
    order = [r["text"] for r in sorted((r for r in rows if r["id"] == "a"), key=lambda r: r["position"])]
    assert set(order[:2]) == {"first", ""} and sorted(order[2:5]) == ["x", "yy", "yy"] and order[5] == "last"

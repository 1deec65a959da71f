"""The whole pipeline against a brute-force version of its five stages."""

import datetime as dt
import random
import re

import pytest

import corpus_pipeline
from stayscope.llm import sentence_pieces
from stayscope.llm.queries import model_path
from tests.llm.samples import invented

pytest.importorskip("public_tokenizers")
WHITE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def good(text):
    words = WHITE.findall(text or "")
    n = len(words)
    triples = [tuple(words[i : i + 3]) for i in range(n - 2)]
    repeated = {p for i, t in enumerate(triples) if triples.count(t) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WHITE.search(x)]
    chars, marks = sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or "")
    return not (
        n < 50 or 100 * len(repeated) > 50 * n or 3 * marks > n or chars < 2 * n or chars > 25 * n
        or (len(lines) >= 10 and 100 * (len(lines) - len(set(lines))) > 80 * len(lines))
    )


def brute(docs, items):
    docs = [d for d in docs if good(d[1])]

    holders = {}
    for doc, text in docs:
        for line in text.split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
            if len(key) >= 20:
                holders.setdefault(key, set()).add(doc)

    def stays(doc, line):
        held = holders.get(line.strip(" \t\n\x0b\x0c\r").translate(LOWER), ())
        known = [x for x in held if x is not None]
        return len(held) < 3 or not known or doc == max(known)

    docs = [(doc, "\n".join(x for x in text.split("\n") if stays(doc, x))) for doc, text in docs]

    def shingles(text):
        w = WHITE.findall(text.translate(LOWER))
        return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in range(len(docs)):
        for j in range(i):
            same = docs[i][0] == docs[j][0]
            if same or (sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])):
                root[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(docs):
        low[find(i)] = min(low.get(find(i), 10**9), doc)
    docs = [d for i, d in enumerate(docs) if d[0] == low[find(i)]]

    windows = {}
    for text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        for i in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(len(w[i : i + 10]), set()).add(tuple(w[i : i + 10]))

    def hit(text):
        w = ALNUM.findall(text.translate(LOWER))
        return any(tuple(w[i : i + n]) in known for n, known in windows.items() for i in range(len(w) - n + 1))

    library = sentence_pieces.read_vocabulary(model_path()).library
    out = []
    for doc, text in docs:
        if not hit(text):
            ids = library.encode(text, add_eos=True)
            out.append((doc, len(ids), ids, library.decode(ids)))
    return sorted(out, key=repr)


def planted():
    draw = random.Random(5)
    texts = invented(1, 40, words=120, vocabulary=3000)
    hot = "This very line stands in a third of all documents of the table"
    passage = " ".join(invented(2, 1, words=14)[0].split())
    docs = [(i, t) for i, t in enumerate(texts)]
    docs += [(100 + i, f"{texts[i]}\n {hot.upper()} \n{texts[i + 1]}") for i in range(0, 16)]
    docs += [(200 + i, texts[3]) for i in range(6)]
    for i in range(6):  # near copies
        words = texts[7].split()
        words[draw.randrange(120)] = f"changed{i}"
        docs.append((300 + i, " ".join(words)))
    docs += [(400, texts[9] + " " + passage), (401, f"{passage.upper()}; " + texts[10])]
    docs += [(500, None), (501, ""), (502, "short"), (503, "again and " * 80), (504, "#$% " * 60)]
    docs += [(505, f"{hot}\n" * 12 + texts[12]), (6, texts[6]), (6, texts[6])]
    docs += [(600, " ".join(f"long{i}" for i in range(60_000)))]
    return docs, [passage, None, "", "a rare benchmark sentence of eight words here"]


def write(spark, folder, docs, items, extra=""):
    kinds = "doc_id long, text string, lang string, source string, n_chars long" + extra
    more = [0, "c", dt.date(2020, 1, 1), [1]][: extra.count(",")]
    rows = [(i, t, "en", "s", -1, *more) for i, t in docs]
    spark.createDataFrame(rows, kinds).repartition(4).write.parquet(f"{folder}/documents.parquet")
    bench = [(k, t) for k, t in enumerate(items)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_run_equals_brute_force_with_clashing_columns(spark, tmp_path):
    docs, items = planted()
    folder = write(spark, tmp_path, docs, items, ", n_words long, decoded string, row date, ids array<int>")
    found = corpus_pipeline.run(spark, folder)
    rows = sorted([(r["doc_id"], r["n_tokens"], r["ids"], r["decoded"]) for r in found.collect()], key=repr)
    want = brute(docs, items)
    assert [r[:2] for r in rows] == [r[:2] for r in want] and rows == want
    kept = {r[0] for r in rows}
    assert not kept & {400, 401, 500, 501, 502, 503, 504} and {0, 600} <= kept
    # Copies of a text of one line lose it to the largest id before the join sees them.
    assert [r[0] for r in rows if r[0] in (3, *range(200, 206)) and r[3]] == [205]


def test_stages_keep_columns_and_follow_the_text(spark, tmp_path):
    docs, items = planted()
    folder = write(spark, tmp_path, docs[:60], items, ", n_words long, decoded string, row date, ids array<int>")
    table = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, table, folder)
        assert found.schema.names == table.schema.names and found.dtypes == table.dtypes
        if name == "line_dedup":
            assert all(r["n_chars"] == len(r["text"]) for r in found.collect() if r["text"])


def test_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, write(spark, tmp_path, [], [])).collect() == []

"""The pipeline against a brute-force version of its stages."""

from __future__ import annotations

import re
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import connect, same
from tidepair.llm import language_id, queries
from tidepair.llm.common import table
from tidepair.llm.decontaminate import (
    PIECE_WORDS,
    cut_items,
    drop_contaminated,
    find_passages,
    hit_words,
    search_tables,
)
from tidepair.llm.mixing import BLOCK

from .conftest import ODD_TEXTS
from .test_native import normal, shared_out
from .test_ngram_join import A_TO_Z, expected

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_TO_Z))


def windows(text):
    w = words(text)
    n = min(10, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def hits(text, items):
    """(hit words, ids of items) by comparing every place with every window."""
    w, hit, names = words(text), set(), set()
    for name, some in items:
        for win in some:
            for i in range(len(w) - len(win) + 1):
                if w[i] == win[0] and tuple(w[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    names.add(name)
    return hit, names


def test_pipeline(spark):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in table(spark, SF, "documents").collect()]
    items = [(str(r["item_id"]), windows(r["text"])) for r in table(spark, SF, "benchmark").collect()]
    classifier = language_id.train(table(spark, SF, "documents"))
    rows = [d for d in docs if not classifier.predict(d[1])[2]]
    first = {}
    for d in sorted(rows):
        first.setdefault(normal(d[1]), d)
    rows = list(first.values())
    kept = {i for i, _, c in expected([(i, t) for i, t, _ in rows]) if i == c}
    rows = [d for d in rows if d[0] in kept]
    rows = [d for d in rows if not hits(d[1], items)[0]]
    got = corpus_pipeline.run(spark, SF).collect()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _ in rows}
    assert {r["doc_id"] for r in got} <= set(size)
    sizes, taken, goal = defaultdict(int), defaultdict(int), {}
    source = {i: s for i, _, s in rows}
    for i, s in source.items():
        sizes[s] += size[i]
    for r in got:
        assert r["size"] == size[r["doc_id"]] and 0 < r["taken"] <= 2 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
        goal[source[r["doc_id"]]] = r["target"]
    want = shared_out(sizes, dict(zip(sorted(sizes), (5, 2, 1) * len(sizes), strict=False)))
    assert {s: pytest.approx(want[s]) for s in goal} == goal
    assert all(abs(taken[s] - want[s]) <= 2 * BLOCK for s in want)


def test_stages_keep_columns_and_survive_odd_rows(spark, documents, tmp_path):
    rows = [*enumerate([*ODD_TEXTS, "a b c d e f g", "A b c d e f g", "clean words here"]), (None, "clean words here")]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    items = [(1, "one two three four five six seven eight nine ten eleven"), (2, "A-b"), (None, "zz"), (3, None), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = table(spark, str(tmp_path), "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        docs = out
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 1


@pytest.mark.parametrize("block_bytes", [4 << 20, 40])
def test_passages_of_items_of_any_length(spark, documents, monkeypatch, block_bytes):
    monkeypatch.setattr("tidepair.llm.decontaminate.BLOCK_BYTES", block_bytes)
    ten = "one two three four five six seven eight nine ten"
    items = [(1, ten + " eleven"), (1, ten), (2, "the end"), (3, "é"), (None, "nameless"), (4, None), (5, "?!")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = [ten.upper(), "x " + ten.replace(" ", "--") + " eleven twelve", "The-END the end", "fiancé É é", "nameless", *ODD_TEXTS]
    texts += [" ".join(["one two three four five six seven eight nine"] * 300), ("pad " * 700 + ten + " ") * 3]
    docs = documents(list(enumerate(texts)), ", n_words string, spans int, items int", ("x", 1, 2))
    known = [(None if i is None else str(i), windows(t)) for i, t in items]
    found = find_passages(docs, benchmark, ["doc_id"]).withColumn("n", hit_words()).collect()
    for r in found:
        hit, names = hits(texts[r["doc_id"]], known)
        assert (r["n_words"], r["n"], r["items"]) == (len(words(texts[r["doc_id"]])), len(hit), sorted(n for n in names if n))
    kept = drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, t in enumerate(texts) if not hits(t, known)[0]}
    assert find_passages(docs, benchmark.limit(0)).filter(F.size("spans") > 0).count() == 0


@pytest.mark.parametrize("n", [1, 9, 10, 11, PIECE_WORDS + 8, PIECE_WORDS + 9, PIECE_WORDS + 10, 2 * PIECE_WORDS + 9, 9000])
def test_every_window_of_an_item_is_in_one_piece(n):
    spelt = [f"w{i}" for i in range(n)]
    batch = pa.RecordBatch.from_pydict({"item_id": ["i", "j"], "text": [", ".join(spelt).upper(), "-"]})
    (cut,) = cut_items(iter([batch]))
    pieces = [p.split(" ") for p in cut.column("piece").to_pylist()]
    assert set(cut.column("item_id").to_pylist()) == {"i"}
    size = min(10, n)
    found = [tuple(p[i : i + size]) for p in pieces for i in range(len(p) - size + 1)]
    assert found == [tuple(spelt[i : i + size]) for i in range(n - size + 1)]
    assert all(size <= len(p) <= PIECE_WORDS + 9 for p in pieces)


def test_long_and_repeated_items_in_blocks_of_their_own(spark, documents, monkeypatch):
    monkeypatch.setattr("tidepair.llm.decontaminate.BLOCK_BYTES", 20_000)
    spelt = [f"w{i}" for i in range(9000)]
    text = " ".join(spelt)
    items = [("long", text)] * 50 + [("copy", text), (None, text)] + [(f"i{k:03}", "a b c d e f g h i j") for k in range(300)]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    made = search_tables(benchmark)
    assert made.count() >= 3
    # the item is three pieces, each once for each of its three ids, and the short ones
    size = len(text) * 3 + 300 * 20
    assert made.agg(F.sum(F.octet_length("tables"))).first()[0] < 100 * size + made.count() * 2**20
    cut = " ".join(spelt[PIECE_WORDS - 5 : PIECE_WORDS + 5])
    docs = documents([(0, "x " + cut + " y"), (1, " ".join(spelt[5:14])), (2, "A b c d e f g h i j k"), (3, text)])
    got = {r["doc_id"]: (r["n"], r["items"]) for r in find_passages(docs, benchmark).withColumn("n", hit_words()).collect()}
    assert got == {
        0: (10, ["copy", "long"]),
        1: (0, []),
        2: (10, [f"i{k:03}" for k in range(300)]),
        3: (9000, ["copy", "long"]),
    }


def test_whole_tables_with_several_blocks(spark, monkeypatch):
    monkeypatch.setattr("tidepair.llm.decontaminate.BLOCK_BYTES", 2_000)
    sf = "/root/testdata/sf0.01"
    assert search_tables(table(spark, sf, "benchmark")).count() >= 3
    ok, what = same(queries.op4_decontaminate(spark, sf), connect(sf), queries.ORACLES["op4_decontaminate"])
    assert ok, what

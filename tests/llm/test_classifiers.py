"""Language and toxicity: accuracy on rows that were not learned from, and odd rows."""

from __future__ import annotations

import zlib

import zstandard as zstd
from pyspark.sql import functions as F

from tidepair.llm import language_id, queries, toxicity
from tidepair.llm.common import held_out

from .conftest import ODD_TEXTS

SF = "/root/testdata/sf0.1"


def test_fold(spark):
    rows = spark.createDataFrame([(i,) for i in range(50)], "doc_id long").select("doc_id", held_out().alias("h"))
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows.collect())


def test_language_accuracy(spark):
    found = queries.op8_language_id(spark, SF).filter("held_out")
    known = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    right = found.join(known, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_language_of_odd_rows(documents):
    docs = documents([(i, t) for i, t in enumerate([*ODD_TEXTS, "12 34 !!", "the cat", "the cat"])], ", score int", (1,))
    out = {r["doc_id"]: r for r in language_id.identify_language(docs, language_id.train(docs)).collect()}
    assert len(out) == docs.count()
    for i, t in enumerate([*ODD_TEXTS, "12 34 !!"]):
        letter = any(c.isalpha() for c in t or "")
        assert (out[i]["lang_pred"] == "und") == (not letter) and 0 <= out[i]["score"] <= 1
    nothing = language_id.train(docs.filter("doc_id < 0"))
    assert {r["lang_pred"] for r in language_id.identify_language(docs, nothing).collect()} == {"und"}
    kept = language_id.drop_rejected(docs, language_id.train(docs))
    assert kept.columns == docs.columns and kept.count() == sum(any(c.isalpha() for c in t or "") for t in [*ODD_TEXTS, "the cat", "the cat"])


def test_sizes_are_those_of_plain_calls(spark):
    """The winner, score and rejection of each text against the library called by hand."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.train(docs)
    assert all(0 < len(d) <= language_id.DICTIONARY for d in model.dictionaries.values())
    parameters = language_id._parameters()
    coders = {
        lang: zstd.ZstdCompressor(
            compression_params=parameters, dict_data=zstd.ZstdCompressionDict(d, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        )
        for lang, d in model.dictionaries.items()
    }
    found = language_id.identify_language(docs, model, ["doc_id"]).join(docs.select("doc_id", "text"), "doc_id")
    for r in found.collect():
        reduced = " ".join("".join(c if c.isascii() and c.islower() or not c.isascii() else " " for c in (r["text"] or "").lower()).split())
        data = reduced.encode()
        if not any(map(str.isalpha, r["text"] or "")):
            assert r["lang_pred"] == "und" and r["rejected"]
            continue
        sizes = sorted((sum(len(c.compress(data[i : i + 2048])) for i in range(0, len(data), 2048)), lang) for lang, c in coders.items())
        (first, lang), (second, _) = sizes[:2]
        assert (r["lang_pred"], r["score"]) == (lang, 1 - first / second)
        assert r["rejected"] == (second - first + 1 < 0.002 * second)


def test_fragments_are_from_all_of_different_texts(spark, documents, monkeypatch):
    text = " ".join(f"w{i}" for i in range(2000))
    docs = documents([(i, text if i % 2 else f"{text} {i}") for i in range(200)])
    rows = language_id.fragments(docs).collect()
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)]
    assert len(rows) == len({text if i % 2 else i for i in range(200) if not held[i]})
    places = [text.find(r["text"][:100]) for r in rows]
    assert max(places) > len(text) / 2 and len(set(places)) > 50
    # copies hold most rows, but one place of the sample
    monkeypatch.setattr(language_id, "SAMPLE_TEXTS", 5)
    assert language_id.fragments(docs).count() == 5
    assert language_id.train(docs.limit(0)).dictionaries == {}


def test_toxicity_accuracy(spark):
    found = queries.op3_toxicity(spark, SF).filter("held_out")
    labels = spark.read.parquet(f"{SF}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = found.join(labels, "doc_id").collect()
    toxic = [r for r in rows if r["toxic"]]
    clean = [r for r in rows if not r["toxic"]]
    assert sum(r["predicted"] for r in toxic) > 0.9 * len(toxic)
    assert sum(r["predicted"] for r in clean) < 0.04 * len(clean)
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)


def test_toxicity_of_odd_rows(spark, documents):
    docs = documents(list(enumerate(ODD_TEXTS)), ", predicted int", (7,))
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 1), (2, None), (0, 0)], "doc_id long, toxic int")
    for some in (labels, labels.filter("toxic = 0"), labels.limit(0)):
        out = toxicity.score_toxicity(docs, toxicity.train(docs, some), ["doc_id"]).collect()
        assert len(out) == len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in out)


def test_toxicity_sample_is_a_top_k_of_each_class(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 7)
    usable = spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("toxic"))
    chosen = toxicity._chosen(usable)
    rows = [tuple(r) for r in usable.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    want = [r for y in (0, 1) for r in [r for r in rows if r[1] == y][:7]]
    assert sorted(map(tuple, chosen.collect())) == sorted(want)
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "TakeOrderedAndProject" in plan

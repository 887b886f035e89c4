"""Exact dedup, mixing and the URL filter."""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.compare import connect, same
from tidepair.llm import mixing, queries
from tidepair.llm.exact_dedup import drop_duplicates, duplicate_groups
from tidepair.llm.mixing import BLOCK, mix_plan, permuted, targets, taken_words
from tidepair.llm.url_filter import judge_urls, parsed, with_rule

from .conftest import ODD_TEXTS

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_sql(spark, name):
    ok, what = same(queries.REGISTRY[name](spark, SF), connect(SF), queries.ORACLES[name])
    assert ok, what


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_groups_and_clashing_digests(documents):
    rows = [*enumerate(ODD_TEXTS), (50, "a\t b"), (20, "a b"), (30, "a  b"), (31, "é"), (31, "é"), (None, "é"), (None, "q")]
    docs = documents(rows, ", keep_id int, kept int", (1, 2))
    weak = lambda text: F.substring(F.sha2(text.cast("binary"), 256), 1, 1)
    for digest, full in ((None, True), (weak, False)):
        found = duplicate_groups(docs, digest) if digest else duplicate_groups(docs)
        groups = defaultdict(list)
        for i, t in rows:
            groups[normal(t)].append(i)
        want = []
        for i, t in rows:
            ids = groups[normal(t)]
            keep = min((k for k in ids if k is not None), default=None)
            sha = hashlib.sha256(normal(t).encode()).hexdigest()
            want.append((i, keep, len(ids), i == keep, sha if full else sha[0]))
        assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    kept = drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((normal(r["text"]) for r in kept.collect())) == sorted(groups)
    assert drop_duplicates(documents([])).count() == 0


def shared_out(sizes, weights):
    """Targets by sharing the excess again until none is above."""
    total = 1.5 * sum(sizes.values())
    full, goal = set(), {}
    while True:
        open_ = [s for s in sizes if s not in full]
        rest = total - sum(2 * sizes[s] for s in full)
        goal = {s: 2.0 * sizes[s] for s in full}
        goal |= {s: rest * weights[s] / sum(weights[o] for o in open_) for s in open_}
        above = {s for s in open_ if goal[s] > 2 * sizes[s]}
        if not above:
            return goal
        full |= above


def test_mix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = taken_words(docs).collect()
    again = taken_words(docs).collect()
    assert sorted(rows) == sorted(again) and len(rows) == docs.count()
    source = {r["doc_id"]: (r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in docs.collect()}
    sizes, taken, goal = defaultdict(int), defaultdict(int), {}
    for r in rows:
        name, size = source[r["doc_id"]]
        assert r["size"] == size and r["taken"] <= 2 * size
        sizes[name] += size
        taken[name] += r["taken"]
        goal[name] = r["target"]
    weights = dict(zip(sorted(sizes), (5, 2, 1) * len(sizes), strict=False))
    want = shared_out(sizes, weights)
    for s in sizes:
        assert goal[s] == pytest.approx(want[s])
        assert abs(taken[s] - goal[s]) <= max(2 * BLOCK, 0.02 * goal[s])


def test_mix_of_odd_rows(documents):
    rows = [*enumerate(ODD_TEXTS), (0, "a b"), (0, "a b"), (None, "c")]
    docs = documents(rows, ", size int, part int", (1, 2))
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 4 != 1, F.col("source")))
    out = taken_words(docs).collect()
    assert len(out) == len(rows) and all(0 <= r["taken"] <= 2 * r["size"] for r in out)
    assert taken_words(documents([])).count() == 0
    assert all(r["target"] == 0 for r in taken_words(documents([(1, ""), (2, None)])).collect())


def spark_hash(*values):
    """xxhash64 as Spark has it: each value is hashed with the hash before it as seed."""
    h = 42
    for value, width in values:
        if value is not None:
            raw = value.encode() if width is None else value.to_bytes(width, "little", signed=True)
            h = xxhash.xxh64_intdigest(raw, h)
    return h - (1 << 64) if h >> 63 else h


def place_of(x, size, *key):
    for r in range(1, mixing.ROUNDS + 1):
        partner = (spark_hash(*key, (r, 4)) - x) % size
        if spark_hash(*key, (r, 4), (max(x, partner), 8)) & 1:
            x = partner
    return x


def mixed_by_hand(docs):
    """{(doc_id, size): taken} by plain loops: pack, deal tickets to shards, number slots, count."""
    size, rows = defaultdict(int), defaultdict(list)
    for doc_id, source, text in docs:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        size[source] += n
        rows[source].append((doc_id, n))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    goal = shared_out(size, dict(zip(names, (5, 2, 1) * len(names), strict=False)))
    blocks, wanted = {}, {}
    for s in names:
        parts = math.ceil(size[s] / mixing.PART_WORDS)
        by_part = defaultdict(list)
        for doc_id, n in sorted(rows[s]):
            part = spark_hash((doc_id, 8)) % parts if parts else 0
            by_part[part] += [(doc_id, n)] * n
        blocks[s] = [
            by_part[p][i : i + BLOCK] for p in sorted(by_part) for i in range(0, len(by_part[p]), BLOCK)
        ]
        wanted[s] = math.floor(goal[s] * len(blocks[s]) / size[s] + 0.5) if size[s] else 0
    tickets = [s for s in names for _ in range(wanted[s])]
    shards = defaultdict(lambda: defaultdict(int))
    for i, s in enumerate(tickets):
        shards[place_of(i, len(tickets), (0, 4), ("shards", None)) // mixing.SHARD_SLOTS][s] += 1
    taken, next_slot = defaultdict(int), defaultdict(int)
    for shard in sorted(shards):
        for s, count in shards[shard].items():
            for slot in range(next_slot[s], next_slot[s] + count):
                n = len(blocks[s])
                at = place_of(slot % n, n, (0, 4), (s, None), (slot // n, 8))
                for doc in blocks[s][at]:
                    taken[doc] += 1
            next_slot[s] += count
    counts = {(shard, s): n for shard, of in shards.items() for s, n in of.items()}
    return {(d, n): taken[d, n] for s in names for d, n in rows[s]}, counts


@pytest.mark.parametrize(("part_words", "shard_slots", "shard_run"), [(1 << 20, 4096, 4096), (3000, 64, 3)])
def test_mix_by_hand(spark, monkeypatch, part_words, shard_slots, shard_run):
    monkeypatch.setattr(mixing, "PART_WORDS", part_words)
    monkeypatch.setattr(mixing, "SHARD_SLOTS", shard_slots)
    monkeypatch.setattr(mixing, "SHARD_RUN", shard_run)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 7 != 3, F.col("source")))
    want, counts = mixed_by_hand([(r["doc_id"], r["source"], r["text"]) for r in docs.collect()])
    got = {(r["doc_id"], r["size"]): r["taken"] for r in taken_words(docs).collect()}
    assert got == want
    _, mix = mix_plan(docs)
    drawn = {(r["shard"], r["source"]): r["count"] for r in mix.groupBy("shard", "source").count().collect()}
    assert drawn == counts


def test_taken_words_come_from_the_shards(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = taken_words(docs)._jdf.queryExecution().optimizedPlan().toString()
    # slots are numbered from the counts of the shards, read from their table
    scan = re.search(r"Relation \[source#\d+,source_blocks#\d+L?,shard#\d+L?,slots#\d+L?\] parquet", plan)
    assert scan and "RepartitionByExpression" in plan, plan


def test_slots_fill_shards_once_and_permutations_permute(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    _, mix = mix_plan(docs)
    rows = mix.collect()
    shards = defaultdict(list)
    for r in rows:
        shards[r["shard"]].append(r["place"])
    assert all(sorted(places) == list(range(len(places))) for places in shards.values())
    assert sum(len(places) == mixing.SHARD_SLOTS for places in shards.values()) >= len(shards) - 1
    assert len({(r["source"], r["slot"]) for r in rows}) == len(rows)
    for n in (1, 2, 7, 100):
        got = spark.range(n).select(permuted(F.col("id"), F.lit(n), F.lit(3)).alias("p")).collect()
        assert sorted(r["p"] for r in got) == list(range(n))


def test_targets_reach_caps(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 5)], "source string, size long")
    got = {r["source"]: r["target"] for r in targets(sizes).collect()}
    want = shared_out({"a": 10, "b": 1000, "c": 1000, None: 5}, {"a": 5, "b": 2, "c": 1, None: 5})
    assert got == pytest.approx(want)


def test_url_parts_and_rules(spark):
    urls = [
        ("HTTP://WWW.Example.COM/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/"),
        ("http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/"),
        ("http://xexample.com/en/", "xexample.com", "/en/", "com/"),
        ("x://net/es/1", "net", "/es/1", "net/es/"),
        ("x://a.net/fr", "a.net", "/fr", None),
        ("http://a.com", "a.com", "", None),
        ("http://a.com?x=/y", "a.com", "", None),
        ("a://b://c/d", "b:", "//c/d", None),
        ("no host", "", "", None),
        ("", "", "", None),
        (None, "", "", None),
    ]
    pages = spark.createDataFrame([(i, u[0]) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in with_rule(parsed(pages)).collect()}
    assert got == {i: u[1:] for i, u in enumerate(urls)}
    judged = judge_urls(pages.withColumns({"n": F.lit(1), "branch_": F.lit(2)}))
    assert judged.count() == len(urls)
    assert {r["verdict"] for r in judged.collect()} <= {"allow", "block"}
    assert judge_urls(pages.limit(0)).count() == 0


def test_templates_learn_from_labels(spark):
    rows = [f"http://h.org/bad/{w}" for w in ("a", "b")] * 20 + [f"http://h.org/good/{i}x" for i in range(30)]
    pages = spark.createDataFrame(list(enumerate([*rows, "http://h.org/bad/zzz"])), "page_id long, url string")
    rules = (("block", "h.org/bad/a"), ("block", "h.org/bad/b"), ("allow", "h.org/good/"))
    last = judge_urls(pages, rules).filter("rule IS NULL").collect()
    assert [r["verdict"] for r in last] == ["block"]


def test_branches_without_labels_are_allowed(spark):
    rows = [f"http://h.net/es/{i}" for i in range(50)]
    rows += [f"http://h.net/{w}/{i}" for w in ("en", "de") for i in range(20)] + ["http://h.net", "http://h.net/en"]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in judge_urls(pages).collect()}
    assert got == {i: "block" if "/es/" in u else "allow" for i, u in enumerate(rows)}


def test_few_labels_of_a_branch_count_against_its_host(spark):
    rows = [f"http://h.org/bad/{i}" for i in range(60)] + ["http://h.org/mixed/a1", "http://h.org/mixed/b1", "http://h.org/mixed/a2"]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    rules = (("block", "h.org/bad/"), ("allow", "h.org/mixed/a1"), ("block", "h.org/mixed/b"))
    last = judge_urls(pages, rules).filter("rule IS NULL").collect()
    assert [r["verdict"] for r in last] == ["allow"]


def test_columns_named_like_results_are_replaced(spark):
    pages = spark.createDataFrame([(1, "http://a.net/es/x", "r", 2, "h")], "page_id long, url string, rule string, branch int, host string")
    out = judge_urls(pages)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "template", "branch", "purity", "verdict"]
    assert [(r["host"], r["rule"], r["verdict"]) for r in out.collect()] == [("a.net", "net/es/", "block")]
    assert judge_urls(pages.limit(0)).count() == 0

"""The grouped prefix join against all pairs of sets."""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np

from tidepair.llm import ngram_join, queries
from tidepair.llm.components import components
from tidepair.llm.ngram_join import drop_near_duplicates, near_duplicates

from .conftest import ODD_TEXTS

A_TO_Z = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(A_TO_Z))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def expected(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {k: k for k in range(len(sets))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (x, (_, a)), (y, (_, b)) in combinations(enumerate(sets), 2):
        if a and b and 100 * min(len(a), len(b)) >= 80 * max(len(a), len(b)):
            common = len(a & b)
            if common and 100 * common >= 80 * (len(a) + len(b) - common):
                x, y = find(x), find(y)
                parent[max(x, y)] = min(x, y)
    groups = {}
    for k, (i, _) in enumerate(sets):
        groups.setdefault(find(k), []).append(i)
    least = {k: min((i for i in g if i is not None), default=None) for k, g in groups.items()}
    return sorted(((i, len(s), least[find(k)]) for k, (i, s) in enumerate(sets)), key=str)


def rows_of(df):
    return sorted(((r[0], r[1], r[2]) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows_of(queries.op10_ngram_join(spark, sf)) == expected(rows)


def test_chains_borders_and_odd_rows(documents, rng):
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows = []
    for i in range(60):  # a chain: each copy changes the one before it a little
        base = list(base)
        for _ in range(rng.choice((1, 1, 2))):
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
        rows.append((500 - i, " ".join(base)))
    same = [f"s{i}" for i in range(104)]  # 100 shingles
    rows.append((1000, " ".join(same)))
    rows.append((1001, " ".join(same[:84])))  # 80 of 100: linked
    rows.append((1002, " ".join(same[:83])))  # 79 of 100: not with the whole
    rows.append((1003, " ".join(same).upper().replace(" ", "\n\t")))
    rows += [(1100 + i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(1200, "one two"), (1201, "one  two"), (1202, "two one"), (1200, "one two"), (None, "one two")]
    assert rows_of(near_duplicates(documents(rows, ", k1 int, prefix int", (1, 2)))) == expected(rows)


def test_equal_prefixes_in_one_group(documents):
    # Fillers that are everywhere sort last, so a prefix holds the rare words only.
    common = [f"c{i} c{i} c{i} c{i} c{i}" for i in range(8)]
    rows = [(i, f"rare words of kind {i % 3} come first here then " + " ".join(common)) for i in range(40)]
    assert rows_of(near_duplicates(documents(rows))) == expected(rows)


def test_one_of_each_group_stays(documents):
    rows = [(3, "a b c d e f"), (1, "A b c d e f"), (2, "x y z"), (4, None), (5, "")]
    kept = drop_near_duplicates(documents(rows, ", component_id int", (9,)))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4, 5]
    assert kept.columns[-1] == "component_id"
    assert near_duplicates(documents([])).count() == 0


def test_components(spark, rng):
    nodes = list(range(200))
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(60)]
    edges += [(150, i) for i in range(151, 199)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    least = {n: n for n in nodes}
    for _ in nodes:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    assert {n: c for n, c in least.items() if n != c} == found


def alike_in_prefix_only():
    """Per kind two texts of equal size and prefix but other shingles, and for each a
    text that links with it only.  What is common sorts last: it is in many texts."""
    rows = []
    for kind in range(4):
        rare = " ".join(f"r{kind}x{i}" for i in range(44))
        for side, cut in ((0, 5), (1, 3)):
            often = [f"s{kind}x{i}" for i in range(4)] + [f"f{kind}x{side}x{i}" for i in range(70)]
            rows += [(len(rows), f"{rare} {' '.join(often)}"), (len(rows) + 1, f"{rare} {' '.join(often[:-cut])}")]
            rows += [(len(rows) + i, " ".join(often)) for i in range(60)]
    return rows


def test_members_that_are_not_shown_link(documents, monkeypatch):
    rows = alike_in_prefix_only()
    monkeypatch.setattr(ngram_join, "STAR_ROUNDS", 0)
    assert rows_of(near_duplicates(documents(rows))) == expected(rows)


def test_only_members_with_alike_bitmaps_are_read(documents, monkeypatch):
    pairs = []
    found = ngram_join.verified
    monkeypatch.setattr(ngram_join, "STAR_ROUNDS", 0)
    monkeypatch.setattr(ngram_join, "verified", lambda texts, p: pairs.append(p.count()) or found(texts, p))
    near_duplicates(documents(alike_in_prefix_only()))
    assert pairs == [8]  # the links: two per kind


def test_copies_go_before_texts_meet_their_keys(documents):
    docs = documents([(i, t) for i, t in enumerate(["a b c", "a b c", "d", "e"])])
    keys = ngram_join.keyed(docs).filter("doc_id IN (1, 2)").selectExpr("doc_id AS cls", "k1", "k2")
    assert sorted(map(tuple, ngram_join.texts_of(docs, keys).collect())) == [(1, "a b c"), (2, "d")]
    plan = ngram_join._matched(ngram_join.keyed(docs), keys)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")


def swapped(text, size):
    """``text`` followed by itself with a and b swapped, and so on: for two beginnings such
    words agree in every polynomial hash modulo a power of two."""
    while len(text) < size:
        text += text.translate({97: 98, 98: 97})
    return text


def test_words_made_to_clash_do_not_link(documents):
    one, two = swapped("a", 2048), swapped("b", 2048)
    rows = [(1, one), (2, two), (3, f"q w e r {one}"), (4, f"q w e r {two}"), (5, f"{one} " * 6), (6, f"{two} " * 6)]
    assert rows_of(near_duplicates(documents(rows))) == expected(rows)


def equal_hashes(chunk):
    """Sets whose hashes all clash."""
    for found in ngram_join.shingle_sets(chunk):
        yield np.arange(len(found), dtype=np.uint64)


def test_links_are_compared_by_words(documents):
    texts = documents([(1, "a b c d e f"), (2, "u v w x y z"), (3, "a b c d e  F")]).selectExpr("doc_id AS cls", "text")
    pairs = texts.sparkSession.createDataFrame([(1, 2), (1, 3)], "a long, b long")
    assert sorted(map(tuple, ngram_join.verified(texts, pairs, equal_hashes).collect())) == [(1, 3)]


def test_a_round_of_stars_costs_the_same_each_time(spark, documents, monkeypatch, rng):
    """Jobs of a round do not grow with the rounds before."""
    vocabulary = [f"w{i}" for i in range(300)]
    base = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(120):  # members that are mostly just below and above the bound
        words = list(base)
        for _ in range(rng.choice((1, 2))):
            words[rng.randrange(60)] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    docs = documents(rows)
    monkeypatch.setattr(ngram_join, "STAR_YIELD", -1)
    jobs = []
    found = ngram_join.star_pairs

    def watched(*args):
        jobs.append(0)
        spark.sparkContext.setJobGroup(f"round {len(jobs)}", "")
        return found(*args)

    monkeypatch.setattr(ngram_join, "star_pairs", watched)
    monkeypatch.setattr(ngram_join, "STAR_ROUNDS", 6)
    assert rows_of(near_duplicates(docs)) == expected(rows)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    counts = [len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"round {k}")) for k in range(2, 6)]
    assert 0 < max(counts) <= min(counts) + 12 and max(counts) <= 40

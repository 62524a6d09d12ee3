"""Nearest neighbours and BM25 search against brute force."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest_llm import SCHEMA, document, in_order, prose, sorted_rows
from pyspark.sql import functions as F

from shelfmark.llm import bm25, neighbours

VECTORS = "vec_id long, embedding array<double>, entry int, k1 string, block int, score int"


def brute_nearest(rows, asks, k):
    """All candidates in order of exact inner product, then id."""
    found = {}
    for i, v in rows.items():
        if asks(i):
            scores = [(-float(np.dot(v, w)), j) for j, w in rows.items() if j != i]
            found[i] = [(j, -s) for s, j in sorted(scores)][:k]
    return found


def check_neighbours(found, rows, asks, k, recall=0.9):
    by_query = {}
    for r in found.collect():
        by_query.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute_nearest(rows, asks, k)
    assert set(by_query) == {i for i in want if want[i]}
    hits = total = 0
    for query, answers in by_query.items():
        answers.sort()
        assert [a[0] for a in answers] == list(range(1, len(want[query]) + 1))
        assert len({a[1] for a in answers}) == len(answers) and query not in {a[1] for a in answers}
        for _, i, score in answers:
            assert score == pytest.approx(float(np.dot(rows[query], rows[i])), abs=1e-9)
        order = [(-round(s, 9), i) for _, i, s in answers]
        assert order == sorted(order)
        hits += len({a[1] for a in answers} & {i for i, _ in want[query]})
        total += len(want[query])
    assert hits >= recall * total
    return by_query


def numbers(spark, rows):
    plain = [(i, v if v is None else [x if x is None else float(x) for x in v]) for i, v in rows]
    return spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in plain], VECTORS)


def test_recall_on_the_test_tables(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in table.collect()}
    found = neighbours.op3_neighbours(spark, "/root/testdata/sf0.1")
    check_neighbours(found, rows, lambda i: i % 20 == 0, 20)


def test_lengths_matter_for_inner_products(spark):
    rng = np.random.default_rng(0)
    rows = {i: v * s for i, (v, s) in enumerate(zip(rng.normal(size=(600, 12)), rng.exponential(size=600), strict=True))}
    found = neighbours.nearest(numbers(spark, rows.items()), F.col("vec_id") % 10 == 0, k=5)
    check_neighbours(found, rows, lambda i: i % 10 == 0, 5)


def test_unusual_vectors(spark):
    rng = np.random.default_rng(1)
    rows = {i: rng.normal(size=3) for i in range(30)}
    rows |= {i: np.array([1.0, 2.0, 3.0]) for i in range(100, 200)}  # copies: ties by id
    odd = [
        (300, None),
        (301, []),
        (302, [0.0, 0.0, 0.0]),
        (303, [1.0, None, 2.0]),
        (304, [1.0, float("nan"), 2.0]),
        (305, [1.0, float("inf"), 2.0]),
        (306, [1.0, 2.0]),
        (None, [1.0, 2.0, 3.0]),
        (5, rows[5]),  # a repeated row
    ]
    found = neighbours.nearest(numbers(spark, [*rows.items(), *odd]), F.lit(True), k=4)
    got = check_neighbours(found, rows, lambda i: True, 4, recall=1.0)
    assert [a[1] for a in got[150]] == [100, 101, 102, 103] and [a[1] for a in got[101]] == [100, 102, 103, 104]


def test_fewer_candidates_than_wanted(spark):
    rows = {1: np.array([1.0, 0.0]), 2: np.array([0.5, 0.5]), 3: np.array([-1.0, 0.0])}
    found = neighbours.nearest(numbers(spark, rows.items()), F.lit(True), k=20)
    check_neighbours(found, rows, lambda i: True, 20, recall=1.0)
    alone = neighbours.nearest(numbers(spark, [(1, [1.0])]), F.lit(True))
    assert alone.count() == 0


def test_no_vectors(spark):
    for rows in ([], [(1, None)], [(1, [0.0])]):
        found = neighbours.nearest(numbers(spark, rows), F.lit(True))
        assert found.count() == 0 and found.columns == ["query_id", "rank", "vec_id", "score"]


def test_small_blocks_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = {i: rng.normal(size=6) for i in range(300)}
    rows |= {i: rows[0] + rng.normal(size=6) * 1e-9 for i in range(300, 400)}  # share all prefixes
    table = numbers(spark, rows.items())
    ask = F.col("vec_id") % 7 == 0
    want = sorted_rows(neighbours.nearest(table, ask, k=8), "query_id", "rank", "vec_id")
    monkeypatch.setattr(neighbours, "BLOCK", 20)
    assert sorted_rows(neighbours.nearest(table, ask, k=8), "query_id", "rank", "vec_id") == want
    # A few queries at a time for each block.
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 3)
    found = neighbours.nearest(table.repartition(40), ask, k=8)
    assert sorted_rows(found, "query_id", "rank", "vec_id") == want


def test_unequal_lengths(spark):
    # One vector of thrice the length must not blur the angles of all others, nor lengths of many sizes.
    rng = np.random.default_rng(8)
    table = rng.normal(size=(24_000, 64))
    table /= np.linalg.norm(table, axis=1, keepdims=True)
    for lengths in (np.where(np.arange(len(table)) == 0, 3.0, 1.0), np.exp(rng.normal(size=len(table)) / 2)):
        vectors = (table * lengths[:, None]).astype(np.float32)
        docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
        asked = range(0, len(vectors), 800)
        found = neighbours.nearest(docs, F.col("vec_id") % 800 == 0).select("query_id", "vec_id").collect()
        scores = vectors[asked].astype(np.float64) @ vectors.astype(np.float64).T
        scores[np.arange(len(asked)), asked] = -np.inf
        best = {(q, int(v)) for q, row in zip(asked, scores, strict=True) for v in np.argpartition(-row, 20)[:20]}
        assert len(best & set(map(tuple, found))) / len(best) > 0.95


def test_effort_and_ranges_follow_the_table():
    assert neighbours.wanted(51_282, 20) == neighbours.EFFORT * 51_282**neighbours.GROWTH
    assert neighbours.wanted(800_000, 20) > 1.5 * neighbours.EFFORT * 800_000**neighbours.GROWTH
    cut = neighbours._cut_lengths([(0, 1, 3.0), (4, 50_000, 1.0), *((i, 9_000, 0.5) for i in range(5, 12))])
    assert cut[:2] == [(0, 0, 1, 3.0), (4, 4, 50_000, 1.0)] and len(cut) == neighbours.RANGES
    assert cut[-1] == (8, 11, 36_000, 0.5)


def test_heights_go_up_until_there_is_enough():
    rng = np.random.default_rng(3)
    forest = neighbours.Forest(rng.normal(size=(9, neighbours.TREES * neighbours.BITS)), 3.0, 6)
    vectors = rng.normal(size=(400, 8))
    strings = forest.strings(vectors, False)
    counts = np.stack([np.bincount(strings[:, t] >> np.uint32(26), minlength=64) for t in range(neighbours.TREES)])
    forest.sums = np.concatenate([np.zeros((neighbours.TREES, 1), np.int64), np.cumsum(counts, axis=1)], axis=1)
    for wanted in (1, 300, 2000, 10**9):
        forest.wanted = wanted
        for string, height in zip(strings[:20], forest.heights(strings[:20]), strict=True):
            held = [
                sum((strings[:, t] >> np.uint32(32 - b) == string[t] >> np.uint32(32 - b)).sum() for t in range(neighbours.TREES))
                for b in range(1, 7)
            ]
            assert height == max([b for b, n in enumerate(held, 1) if n >= wanted], default=0)


# ---- BM25 ----


def brute_bm25(docs, asks, k):
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for _, t in docs]
    counts = [Counter(w) for w in words]
    n, mean = len(docs), sum(map(len, words)) / max(len(docs), 1)
    df = Counter(w for c in counts for w in c)
    found = {}
    for (query, _), asked in zip(docs, counts, strict=True):
        if query is None or not asks(query):
            continue
        scores = []
        for (i, _), c, w in zip(docs, counts, words, strict=True):
            score = sum(
                q * math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * len(w) / mean))
                for t, q in asked.items()
                if c[t]
            )
            if score > 0:
                scores.append((-round(score, 6), i is None, i or 0))
        found[query] = [(None if none else i, -s) for s, none, i in sorted(scores)[:k]]
    return found


def check_bm25(found, docs, asks, k):
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["doc_id"], round(r["score"], 5)))
        assert r["rank"] == len(got[r["query_id"]])
    want = {q: [(i, round(s, 5)) for i, s in a] for q, a in brute_bm25(docs, asks, k).items() if a}
    assert {q: [s for _, s in a] for q, a in got.items()} == {q: [s for _, s in a] for q, a in want.items()}
    assert {q: [i for i, _ in a] for q, a in got.items()} == {q: [i for i, _ in a] for q, a in want.items()}


def test_sql_gives_the_same(spark):
    found = bm25.op5_bm25(spark, "/root/testdata/sf0.01")
    duck = duckdb.connect()
    duck.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    result = duck.execute(bm25.ORACLE)
    names = [d[0] for d in result.description]
    assert sorted_rows(found, *names) == in_order(result.fetchall())


def test_unusual_documents(spark, unusual):
    # One row per id: a repeated id would ask with two texts.
    docs = unusual.dropDuplicates(["doc_id"]).cache()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check_bm25(bm25.top_k(docs, F.lit(True), k=5), rows, lambda i: True, 5)


def test_repeated_rows_are_found_as_often(spark):
    docs = spark.createDataFrame([document(1, "one word"), document(1, "one word"), document(2, "one")], SCHEMA)
    found = bm25.top_k(docs, F.col("doc_id") == 2).collect()
    assert sorted(r["doc_id"] for r in found) == [1, 1, 2]


@pytest.mark.parametrize("shard,block,terms", [(1 << 15, 64, 1 << 20), (17, 4, 1 << 20), (64, 2, 40)])
def test_shards_blocks_and_passes_change_nothing(spark, monkeypatch, shard, block, terms):
    monkeypatch.setattr(bm25, "SHARD_DOCS", shard)
    monkeypatch.setattr(bm25, "BLOCK", block)
    monkeypatch.setattr(bm25, "PASS_TERMS", terms)
    docs = [(i, prose(i, 5 + i % 60, [f"w{j * j % (40 + i % 7)}" for j in range(60)])) for i in range(300)]
    table = spark.createDataFrame([document(i, t) for i, t in docs], SCHEMA).repartition(3)
    check_bm25(bm25.top_k(table, F.col("doc_id") % 20 == 0, k=7), docs, lambda i: i % 20 == 0, 7)


@pytest.mark.parametrize("bounded", [0, 3, 1000])
def test_scores_are_exact_however_a_query_is_scored(spark, monkeypatch, bounded):
    """With rows of common terms in single precision and with bounds, or without; also for what shards before have found."""
    monkeypatch.setattr(bm25, "BOUNDED_TERMS", bounded)
    monkeypatch.setattr(bm25, "SHARD_DOCS", 40)
    monkeypatch.setattr(bm25, "BLOCK", 4)
    words = [f"w{j * j % 53}" for j in range(60)] + [f"r{j}" for j in range(400)]
    docs = [(i, prose(i % 250, 20 + i % 90, words)) for i in range(300)]  # some texts twice: equal scores
    table = spark.createDataFrame([document(i, t) for i, t in docs], SCHEMA).repartition(2)
    check_bm25(bm25.top_k(table, F.col("doc_id") % 10 == 0, k=7), docs, lambda i: i % 10 == 0, 7)


def test_many_terms_are_scored_at_once(monkeypatch):
    """Sums of many bounds skip nothing: such a query touches no runs, and gets what bounds would have given."""
    rng = np.random.default_rng(1)
    n, n_terms = 2000, 300
    doc, term = np.nonzero(rng.random((n, n_terms)) < 0.03)
    order = np.lexsort((doc, term))
    doc, term = doc[order], term[order]
    packed = bm25._packed
    row = {
        "lengths": packed(rng.integers(5, 400, n).astype("<u4")),
        "terms": packed(np.unique(term).astype("<u8")),
        "counts": packed(np.bincount(term).astype("<u4")),
        "docs": packed(doc.astype("<u2")),
        "times": packed(rng.integers(1, 5, len(doc)).astype("<u4")),
    }
    shard = bm25.Shard(row, 200.0)
    at, factors = np.arange(0, n_terms, 2), rng.random(n_terms // 2)
    touched, plain = [], shard._score
    shard._score = lambda runs, factors: touched.append(len(runs)) or plain(runs, factors)
    docs, scores = shard.best(at, factors, 5)
    assert not touched
    monkeypatch.setattr(bm25, "BOUNDED_TERMS", n_terms)
    other, same = shard.best(at, factors, 5)
    assert touched and sorted(zip(-scores, docs))[:5] == sorted(zip(-same, other))[:5]


def test_blocks_are_skipped():
    """A shard scores fewer postings than it has, and still finds the best."""
    rng = np.random.default_rng(0)
    n = 3000
    lengths = np.sort(rng.integers(5, 400, n))[::-1]
    doc, term = np.nonzero(rng.random((n, 30)) < 0.02)
    order = np.lexsort((doc, term))
    doc, term = doc[order], term[order]
    times = rng.integers(1, 5, len(doc))
    packed = bm25._packed
    row = {
        "lengths": packed(lengths.astype("<u4")),
        "terms": packed(np.unique(term).astype("<u8")),
        "counts": packed(np.bincount(term).astype("<u4")),
        "docs": packed(doc.astype("<u2")),
        "times": packed(times.astype("<u4")),
    }
    shard = bm25.Shard(row, float(lengths.mean()))
    touched = []
    plain = shard._score
    shard._score = lambda runs, factors: touched.append((shard.run_end[runs] - shard.run_start[runs]).sum()) or plain(runs, factors)
    at, factors = np.array([1, 4, 9]), np.array([2.0, 1.0, 3.0])
    docs, scores = shard.best(at, factors, 3)
    dense = np.zeros(n)
    for t, f in zip(at, factors, strict=True):
        dense[doc[term == t]] += f * shard.weights[term == t]
    best = np.argsort(-np.round(dense, 6), kind="stable")[:3]
    assert sorted(scores[np.argsort(-scores)[:3]]) == sorted(np.round(dense[best], 6))
    assert sum(touched) < 0.9 * sum((term == t).sum() for t in at)


def test_no_documents(nothing):
    assert bm25.top_k(nothing, F.lit(True)).count() == 0

"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import SCHEMA, document, prose
from pyspark.sql import functions as F

from shelfmark.llm import nra

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id int, text string, doc_id string, rank int, score string"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_ranked(docs, items, k=10):
    """Per item the scores and ids, best first."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n, total = len(counts), sum(size for _, _, size in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    asked = defaultdict(set)
    for i, text in items:
        asked[i] |= set(terms(text))
    found = {}
    for item, wanted in asked.items():
        scores = []
        for i, c, size in counts:
            m = 100 - 90 + 90 * size * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in wanted & set(c)
            )
            if score > 0:
                scores.append((-score, i is None, i if i is not None else 0))
        if scores:
            found[item] = [(None if null else i, -s) for s, null, i in sorted(scores)[:k]]
    return found


def check(docs, items, **options):
    got = defaultdict(list)
    for r in nra.ranked(docs, items, **options).collect():
        got[r["item_id"]].append((r["rank"], r["doc_id"], r["score"]))
    want = brute_ranked(
        [(r["doc_id"], r["text"]) for r in docs.collect()],
        [(r["item_id"], r["text"]) for r in items.collect()],
        options.get("k", 10),
    )
    assert {i: [(r, d, s) for r, d, s in sorted(a)] for i, a in got.items()} == {
        i: [(r, d, s) for r, (d, s) in enumerate(a, 1)] for i, a in want.items()
    }
    return want


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 3, "y") for i, t in rows], ITEMS)


def test_unusual_documents(spark, unusual):
    items = [(1, prose(2, 30)), (2, "Two words WORDS"), (3, None), (4, ""), (5, "., !"), (6, "漢字 かな ﬁ ▁"), (7, "nowhere")]
    items += [(8, "the tree"), (8, "river walk"), (None, "stone cloud"), (1, prose(2, 30)), (9, prose(1, 4000, [f"w{i}" for i in range(3000)]))]
    want = check(unusual, items_of(spark, items))
    assert None in want and 7 not in want and 3 not in want


def test_test_tables(spark, sample):
    check(sample, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))


@pytest.mark.parametrize("k", [1, 3, 40])
def test_ties_small_shards_and_passes(spark, monkeypatch, k):
    for name, value in {"SHARD_DOCS": 7, "FIRST_DEPTH": 1, "PASS_TERMS": 6, "PASS_ITEMS": 2}.items():
        monkeypatch.setattr(nra, name, value)
    # Many equal texts in falling order of ids: equal scores within and across shards.
    rows = [document(100 - i, prose(i % 5, 12, list("abcdef"))) for i in range(60)] + [document(41, "a b c")] * 2
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    check(docs, items_of(spark, [(i, prose(i, 3, list("abcdefg"))) for i in range(7)]), k=k)


def test_no_documents_no_items(spark, nothing, sample):
    assert nra.ranked(nothing, items_of(spark, [(1, "a")])).count() == 0
    assert nra.ranked(sample, items_of(spark, [])).count() == 0
    assert nra.ranked(sample.withColumn("text", F.lit(" ")), items_of(spark, [(1, "a")])).count() == 0


class Read(nra.Lists):
    """Lists made by hand, which count the postings read."""

    def __init__(self, lists, n):
        ordered = [sorted(entries.items(), key=lambda e: (-e[1], e[0])) for entries in lists]
        sizes = np.array([len(entries) for entries in ordered])
        self.n = n
        self.docs = np.array([d for entries in ordered for d, _ in entries], np.int64)
        self.gains = np.array([g for entries in ordered for _, g in entries], np.float64)
        self.end = np.cumsum(sizes)
        self.first = self.end - sizes


@pytest.mark.parametrize("seed", range(30))
def test_bounds_settle_the_best(monkeypatch, seed):
    monkeypatch.setattr(nra, "FIRST_DEPTH", 1)
    rng = random.Random(seed)
    n = rng.choice([1, 5, 40])
    lists = [{d: rng.randint(1, 4) for d in rng.sample(range(n), rng.randint(1, n))} for _ in range(rng.randint(1, 4))]
    rank = np.array(rng.sample(range(n), n))
    for k in (1, 2, 10):
        docs, scores = Read(lists, n).best(np.arange(len(lists)), rank, k)
        totals = Counter()
        for entries in lists:
            totals.update(entries)
        want = sorted(totals, key=lambda d: (-totals[d], rank[d]))[:k]
        assert docs.tolist() == want and scores.tolist() == [totals[d] for d in want]


def test_reading_stops_early(monkeypatch):
    monkeypatch.setattr(nra, "FIRST_DEPTH", 4)
    lists = Read([{d: 10**6 - d if d < 4 else 1 for d in range(4096)}], 4096)
    settled = []
    original = nra.Lists._settled
    monkeypatch.setattr(nra.Lists, "_settled", lambda self, *a: settled.append(original(self, *a)) or settled[-1])
    docs, _ = lists.best(np.array([0]), np.arange(4096), 3)
    assert docs.tolist() == [0, 1, 2] and settled == [True]

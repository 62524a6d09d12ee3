"""SimHash components and repeated passages against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest_llm import SCHEMA, document, in_order, prose, sorted_rows
from pyspark.sql import functions as F

from shelfmark.llm import simhash, substring
from shelfmark.llm.components import smallest_reachable

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(values, max_bits=2):
    """The smallest index that chains of links reach, per value."""
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= max_bits:
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return [find(i) for i in range(len(values))]


def brute_rows(rows):
    prints = [brute_fingerprint(r["text"]) for r in rows]
    ids = [r["doc_id"] for r in rows]
    roots = brute_components(prints)
    smallest = {}
    for i, root in zip(ids, roots, strict=True):
        if i is not None:
            smallest[root] = min(i, smallest.get(root, i))
    return [
        (i, f - (1 << 64) if f >> 63 else f, smallest.get(root))
        for i, f, root in zip(ids, prints, roots, strict=True)
    ]


def test_components_match_brute_force(unusual, sample):
    for docs in (unusual, sample):
        found = sorted_rows(simhash.components(docs), "doc_id", "fingerprint", "component_id")
        assert found == in_order(brute_rows(docs.collect()))


def test_no_documents(nothing):
    assert simhash.components(nothing).count() == 0
    assert simhash.keep_one(nothing).count() == 0


def test_one_document_of_each_group_stays(unusual):
    kept = simhash.keep_one(unusual)
    assert kept.columns == unusual.columns
    roots = Counter(brute_components([brute_fingerprint(r["text"]) for r in unusual.collect()]))
    assert kept.count() == len(roots)
    ids = {r["doc_id"] for r in kept.collect()}
    assert 0 in ids and 1 not in ids and 13 in ids  # the smaller id stays, one of two equal rows
    assert simhash.keep_one(kept).count() == kept.count()


def close_values(seed, n):
    """Values in clusters: chains, balls and strangers."""
    rng = random.Random(seed)
    found = set()
    while len(found) < n:
        value = rng.choice([0, (1 << 64) - 1, rng.getrandbits(64)])
        for _ in range(rng.choice([1, 5, 60])):
            found.add(value)
            for _ in range(rng.randint(1, 3)):
                value ^= 1 << rng.randrange(64)
            if rng.random() < 0.2:
                value ^= rng.getrandbits(64) & rng.getrandbits(64) & rng.getrandbits(64)
    return sorted(found)


@pytest.mark.parametrize("max_bits, paired_cell", [(0, 8), (1, 1), (2, 1), (2, 8), (2, 10**6), (3, 1)])
def test_links_join_what_brute_force_joins(spark, max_bits, paired_cell):
    values = close_values(max_bits, 250)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    # Small cells only, crowded cells only, and both give the same components.
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "f long"), max_bits, paired_cell)
    for a, b in links.collect():
        assert ((a ^ b) & ((1 << 64) - 1)).bit_count() <= max_bits
    roots = {r["node"]: r["root"] for r in smallest_reachable(links).collect()}
    groups = {}
    for v in signed:
        groups.setdefault(roots.get(v, v), set()).add(v)
    want = {}
    for v, root in zip(signed, brute_components(values, max_bits), strict=True):
        want.setdefault(root, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_popcounts_of_segments(spark):
    values = [0, -1, 1 << 62, -(1 << 63), 0x123456789ABCDEF]
    rows = spark.createDataFrame([(v,) for v in values], "f long").select("f", simhash.popcounts(F.col("f"))).collect()
    for value, packed in rows:
        for segment in range(16):
            assert packed >> 4 * segment & 15 == (value >> 4 * segment & 15).bit_count()


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, i) for i in range(1001, 1400)] + [(1399, 999)]
    loops = [(5000, 5000), (6000, 6001), (6001, 6000), (6000, 6001)]
    links = spark.createDataFrame(chain + star + loops, "a long, b long")
    roots = {r["node"]: r["root"] for r in smallest_reachable(links).collect()}
    assert roots == {
        **{i: 0 for i in range(301)},
        **{i: 999 for i in range(999, 1400)},
        6000: 6000,
        6001: 6000,
    }
    assert smallest_reachable(links.filter("a < 0")).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def planned(monkeypatch, module):
    """The plans, as first made, of what a module stages from now on."""
    plans = []
    for name in {"stage", "stage_at"} & set(vars(module)):
        def note(df, label, write=getattr(module, name)):
            plans.append(plan_of(df))
            return write(df, label)
        monkeypatch.setattr(module, name, note)
    return plans


def test_fingerprints_are_not_broadcast(sample, monkeypatch):
    """Few bytes of files become very many rows: no join may take a side whole."""
    plans = planned(monkeypatch, simhash)
    plans += [plan_of(simhash.components(sample)), plan_of(simhash.keep_one(sample))]
    linked = simhash.links(simhash.with_fingerprints(sample, name="f").select("f").distinct())
    joins = [kind for plan in [*plans, plan_of(linked)] for kind in re.findall(r"\w+Join", plan)]
    assert len(joins) == 12 and set(joins) == {"SortMergeJoin"}


def test_tasks_of_cells_follow_the_fingerprints(spark, monkeypatch):
    """Their number, not the session's setting or their few bytes, from which Spark would merge partitions."""
    monkeypatch.setattr(simhash, "DEALT", 10)
    values = [v - (1 << 64) if v >> 63 else v for v in close_values(2, 250)]
    cells = planned(monkeypatch, simhash)
    distinct = spark.createDataFrame([(v,) for v in values], "f long").distinct()
    linked = simhash.links(distinct)
    for plan in (*cells, linked._jdf.queryExecution().executedPlan().toString()):
        dealt = re.findall(r"hashpartitioning\(xxhash64\(f#\w+, 42\), (\d+)\)", plan)
        assert dealt and set(dealt) == {str(-(-len(values) // 10))}


# ---- repeated passages ----


def test_places_of_repeated_windows_are_not_broadcast(sample, monkeypatch):
    """Places take few bytes in files and many in memory."""
    plans = planned(monkeypatch, substring)
    cleaned = substring.remove_repeated(sample)
    plans.append(plan_of(cleaned))
    assert sum("SortMergeJoin" in plan for plan in plans) == 2
    assert not [plan for plan in plans if "Broadcast" in plan]


def brute_removal(texts, window=35):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    found = []
    for text, w in zip(texts, words, strict=True):
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = True
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        clean = text if text is None or not gone.any() else kept.decode()
        found.append((clean, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return found


def check_removal(docs, **options):
    rows = docs.collect()
    cleaned = substring.remove_repeated(docs, **options)
    name = "dedup_" if "dedup" in docs.columns else "dedup"
    got = cleaned.select("doc_id", "text", f"{name}.text", f"{name}.n_words", f"{name}.n_removed", f"{name}.kept_sha256")
    want = brute_removal([r["text"] for r in rows], options.get("window", 35))
    assert in_order(map(tuple, got.collect())) == in_order(
        (r["doc_id"], r["text"], *w) for r, w in zip(rows, want, strict=True)
    )
    return cleaned


def test_repeated_passages_match_brute_force(unusual, sample):
    assert check_removal(unusual).columns == [*unusual.columns, "dedup_"]
    check_removal(sample)


@pytest.mark.parametrize("cell_bits", [3, 6, 30])
def test_a_small_sketch_changes_nothing(unusual, monkeypatch, cell_bits):
    # With a few cells nearly all windows pass the sketch, and the exact pass has to tell them apart.
    monkeypatch.setattr(substring, "MIN_CELL_BITS", 3)
    check_removal(unusual, max_cell_bits=cell_bits)


@pytest.mark.parametrize("window", [1, 3, 35, 64])
def test_windows_of_any_length(spark, window):
    texts = [prose(seed, 90, ["a", "b", "c", "d", "e"]) for seed in range(6)]
    texts += [texts[0], texts[1] + " end", "a " * 80, prose(9, window), prose(9, window - 1)]
    docs = spark.createDataFrame([document(i, t) for i, t in enumerate(texts)], SCHEMA)
    check_removal(docs, window=window)


def test_removal_of_nothing(nothing):
    assert substring.remove_repeated(nothing).count() == 0


def test_hash_ranges_grow_with_the_texts(spark, monkeypatch):
    assert substring._ranges(30 << 30) > 50 * substring._ranges(512 << 20)
    # Many ranges, several tasks and copies give the same.
    monkeypatch.setattr(substring, "RANGE_BYTES", 500)
    texts = [prose(seed, 120) for seed in range(12)]
    texts += [texts[0], texts[1] + " end", texts[2] + " " + texts[2], texts[3][200:], None, ""]
    docs = spark.createDataFrame([document(i % 16, t) for i, t in enumerate(texts)] + [document(0, texts[0])] * 3, SCHEMA)
    check_removal(docs.repartition(3))


def test_shingles_of_other_lengths(spark):
    # Equal sets of single words, in other orders: the same only with shingles of one word.
    docs = spark.createDataFrame([document(1, "a b c d e f"), document(2, "f e d c b a")], SCHEMA)
    assert {r["component_id"] for r in simhash.components(docs, words_per_shingle=1).collect()} == {1}
    assert {r["component_id"] for r in simhash.components(docs).collect()} == {1, 2}
    assert simhash.keep_one(docs, words_per_shingle=1).count() == 1 and simhash.keep_one(docs).count() == 2

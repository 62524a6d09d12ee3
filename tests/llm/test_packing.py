"""Cutting stock, packed documents, and the pipeline."""

import itertools
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest_llm import SCHEMA, document, prose
from pyspark.sql import functions as F
from test_near_duplicates import brute_components, brute_fingerprint, brute_removal
from tokenizers import Tokenizer

import corpus_pipeline
from shelfmark.llm import cutting, mixing, packing
from shelfmark.llm.common import stage

BPE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(BPE)


def ids_of(text):
    return np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def padding(total, sequence):
    return 0 if total & (total - 1) == 0 else sequence - total


def check_pieces(pieces, docs, sequence=1024, most_padding=0.01):
    """Every document's ids lie in its pieces; sequences have no gaps and little padding."""
    rows = pieces.collect()
    texts = docs.collect()
    wanted = sorted((r["doc_id"] is None, r["doc_id"] or 0, len(ids_of(r["text"]))) for r in texts)
    by_id = {}
    for r in texts:
        by_id.setdefault(r["doc_id"], []).append(ids_of(r["text"]))
    for r in rows:
        part = slice(r["start"], r["start"] + r["length"])
        assert any(
            len(ids) == r["doc_tokens"] and zlib.crc32(ids[part].tobytes()) == r["ids_crc32"] for ids in by_id[r["doc_id"]]
        )
    # Each id of each document exactly once, repeated rows as often as they occur.
    covered = {}
    for r in rows:
        key = (r["doc_id"], r["doc_tokens"])
        covered.setdefault(key, []).extend(range(r["start"], r["start"] + r["length"]))
    copies = {}
    for none, i, n in wanted:
        key = (None if none else i, n)
        copies[key] = copies.get(key, 0) + 1
    assert {k: sorted(v) for k, v in covered.items()} == {
        (i, n): sorted(list(range(n)) * times) for (i, n), times in copies.items()
    }
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    padded, total = 0, 0
    for held in sequences.values():
        held.sort()
        ends = list(itertools.accumulate(n for _, n in held))
        assert [o for o, _ in held] == [0, *ends[:-1]] and ends[-1] <= sequence
        total += ends[-1]
        padded += padding(ends[-1], sequence)
    assert padded <= most_padding * max(total, 1) + 0
    return rows


def test_unusual_documents(unusual):
    check_pieces(packing.pack(unusual, BPE), unusual)


def test_documents_of_the_test_tables(spark, sample):
    rows = check_pieces(packing.op7_packing(spark, "/root/testdata/sf0.001"), sample)
    # Cuts other than at whole sequences are few.
    whole = sum(-(-len(ids_of(r["text"])) // 1024) for r in sample.collect())
    assert len(rows) <= whole * 1.15


@pytest.mark.parametrize("sequence", [1, 2, 7, 64])
def test_short_sequences(spark, sequence):
    docs = spark.createDataFrame([document(i, prose(i, i % 23)) for i in range(60)], SCHEMA)
    check_pieces(packing.pack(docs, BPE, sequence=sequence), docs, sequence, most_padding=0.02)


def test_equal_lengths(spark):
    docs = spark.createDataFrame([document(i, "same text here") for i in range(500)], SCHEMA).repartition(4)
    check_pieces(packing.pack(docs, BPE), docs)


def test_nothing(nothing):
    assert packing.pack(nothing, BPE).count() == 0


# ---- cutting stock ----


@pytest.mark.parametrize("pieces", [0, 1, 30, 1000, 30_000])
@pytest.mark.parametrize("kind", ["even", "short", "one length", "long"])
def test_patterns_meet_the_demand(pieces, kind):
    rng = np.random.default_rng(pieces)
    drawn = {
        "even": lambda: rng.integers(1, 1024, pieces),
        "short": lambda: np.minimum(1 + rng.geometric(0.02, pieces), 1023),
        "one length": lambda: np.full(pieces, 300),
        "long": lambda: rng.integers(520, 1024, pieces),
    }[kind]()
    lengths, demand = np.unique(drawn, return_counts=True)
    found, left = cutting.whole_patterns(lengths, demand, 1024)
    used = np.zeros(len(lengths), np.int64)
    for pattern, times in found:
        total = sum(int(lengths[i]) * k for i, k in pattern.items())
        assert times > 0 and (1014 <= total <= 1024 or total & (total - 1) == 0)
        for i, k in pattern.items():
            used[i] += k * times
    assert (left >= 0).all() and (used + left == demand).all()
    if kind in ("even", "short") and pieces >= 1000:
        assert (left * lengths).sum() < 0.2 * (demand * lengths).sum()


def test_the_linear_program_finds_the_optimum():
    # Lengths 3 and 5 in 8: as 3 + 5 without waste, though 3 + 3 and 5 alone come first.
    patterns, used = cutting.solve(np.array([3, 5]), np.array([100.0, 100.0]), 8)
    assert used.sum() == pytest.approx(100)
    # 6 of 10 can't share a sequence: each needs its own.
    _, used = cutting.solve(np.array([6]), np.array([50.0]), 10)
    assert used.sum() == pytest.approx(50)
    # Needs generated columns: the first ones don't know 2 + 2 + 3.
    _, used = cutting.solve(np.array([2, 3]), np.array([2000.0, 1000.0]), 7)
    assert used.sum() == pytest.approx(1000, rel=1e-3)


def test_prices_find_the_best_fill():
    lengths, prices = np.array([2, 3, 7]), np.array([0.2, 0.35, 0.7])
    worth, last = cutting._best_fills(lengths, prices, 10)
    for room in range(11):
        brute = max(
            a * 0.2 + b * 0.35 + c * 0.7 for a in range(6) for b in range(4) for c in range(2) if 2 * a + 3 * b + 7 * c <= room
        )
        assert worth[room] == pytest.approx(brute)


# ---- pipeline ----


def stages(spark, docs):
    found = [docs]
    for _, step in corpus_pipeline.STAGES:
        found.append(stage(step(spark, found[-1], "/nowhere"), "test"))
    return found


def check_pipeline(spark, docs, kept_languages):
    given, known, unique, clean, mixed, pieces = stages(spark, docs)
    for result in (known, unique, clean, mixed):
        assert result.columns == given.columns and [f.dataType for f in result.schema] == [f.dataType for f in given.schema]
    texts = [r["text"] for r in known.collect()]
    assert all(t is not None and any(c.isalpha() for c in t) for t in texts)
    assert known.count() >= kept_languages * given.count()
    roots = brute_components([brute_fingerprint(t) for t in texts])
    assert unique.count() == len(set(roots))
    before = {r["doc_id"]: r["text"] for r in unique.collect()}
    names = list(before)
    want = {i: w[0] for i, w in zip(names, brute_removal([before[i] for i in names]), strict=True)}
    if len(names) == unique.count():
        assert {r["doc_id"]: r["text"] for r in clean.collect()} == want
    for row in clean.collect():
        assert row["n_chars"] == len(row["text"])
    times = {}
    for row in mixing.mix(clean).collect():
        times[row["doc_id"]] = row["mix_" if "mix" in docs.columns else "mix"]["times"]
    for row in mixed.groupBy("doc_id").count().collect():
        assert row["count"] == times.get(row["doc_id"])
    check_pieces(pieces, mixed)


def test_pipeline_of_unusual_documents(spark, unusual):
    check_pipeline(spark, unusual, 0.5)


def test_pipeline_of_the_test_tables(spark, sample):
    check_pipeline(spark, sample, 1.0)
    # run() applies the same stages.
    result = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    want = stages(spark, sample)[-1]
    assert result.columns == want.columns
    key = ["doc_id", "doc_tokens"]
    assert result.groupBy(key).agg(F.sum("length")).exceptAll(want.groupBy(key).agg(F.sum("length"))).count() == 0


def test_pipeline_of_nothing(spark, nothing):
    assert [df.count() for df in stages(spark, nothing)] == [0] * 6


def test_pipeline_without_labels(spark):
    docs = [document(i, prose(i, 100), lang=None) for i in range(10)] + [document(99, "1 2 3", lang=None)]
    found = stages(spark, spark.createDataFrame(docs, SCHEMA))
    assert found[1].count() == 10


def test_best_fit_does_not_depend_on_the_number_of_pieces():
    lengths, share = np.array([1, 5, 90, 300, 700]), np.array([1, 1, 3, 2, 10])
    start = time.perf_counter()
    for scale in (1, 7, 1000, 10**9):
        fills = cutting._best_fit(lengths, share * scale, 1024)
        assert len(fills) < 60
        met = np.zeros(5, np.int64)
        for fill, times in fills:
            assert sum(int(lengths[i]) * k for i, k in fill.items()) <= 1024
            for i, k in fill.items():
                met[i] += k * times
        assert met.tolist() == (share * scale).tolist()
    found, left = cutting.whole_patterns(np.array([700]), np.array([2_000_000]), 1024)
    assert found == [] and left.tolist() == [2_000_000]
    # The stretch that is cut is known by arithmetic.
    places, stretch, _ = packing._plan({700: 2_000_000}, 0, 1024)
    assert stretch.whole == 700 * 2_000_000 // 1024 and sum(stretch.tail) == 700 * 2_000_000 % 1024
    assert time.perf_counter() - start < 5


@pytest.mark.parametrize("total", [1, 1023, 1024, 1025, 5000])
def test_cuts_of_a_stretch(total):
    whole, tail = divmod(total, 1024)
    stretch = packing._Stretch(1024, whole, [1 << b for b in reversed(range(11)) if tail >> b & 1])
    at, sizes = 0, []
    while at < total:
        number, start, end = stretch.cut(at)
        assert number == len(sizes) and start == at and stretch.cut(end - 1)[0] == number
        sizes.append(end - start)
        at = end
    assert sum(sizes) == total and all(s & (s - 1) == 0 for s in sizes)

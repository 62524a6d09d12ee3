"""Repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest_llm import SCHEMA, document, in_order, prose

from shelfmark.llm import repeats


def brute_spans(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    found = []
    for t in texts:
        spans = []
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        found.append([tuple(s) for s in spans])
    return found


def check(docs, **options):
    rows = docs.collect()
    texts = [(r["text"] or "").encode() for r in rows]
    want = []
    for r, t, spans in zip(rows, texts, brute_spans(texts, options.get("length", 200)), strict=True):
        edges = [0, *(e for s in spans for e in s), len(t)]
        kept = b"".join(t[s:e] for s, e in zip(edges[::2], edges[1::2]))
        lost = None if r["text"] is None else kept.hex()
        want.append((r["doc_id"], r["text"], lost, len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), spans))
    cleaned = repeats.remove_repeats(docs, **options)
    name = "dedup_" if "dedup" in docs.columns else "dedup"
    assert cleaned.columns == [*docs.columns, name]
    got = []
    for r in cleaned.collect():
        d = r[name]
        got.append(
            (r["doc_id"], r["text"], None if d["kept"] is None else bytes(d["kept"]).hex(), d["n_bytes"], d["n_removed"],
             d["n_spans"], d["kept_sha256"], [(s["start"], s["end"]) for s in d["spans"]])
        )
    assert in_order(got) == in_order(want)
    return got


def test_unusual_documents(unusual, sample):
    assert any(row[4] for row in check(unusual))
    check(sample)


def near_copies(seed, n, size, alphabet="abcd "):
    """Texts cut and pasted from a few, with edits."""
    rng = random.Random(seed)
    base = ["".join(rng.choices(alphabet, k=size)) for _ in range(3)]
    found = []
    for _ in range(n):
        text = rng.choice(base)
        for _ in range(rng.choice([0, 0, 1, 3])):
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(["", "x", "é", "漢", rng.choice(base)[: rng.randrange(size)]]) + text[at + rng.randrange(3) :]
        found.append(text)
    return found


@pytest.mark.parametrize("length", [1, 2, 7, 20, 90])
def test_lengths_small_chunks_and_ranges(spark, monkeypatch, length):
    for name, value in {"SLICE": 300, "CHUNK_ANCHORS": 40, "CHUNK_CONTEXTS": 2000, "RANGE_BYTES": 3000, "RANGE_CONTEXTS": 50}.items():
        monkeypatch.setattr(repeats, name, value)
    texts = near_copies(length, 14, 250) + ["a" * 400, "ab" * 300, "b" * 10, "", None]
    rows = [document(i % 15, t) for i, t in enumerate(texts)] + [document(0, texts[0])] * 3
    check(spark.createDataFrame(rows, SCHEMA).repartition(3), length=length)


def test_nothing(spark, nothing):
    assert repeats.remove_repeats(nothing).count() == 0
    assert repeats.repeats(nothing).count() == 0


def contexts_of(texts, length):
    """All contexts, sorted, with their occurrences."""
    found = {}
    for number, text in enumerate(texts):
        _, places, before, _ = repeats.anchors_of([text], length)
        for place, left in zip(places.tolist(), before.tolist(), strict=True):
            found.setdefault((text[place : place + length], text[place - left : place][::-1]), []).append((number, place))
    return sorted(found), found


@pytest.mark.parametrize("seed", range(60))
def test_intervals_find_what_brute_force_finds(seed, monkeypatch):
    rng = random.Random(seed)
    length = rng.choice([1, 3, 6, 12, 30])
    monkeypatch.setattr(repeats, "SLICE", rng.choice([37, 1 << 20]))
    texts = [t.encode() for t in near_copies(seed, rng.randint(1, 12), rng.choice([20, 100]), rng.choice(["a", "ab", "abcdefgh"]))]
    contexts, found = contexts_of(texts, length)
    for listing in (False, True):
        tree = repeats.Intervals(contexts, [len(found[c]) for c in contexts], length, listing)
        spans = [([], []) for _ in texts]
        if listing:
            for members, left, right in tree.groups:
                shared = {contexts[i][1][:left][::-1] + contexts[i][0][:right] for i in members}
                assert len(shared) == 1 and len(shared.pop()) >= length
                for i in members:
                    for number, place in found[contexts[i]]:
                        spans[number][0].append(place - left)
                        spans[number][1].append(place + right)
        else:
            for i, context in enumerate(contexts):
                for number, place in found[context] if tree.right[i] else ():
                    spans[number][0].append(place - tree.left[i])
                    spans[number][1].append(place + tree.right[i])
        for (starts, ends), want in zip(spans, brute_spans(texts, length), strict=True):
            got = repeats.merged_spans(np.array(starts), np.array(ends)) if starts else ([], [])
            assert list(zip(*map(list, got), strict=True)) == want


def test_every_window_has_its_anchor():
    rng = random.Random(4)
    for length in (1, 5, 50):
        texts = ["".join(rng.choices("ab", k=rng.randrange(200))).encode() for _ in range(30)]
        counts, places, before, hashes = repeats.anchors_of(texts, length)
        one_by_one = [repeats.anchors_of([t], length) for t in texts]
        assert counts.tolist() == [c[0] for c, *_ in one_by_one]
        for column, name in ((places, 1), (before, 2), (hashes, 3)):
            assert column.tolist() == [v for found in one_by_one for v in found[name].tolist()]
        covered = sum((np.array(before) + 1).tolist())
        assert covered >= sum(max(0, len(t) - length + 1) for t in texts)


def test_all_occurrences_are_listed(spark):
    passage = prose(1, 60)
    texts = ["start " + passage + " one", "other beginning " + passage, passage + " end", prose(2, 80), passage + " end"]
    docs = spark.createDataFrame([document(i, t) for i, t in enumerate(texts)], SCHEMA)
    groups = {}
    for r in repeats.repeats(docs, length=100).collect():
        groups.setdefault((r["group"], r["length"]), set()).add((r["doc_id"], r["start"]))
    everywhere = [g for g in groups.values() if {d for d, _ in g} == {0, 1, 2, 4}]
    assert everywhere
    for (_, size), members in groups.items():
        strings = {texts[d].encode()[s : s + size] for d, s in members}
        assert len(strings) == 1 and size >= 100
        string = strings.pop()
        assert len(members) == sum(t.encode().startswith(string, i) for t in texts for i in range(len(t)))

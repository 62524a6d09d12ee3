"""Phrases and Misra-Gries summaries against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest_llm import SCHEMA, document, prose

from shelfmark.llm import phrases


def brute_counts(rows, max_words):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    return counts, totals


def brute_collocations(rows, threshold, max_words, inside, top):
    counts, totals = brute_counts(rows, max_words)
    long = {key: f for key, f in counts.items() if len(key[1]) > 1 and f >= threshold}
    within = Counter()
    for (lang, words), f in long.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                key = lang, words[i : i + size]
                within[key] = max(within[key], f)
    found = {}
    for (lang, words), a in long.items():
        if within[lang, words] and 100 * within[lang, words] >= inside * a:
            continue
        scores = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            scores.append((10**6 * a * a // (left * right), k, left, right))
        score, _, left, right = min(scores)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    rows = []
    for lang, best in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(rows)


def check(docs, threshold=2, max_words=3, inside=50, top=2000):
    found = phrases.collocations(docs, threshold=threshold, max_words=max_words, inside=inside, top=top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    want = brute_collocations(rows, threshold, max_words, inside, top)
    assert sorted(map(tuple, found.collect())) == want
    return want


def test_unusual_documents(unusual):
    want = check(unusual)
    assert {row[0] for row in want} >= {"en", "de", "und"}
    check(unusual, threshold=10, top=7)


def test_test_tables(sample):
    check(sample, threshold=10)


@pytest.mark.parametrize("max_words, inside", [(2, 50), (4, 100), (5, 1)])
def test_many_chunks_and_ranges(spark, monkeypatch, max_words, inside):
    monkeypatch.setattr(phrases, "CHUNK_WORDS", 60)
    monkeypatch.setattr(phrases, "RANGE_MASS", 40)
    some = ["a", "B", "c", "D.", "é", "f,", "g\x0bh", "　", "i\tj", "k!", ";"]
    rows = [document(i, prose(i, 40, some), lang=random.Random(i).choice(["x", "y", None, "und", ""])) for i in range(60)]
    rows += [rows[0]] * 20  # a hot group of copies
    check(spark.createDataFrame(rows, SCHEMA).repartition(4), max_words=max_words, inside=inside)


def test_nothing(spark, nothing):
    assert phrases.collocations(nothing).count() == 0
    blank = spark.createDataFrame([document(1, " \t"), document(2, None), document(3, "...")], SCHEMA)
    assert phrases.collocations(blank, threshold=1).count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_summaries_keep_what_is_frequent(seed):
    rng = random.Random(seed)
    threshold = rng.choice([2, 5, 10])
    parts = []
    for _ in range(rng.randint(1, 30)):
        some = Counter(rng.choice([rng.randrange(12), rng.randrange(2000)]) for _ in range(rng.randint(1, 80)))
        keys = np.array(sorted(some), np.uint64)
        parts.append((keys, np.array([some[int(k)] for k in keys], np.int64)))
    exact = Counter()
    for keys, counts in parts:
        for key, count in zip(keys.tolist(), counts.tolist(), strict=True):
            exact[key] += count
    capacity = sum(exact.values()) // threshold + 1
    keys, counts, lost = phrases.merge(iter(parts), capacity)
    held = dict(zip(keys.tolist(), counts.tolist(), strict=True))
    assert len(held) <= capacity and lost < threshold
    for key, f in exact.items():
        assert f - lost <= held.get(key, 0) <= f
        if f >= threshold:
            assert key in held


def test_many_words_of_many_languages_in_a_chunk(spark):
    rows = [document(i, " ".join(f"w{j % 50}" for j in range(i, i + 30)), lang=f"l{i % 7}") for i in range(70)]
    check(spark.createDataFrame(rows, SCHEMA).coalesce(1), threshold=5)

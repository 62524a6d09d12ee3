"""Language identification and the language model: held-out accuracy, probabilities, unusual input."""

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import SCHEMA, document, in_order, prose
from pyspark.sql import functions as F

from shelfmark.llm import langid, language_model
from shelfmark.llm import language_model as lm

# ---- language identification ----


def test_held_out_accuracy(spark):
    found = langid.op10_langid(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").collect()
    assert {r["held_out"] for r in rows} == {True, False}
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1
    unseen = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in unseen) >= 0.98 * len(unseen)


def test_texts_without_letters_are_unknown(unusual):
    model = langid.fit(unusual)
    found = langid.identify(unusual, model)
    assert found.columns == [*unusual.columns, "language_"]
    for row in found.collect():
        text, result = row["text"], row["language_"]
        if text is None or not any(c.isalpha() for c in text):
            assert (result["lang"], result["score"], result["ambiguous"]) == ("und", 0.0, False)
        else:
            assert result["lang"] in model.languages
    assert found.count() == unusual.count()


def test_only_the_text_is_looked_at(spark, sample):
    model = langid.fit(sample)
    text = sample.first()["text"]
    docs = spark.createDataFrame([document(i, text, lang, str(i)) for i, lang in enumerate(["en", "xx", None])], SCHEMA)
    assert len({tuple(r["language_"]) for r in langid.identify(docs, model).collect()}) == 1


def test_no_labelled_documents(spark, nothing, unusual):
    assert langid.fit(nothing) is None
    assert langid.fit(unusual.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r["language_"]["lang"] for r in langid.identify(unusual, None).collect()} == {"und"}
    assert langid.identify(nothing, None).count() == 0


def test_one_language(spark):
    docs = spark.createDataFrame([document(i, prose(i, 30)) for i in range(5)], SCHEMA)
    found = langid.identify(docs, langid.fit(docs)).collect()
    assert {(r["language_"]["lang"], r["language_"]["score"], r["language_"]["ambiguous"]) for r in found} == {
        ("en", 1.0, False)
    }


@pytest.mark.parametrize("languages", [1, 2, 3, 4, 5, 6, 20, 60])
def test_codewords_differ(languages):
    code = langid.codewords(languages)
    assert len({tuple(row) for row in code.tolist()}) == languages
    assert (np.abs(code.sum(axis=0)) < languages).all()  # every bit splits the languages
    if languages > 2:
        apart = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
        assert min(apart) >= max(2, 0.2 * code.shape[1])  # errors of single bits can be corrected


def test_a_wrong_bit_is_corrected():
    code = langid.codewords(5)
    model = langid.LanguageModel(list("abcde"), code, np.eye(code.shape[1], dtype=np.float32), np.zeros(code.shape[1]))
    for number, word in enumerate(code):
        for bit in range(len(word)):
            margins = 4 * word.copy()
            margins[bit] *= -1
            best, _, lead = model.decode(margins[None, :])
            assert best[0] == number and lead[0] > langid.LEAD


def test_ties_are_ambiguous():
    code = langid.codewords(4)
    model = langid.LanguageModel(list("abcd"), code, np.eye(code.shape[1], dtype=np.float32), np.zeros(code.shape[1]))
    _, score, lead = model.decode(np.zeros((1, code.shape[1])))
    assert lead[0] == pytest.approx(0) and score[0] == pytest.approx(0.25)


def test_more_than_five_languages(spark):
    syllables = {f"l{i}": [a + b for a in "bdgkmnpt"[i:] + "bdgkmnpt"[:i] for b in "aeiou"[i % 5]] for i in range(7)}
    docs = [
        document(100 * i + j, prose(100 * i + j, 30, [x + y for x in words for y in words[:3]]), lang)
        for i, (lang, words) in enumerate(syllables.items())
        for j in range(20)
    ]
    table = spark.createDataFrame(docs, SCHEMA)
    model = langid.fit(table.filter("doc_id % 4 <> 0"))
    tested = langid.identify(table.filter("doc_id % 4 = 0"), model).collect()
    assert sum(r["language_"]["lang"] == r["lang"] for r in tested) >= 0.9 * len(tested)


# ---- language model ----


def held_out(rows):
    return [r is not None and zlib.crc32(str(r).encode()) % 7 == 2 for r in rows]


def out_of_training():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def brute_counts(docs):
    rows = docs.collect()
    split = [lm.words_and_end((r["text"] or "").encode()) for r in rows]
    out = held_out([r["doc_id"] for r in rows])
    counts = Counter(w for words, o in zip(split, out, strict=True) if not o for w in words)
    return rows, split, out, counts


@pytest.mark.parametrize("head", [1 << 19, 400])
def test_base_scores_match_brute_force(unusual, sample, head):
    for docs in (unusual, sample):
        rows, split, out, counts = brute_counts(docs)
        total, distinct = sum(counts.values()), len(counts)
        want = [
            (
                r["doc_id"],
                o,
                len(words),
                sum(counts[w] > 0 for w in words),
                total,
                round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words), 6),
            )
            for r, words, o in zip(rows, split, out, strict=True)
        ]
        found = language_model.score(docs, out_of_training(), head=head)
        got = found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score").collect()
        assert in_order((*r[:5], round(r[5], 6)) for r in map(tuple, got)) == in_order(want)


def test_the_head_is_only_a_plan(sample):
    many, few = (language_model.score(sample, out_of_training(), head=h).orderBy("doc_id").collect() for h in (1 << 19, 600))
    for a, b in zip(many, few, strict=True):
        assert a["score"] == pytest.approx(b["score"], abs=1e-4 * abs(a["score"]))


def test_the_model_beats_the_base_on_held_out_texts(spark):
    rows = language_model.op4_language_model(spark, "/root/testdata/sf0.01").filter("held_out").collect()
    assert sum(r["score"] for r in rows) > 0.9 * sum(r["base_score"] for r in rows)
    assert sum(r["score"] > r["base_score"] for r in rows) > 0.9 * len(rows)


def test_probabilities_add_up_to_one(spark, sample):
    training = sample.select(F.col("text").cast("binary").alias("t")).limit(60)
    table = lm.stage(lm.token_counts(training, lm.words_and_end), "words")
    counts = lm._gather(table, lm.head_from(table))
    scorer = lm.Scorer(lm.train(training, counts), counts.class_totals)
    rng = np.random.default_rng(0)
    classes = np.array([lm.ending_class(w) if i > lm.COMMON else counts.classes[i] for w, i in counts.head.items()])
    assert (classes == counts.classes).all()
    for _ in range(5):
        near, far = rng.integers(0, lm.CLASSES + 1, 2)
        every = np.arange(lm.CLASSES)
        likely = 10 ** scorer.log10(np.full(lm.CLASSES, near), np.full(lm.CLASSES, far), every)
        assert likely.sum() == pytest.approx(1, abs=1e-5)
        words = likely[counts.classes] * counts.counts / counts.class_totals[counts.classes] * (1 - counts.unseen)
        assert words.sum() + counts.unseen == pytest.approx(1, abs=1e-5)


def test_training_lowers_the_loss(spark):
    rng = np.random.default_rng(3)
    classes = np.array([1 + (i % 5) for i in range(40_000)])
    noise = rng.random(len(classes)) < 0.1
    classes[noise] = rng.integers(1, 6, noise.sum())
    totals = np.bincount(classes, minlength=lm.CLASSES).astype(float)
    near, far = lm._contexts(classes, np.array([0, len(classes)]))
    start = lm.Weights.start(totals)
    trainer = lm.Trainer(start, totals, 0)
    for i in range(0, len(classes), 512):
        trainer.step(near[i : i + 512], far[i : i + 512], classes[i : i + 512])
    before = lm.Scorer(start, totals).log10(near, far, classes).mean()
    assert lm.Scorer(trainer.w, totals).log10(near, far, classes).mean() > before + 0.2


def test_no_training_texts(spark, unusual, nothing):
    assert language_model.score(nothing, out_of_training()).count() == 0
    found = language_model.score(unusual, F.lit(True)).collect()
    for row in found:
        assert row["train_tokens"] == 0 and row["n_known"] == 0 and row["held_out"]
        assert row["base_score"] == pytest.approx(0)  # N and V are 0: the unknown word has all the probability
        assert math.isfinite(row["score"])


def test_scores_do_not_depend_on_the_split(sample, monkeypatch):
    monkeypatch.setattr(language_model, "SHARD_TOKENS", 9000)
    held_out = F.col("doc_id") % 4 == 1
    found = []
    for parts in (1, 7):
        rows = language_model.score(sample.repartition(parts), held_out).select("doc_id", "score", "held_out").collect()
        found.append({r["doc_id"]: r["score"] for r in rows})
    assert found[0].keys() == found[1].keys()
    for doc_id, score in found[0].items():
        assert found[1][doc_id] == pytest.approx(score, rel=1e-4)


def brute_features(text):
    """Square roots of hashed counts, gram by gram."""
    plain = "".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower())
    raw = (" " + " ".join(plain.encode().decode().split(" ")) + " ").encode()
    raw = b" " + b" ".join(raw.split()) + b" "
    counts = Counter()
    for i in range(len(raw) - 1 if len(raw) > 2 else 0):
        two = raw[i] * 257 + raw[i + 1]
        grams = [two] + ([two * 263 + raw[i + 2] + (1 << 24)] if i + 2 < len(raw) else [])
        for gram in grams:
            counts[(gram * 2654435761 % 2**32) >> 19] += 1
    norm = math.sqrt(sum(counts.values()))
    return {slot: math.sqrt(n) / norm for slot, n in counts.items()}


def test_languages_match_brute_force(unusual, sample):
    model = langid.fit(sample)
    for docs in (unusual, sample):
        name = "language_" if "language" in docs.columns else "language"
        for row in langid.identify(docs, model).collect():
            text, found = row["text"], row[name]
            if text is None or not any(c.isalpha() for c in text):
                assert found["lang"] == "und"
                continue
            losses = []
            held = brute_features(text)
            for codeword in model.code:
                loss = 0.0
                for bit, sign in enumerate(codeword):
                    margin = sum(v * float(model.weights[slot, bit]) for slot, v in held.items()) + float(model.offsets[bit])
                    loss += math.log1p(math.exp(-sign * margin))
                losses.append(loss)
            likely = [math.exp(min(losses) - loss) for loss in losses]
            shares = sorted((x / sum(likely) for x in likely), reverse=True)
            assert found["score"] == pytest.approx(shares[0], abs=1e-3)
            if shares[0] - shares[1] > 1e-3:
                assert found["lang"] == model.languages[losses.index(min(losses))]
                assert found["ambiguous"] == (shares[0] - shares[1] < langid.LEAD) or abs(shares[0] - shares[1] - langid.LEAD) < 1e-3


def test_scores_match_brute_force(unusual, sample):
    for docs in (unusual, sample.limit(80)):
        docs = docs.cache()
        rows, split, out, seen = brute_counts(docs)
        training = docs.filter(~F.coalesce(out_of_training(), F.lit(False))).select(
            F.col("text").cast("binary").alias("t"), F.xxhash64("doc_id", F.col("text").cast("binary")).alias("h"))
        table = lm.stage(lm.token_counts(training.select("t"), lm.words_and_end), "words")
        counts = lm._gather(table, lm.head_from(table))
        w = lm.train(training, counts)
        known = {t: int(counts.classes[i]) for t, i in counts.head.items()}
        want = {}
        for row, tokens in zip(rows, split, strict=True):
            total, before = 0.0, [lm.CLASSES, lm.CLASSES]
            for token in tokens:
                token = token if isinstance(token, bytes) else token.encode()
                group = known.get(token, lm.ending_class(token))
                if group < 0:
                    group = lm.ending_class(token)
                predicted = w.context[before[0]] @ w.near + w.context[before[1]] @ w.far
                scores = w.target @ predicted + w.offset
                scores = np.where(counts.class_totals > 0, scores, -1e9).astype(np.float64)
                top = scores.max()
                likely = (scores[group] - top - math.log(np.exp(scores - top).sum())) / math.log(10)
                n = seen[token if token in seen else token.decode()]
                if n:
                    total += likely + math.log10(n / counts.class_totals[group]) + math.log10(1 - counts.unseen)
                else:
                    total += math.log10(counts.unseen)
                before = [group, before[0]]
            want.setdefault(row["doc_id"], []).append(total)
        got = {}
        for r in language_model.score(docs, out_of_training()).collect():
            got.setdefault(r["doc_id"], []).append(r["score"])
        assert got.keys() == want.keys()
        for key, values in want.items():
            assert sorted(got[key]) == pytest.approx(sorted(values), rel=2e-4, abs=2e-3)


def test_classes_of_a_chunk_do_not_copy_all_words():
    """A worker holds up to a million words; the classes of a few tokens must not cost as much as all of them."""
    head = {language_model.END: 0, b"the": 1}
    counts = language_model.Counts(head, np.ones(2), np.array([0, 1]), np.ones(language_model.CLASSES), 2, 2, 0.1)
    codes = language_model._Codes(counts)
    codes.of([b" ".join(b"w%d" % i for i in range(200_000))])
    found, starts = codes.of([b"The w7 new", b""])
    tracemalloc.start()
    classes = codes.classes(found)
    assert tracemalloc.get_traced_memory()[1] < 100_000
    tracemalloc.stop()
    ending = language_model.ending_class
    assert starts.tolist() == [0, 4, 5] and classes.tolist() == [1, ending(b"w7"), ending(b"new"), 0, 0]

"""Language identification by error-correcting output codes.

Every language has a codeword of bits. One linear classifier per bit, over hashed byte n-grams, predicts whether
a text's language has that bit set. A text gets the language whose codeword fits all the classifiers' margins
with the least logistic loss; a close second makes it ambiguous.

The classifiers are fitted on a bounded sample of labelled texts, MAX_ROWS rows at most. Prediction reads every
text whole, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfmark.llm.common import as_row, chunks, free_name, from_row, in_small_batches, read_table, texts_in, worker_memory

#: Hashed features of a text.
FEATURES = 1 << 13
#: The bound of the sample that the classifiers are fitted on: rows of each language, and of all.
ROWS_PER_LANGUAGE = 400
MAX_ROWS = 2048
#: Below this lead in probability over the second language a text is ambiguous.
LEAD = 0.02
UNKNOWN = "und"

#: Bytes that are no letters in ASCII become blanks.
_TO_BLANK = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def _has_letter(text: str) -> bool:
    # The pattern also finds numerals such as U+00B2, which are no letters.
    return any(found[0].isalpha() for found in _LETTER.finditer(text))


def features(texts: list[bytes]) -> np.ndarray:
    """Unit vectors of square roots of hashed bigram and trigram counts, one row a text."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for number, text in enumerate(texts):
        text = b" " + b" ".join(text.decode("utf-8").lower().encode().translate(_TO_BLANK).split()) + b" "
        code = np.frombuffer(text, np.uint8).astype(np.uint32)
        if len(code) < 3:
            continue
        two = code[:-1] * np.uint32(257) + code[1:]
        three = two[:-1] * np.uint32(263) + code[2:] + np.uint32(1 << 24)
        for grams in (two, three):
            mixed = (grams * np.uint32(2654435761)) >> np.uint32(32 - 13)
            out[number] += np.bincount(mixed, minlength=FEATURES)
        np.sqrt(out[number], out=out[number])
        out[number] /= np.linalg.norm(out[number]) or 1
    return out


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """A row of -1 and +1 per language. Up to five languages: all ways to split them; more: the best random code."""
    if languages <= 5:
        splits = range(1, 1 << max(0, languages - 1))
        return np.array([[1 if s >> c & 1 else -1 for s in splits] for c in range(languages)], np.float32).reshape(
            languages, len(splits)
        )
    rng, best, widest = np.random.default_rng(seed), None, -1
    bits = min(63, int(np.ceil(10 * np.log2(languages))))
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.float32), (languages, bits))
        apart = (bits - (code @ code.T)) / 2 + np.eye(languages) * bits
        if apart.min() > widest and (np.abs(code.sum(axis=0)) < languages).all():
            best, widest = code, apart.min()
    return best


@dataclass
class LanguageModel:
    """Languages, their codewords, and a weight vector and offset per bit."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray

    def decode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row of features: language index, its probability, its lead over the second."""
        margins = rows @ self.weights + self.offsets
        losses = np.logaddexp(0, -margins[:, None, :] * self.code[None, :, :]).sum(axis=2)
        likely = np.exp(losses.min(axis=1, keepdims=True) - losses)
        likely /= likely.sum(axis=1, keepdims=True)
        best = likely.argmax(axis=1)
        ordered = np.sort(likely, axis=1)
        second = ordered[:, -2] if likely.shape[1] > 1 else 0.0
        return best, ordered[:, -1].astype(np.float64), (ordered[:, -1] - second).astype(np.float64)


def _fit(rows: np.ndarray, labels: np.ndarray, languages: list[str], rounds: int = 150) -> LanguageModel:
    """All bits at once: logistic regression by gradient descent with momentum; languages weigh the same."""
    code = codewords(len(languages))
    target = code[labels]
    share = np.bincount(labels, minlength=len(languages))
    weight = (1.0 / (share[labels] * len(languages)))[:, None].astype(np.float32)
    w = np.zeros((rows.shape[1], code.shape[1]), np.float32)
    b = np.zeros(code.shape[1], np.float32)
    step_w, step_b = np.zeros_like(w), np.zeros_like(b)
    for _ in range(rounds if code.shape[1] else 0):
        slope = -target * weight / (1 + np.exp(np.clip(target * (rows @ w + b), -30, 30)))
        step_w = 0.9 * step_w - 8.0 * (rows.T @ slope + 1e-5 * w)
        step_b = 0.9 * step_b - 1.0 * slope.sum(axis=0)
        w += step_w
        b += step_b
    return LanguageModel(languages, code, w, b)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> LanguageModel | None:
    """Classifiers from rows with text and language; None if there are no such rows.

    The sample is the rows of smallest hash of ``key`` and text: up to ROWS_PER_LANGUAGE of each language and
    MAX_ROWS in all, filled evenly. Ids, hashes and languages are sorted before any text is read.
    """
    keyed = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("t"), F.xxhash64(F.col(key), F.col(text)).alias("h")
    )
    # Hashes are even, so below twice the share wanted of a language there are enough: only those are ranked.
    few = keyed.select("lang", "h").distinct()
    share = few.groupBy("lang").agg((F.lit(2.0 * ROWS_PER_LANGUAGE) / F.count("*")).alias("share"))
    low = few.join(share, "lang").filter(F.col("h").cast("double") < F.col("share") * 2.0**64 - 2.0**63)
    order = Window.partitionBy("lang").orderBy("h")
    ranked = low.withColumn("n", F.row_number().over(order))
    chosen = ranked.filter(F.col("n") <= ROWS_PER_LANGUAGE).orderBy("n", "lang").limit(MAX_ROWS)
    # At most MAX_ROWS pairs, so broadcasting them is safe; repeated rows are all the same text.
    sample = keyed.join(F.broadcast(chosen.select("lang", "h")), ["lang", "h"], "left_semi")
    sample = sample.select("lang", "h", F.col("t").cast("binary").alias("t")).dropDuplicates(["lang", "h"])
    rows = sample.mapInArrow(_sample_features, "lang string, h long, row binary").collect()
    found = {(r["lang"], r["h"]): r["row"] for r in rows}
    if not found:
        return None
    keys = sorted(found)
    languages = sorted({name for name, _ in keys})
    rows = np.frombuffer(b"".join(found[k] for k in keys), np.float16).reshape(len(keys), FEATURES)
    labels = np.array([languages.index(name) for name, _ in keys])
    return _fit(rows.astype(np.float32), labels, languages)


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = features([t or b"" for t in batch.column("t").to_pylist()]).astype(np.float16)
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("h"), pa.array([r.tobytes() for r in rows], pa.binary())],
            names=["lang", "h", "row"],
        )


def identify(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and a struct ``language`` of ``lang, score, ambiguous``.

    Only the text is looked at. NULL and texts without a letter, and all texts if there is no model, are ``und``
    with score 0 and not ambiguous. Equal texts get equal results. A column that is called ``language``
    already is kept beside ``language_``. The model travels with the tasks: 8192 weights a bit.
    """
    in_small_batches(docs.sparkSession)
    rows = docs.select(as_row(docs).alias("r"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        worker_memory("langid")
        for batch in batches:
            texts = texts_in(batch, "r", text).cast(pa.string()).to_pylist()
            known = [model is not None and t is not None and _has_letter(t) for t in texts]
            best, score, lead = [], [], []
            for part in chunks(t.encode() if k else b"" for t, k in zip(texts, known, strict=True)):
                for start in range(0, len(part) if model else 0, 512):
                    found = model.decode(features(part[start : start + 512]))
                    for held, values in zip((best, score, lead), found, strict=True):
                        held.extend(values.tolist())
            if model is None:
                best, score, lead = [0] * len(texts), [0.0] * len(texts), [1.0] * len(texts)
            names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("r"),
                    pa.array(names, pa.string()),
                    pa.array([s if k else 0.0 for s, k in zip(score, known, strict=True)], pa.float64()),
                    pa.array([k and gap < LEAD for gap, k in zip(lead, known, strict=True)], pa.bool_()),
                ],
                names=["r", "lang_pred", "score", "ambiguous"],
            )

    kinds = rows.select("r").schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    found = rows.mapInArrow(run, kinds)
    language = F.struct(F.col("lang_pred").alias("lang"), "score", "ambiguous")
    return found.select(
        *from_row("r", docs), language.alias(free_name(docs, "language"))
    )


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        "language.score",
        "language.ambiguous",
    )

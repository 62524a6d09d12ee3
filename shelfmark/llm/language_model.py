"""A log-bilinear language model, trained by noise-contrastive estimation, that gives normalised probabilities.

Words fall into classes: each of the commonest words is one, the end of a text is one, and all others are dealt to
classes by their last two bytes. The model predicts the class of a word from the two classes before it: the
context's vectors, each through a matrix of its place, add up to a predicted vector, whose products with all
classes' vectors are the classes' scores. Training compares each class with drawn noise classes and so needs no
sum over classes; scoring normalises over all of them, in one matrix product per batch of distinct
contexts. Within its class a word has the share of its count. Words never seen have one probability together,
estimated by the share of words seen once. So the probabilities of all V known words and of an unknown one
add up to 1 in every context.

Counts come from all training texts. Shards of the texts, dealt by hash, train from the same start; the weights are
averaged, each shard's by its number of tokens, and start the next of a few rounds, each over texts of its own. Counts of common words are broadcast (a bounded number), those
of all others are joined.
"""

from __future__ import annotations

import binascii
import math
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import chunks, in_small_batches, read_table, stage
from shelfmark.llm.vocabulary import HEAD, HELD, head_from, in_head, token_counts

#: Classes: the end, COMMON words, and ENDINGS classes of other words.
COMMON = 383
ENDINGS = 128
CLASSES = 1 + COMMON + ENDINGS
#: Length of the vectors, noise classes per batch, words per step.
WIDTH = 24
NOISE = 48
BATCH = 2048
RATE = 0.15
#: Tokens of a shard, about, which one task learns from, and rounds of averaging.
SHARD_TOKENS = 1 << 22
ROUNDS = 3
#: Weights are added up in this many parts.
PARTS = 16
#: The end of a text, as a token of the counts: no word holds a blank.
END = b" "


def words(text: bytes) -> list[bytes]:
    """Words, A-Z lowered; bytes split and lower in ASCII only."""
    return text.lower().split()


def words_and_end(text: bytes) -> list[bytes]:
    return [*words(text), END]


def ending_class(word: bytes) -> int:
    return 1 + COMMON + binascii.crc32(word[-2:]) % ENDINGS


@dataclass
class Counts:
    """The head of the vocabulary and sums over all of it."""

    head: dict[bytes, int]  # word to its index in the arrays; the end is 0
    counts: np.ndarray
    classes: np.ndarray
    class_totals: np.ndarray  # of all words, not of the head only
    tokens: int
    distinct: int
    unseen: float  # probability of all unknown words together

    @property
    def log_total(self) -> float:
        return math.log10(self.tokens + self.distinct + 1)


class _Codes(dict):
    """Number of each word: those of the head first, then others as they come."""

    def __init__(self, counts: Counts) -> None:
        super().__init__(counts.head)
        self.given = counts
        self.others: list[bytes] = []
        self.kinds = array("q")

    def __missing__(self, word: bytes) -> int:
        code = len(self.given.head) + len(self.others)
        self[word] = code
        self.others.append(word)
        self.kinds.append(ending_class(word))
        return code

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all words and ends, and where each text begins."""
        if len(self.others) > HELD:
            self.clear()
            self.update(self.given.head)
            self.others.clear()
            del self.kinds[:]
        split = [words_and_end(text) for text in texts]
        starts = np.concatenate([[0], np.cumsum([len(w) for w in split])]).astype(np.int64)
        return np.fromiter(map(self.__getitem__, chain.from_iterable(split)), np.int64, starts[-1]), starts

    def classes(self, codes: np.ndarray) -> np.ndarray:
        """Classes of codes. Only what is asked for is copied: a worker holds very many words, a chunk of texts few."""
        n = len(self.given.head)
        found = self.given.classes.take(np.minimum(codes, n - 1))
        others = np.flatnonzero(codes >= n)
        if len(others):
            found[others] = np.frombuffer(self.kinds, np.int64).take(codes[others] - n)
        return found


def _contexts(classes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes one and two places before; CLASSES stands for before the text."""
    before = np.concatenate([[CLASSES], classes[:-1]])
    before[starts[:-1]] = CLASSES
    second = np.concatenate([[CLASSES], before[:-1]])
    second[starts[:-1]] = CLASSES
    return before, second


@dataclass
class Weights:
    """Vectors of context classes, matrices of the two places, vectors and offsets of predicted classes."""

    context: np.ndarray
    near: np.ndarray
    far: np.ndarray
    target: np.ndarray
    offset: np.ndarray

    @classmethod
    def start(cls, class_totals: np.ndarray, seed: int = 11) -> Weights:
        rng = np.random.default_rng(seed)
        share = (class_totals + 1.0) / (class_totals + 1.0).sum()
        return cls(
            rng.normal(0, 0.3, (CLASSES + 1, WIDTH)).astype(np.float32),
            np.eye(WIDTH, dtype=np.float32) * 0.7,
            np.eye(WIDTH, dtype=np.float32) * 0.3,
            np.zeros((CLASSES, WIDTH), np.float32),
            np.log(share).astype(np.float32),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.context, self.near, self.far, self.target, self.offset)])

    @classmethod
    def of(cls, flat: np.ndarray) -> Weights:
        shapes = [(CLASSES + 1, WIDTH), (WIDTH, WIDTH), (WIDTH, WIDTH), (CLASSES, WIDTH), (CLASSES,)]
        ends = np.cumsum([math.prod(s) for s in shapes])
        return cls(*(part.reshape(s) for part, s in zip(np.split(flat, ends[:-1]), shapes, strict=True)))


def _add_rows(into: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Sum ``rows`` by ``at``: sorted, so equal indices are one segment. Numbers of 16 bits are sorted by their digits."""
    order = np.argsort(at.astype(np.int16), kind="stable")
    sorted_ = at[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    into[sorted_[first]] += np.add.reduceat(rows.take(order, axis=0), first, axis=0)


class Trainer:
    """Noise-contrastive estimation with steps scaled by the gradients so far (Adagrad)."""

    def __init__(self, weights: Weights, class_totals: np.ndarray, seed: int) -> None:
        self.w = Weights(*(x.copy() for x in vars(weights).values()))
        self.seen = Weights(*(np.full_like(x, 0.1) for x in vars(weights).values()))
        share = (class_totals + 1.0) / (class_totals + 1.0).sum()
        self.noise = np.cumsum(share)
        self.log_noise = np.log(NOISE * share).astype(np.float32)
        self.rng = np.random.default_rng(seed)

    def step(self, near: np.ndarray, far: np.ndarray, target: np.ndarray) -> None:
        w, n = self.w, len(target)
        drawn = np.minimum(np.searchsorted(self.noise, self.rng.random(NOISE)), CLASSES - 1)
        # Rows are taken by "take", which is several times as fast as an index.
        a, b, goal, noise = w.context.take(near, axis=0), w.context.take(far, axis=0), w.target.take(target, axis=0), w.target[drawn]
        predicted = a @ w.near + b @ w.far
        hit = np.einsum("ij,ij->i", predicted, goal) + w.offset.take(target) - self.log_noise.take(target)
        miss = predicted @ noise.T
        miss += w.offset[drawn]
        miss -= self.log_noise[drawn]
        pull = -1 / (1 + np.exp(np.minimum(np.maximum(hit, -30), 30)))
        # In place: this is the one large array.
        push = np.negative(miss, out=miss)
        np.minimum(np.maximum(push, -30, out=push), 30, out=push)
        np.exp(push, out=push)
        push += 1
        np.divide(1, push, out=push)
        slope = push @ noise
        slope += pull[:, None] * goal
        grown = Weights(*(np.zeros_like(x) for x in vars(w).values()))
        _add_rows(grown.target, target, pull[:, None] * predicted)
        np.add.at(grown.target, drawn, push.T @ predicted)
        grown.offset += np.bincount(target, pull, CLASSES).astype(np.float32)
        np.add.at(grown.offset, drawn, push.sum(axis=0))
        grown.near += a.T @ slope
        grown.far += b.T @ slope
        _add_rows(grown.context, near, slope @ w.near.T)
        _add_rows(grown.context, far, slope @ w.far.T)
        for value, total, change in zip(vars(w).values(), vars(self.seen).values(), vars(grown).values(), strict=True):
            change /= math.sqrt(n)
            total += change * change
            value -= RATE * change / np.sqrt(total)


class Scorer:
    """Normalised class probabilities; the sum over classes is computed once per distinct context."""

    def __init__(self, weights: Weights, class_totals: np.ndarray) -> None:
        self.near = weights.context @ weights.near
        self.far = weights.context @ weights.far
        # Classes without words have no probability.
        self.target, self.offset = weights.target, np.where(class_totals > 0, weights.offset, np.float32(-1e9))
        self.totals = np.full((CLASSES + 1) ** 2, np.nan)

    def log10(self, near: np.ndarray, far: np.ndarray, target: np.ndarray) -> np.ndarray:
        context = near * (CLASSES + 1) + far
        new = np.unique(context[np.isnan(self.totals.take(context))])
        for start in range(0, len(new), 4096):
            part = new[start : start + 4096]
            scores = (self.near[part // (CLASSES + 1)] + self.far[part % (CLASSES + 1)]) @ self.target.T + self.offset
            top = scores.max(axis=1, keepdims=True)
            self.totals[part] = top[:, 0] + np.log(np.exp(scores - top).sum(axis=1, dtype=np.float64))
        predicted = self.near.take(near, axis=0) + self.far.take(far, axis=0)
        score = np.einsum("ij,ij->i", predicted, self.target.take(target, axis=0)) + self.offset.take(target)
        return (score - self.totals.take(context)) / math.log(10)


def _class_of(token: Column, common: dict[str, int]) -> Column:
    """The class of a word, for sums by class; the two last bytes are taken from its hexadecimal form."""
    ending = F.crc32(F.unhex(F.substring(F.hex(token.cast("binary")), -4, 4))) % ENDINGS + 1 + COMMON
    # Common words are COMMON in number.
    known = F.element_at(F.create_map(*[F.lit(x) for pair in common.items() for x in pair]), token)
    return F.coalesce(known, ending.cast("int"))


def _gather(table: DataFrame, start: int) -> Counts:
    total = table.agg(
        F.sum("n").alias("tokens"), F.count("*").alias("distinct"), F.count(F.when(F.col("n") == 1, 1)).alias("once")
    ).first()
    head = table.filter(in_head(start)).toArrow()
    pairs = sorted(zip(head["token"].to_pylist(), head["n"].to_pylist(), strict=True), key=lambda p: (-p[1], p[0]))
    end = END.decode()
    ends = next((n for t, n in pairs if t == end), None)
    if ends is None:  # the end may be rare in a corpus of few long texts
        ends = (table.filter(F.col("token") == end).agg(F.sum("n")).first()[0]) or 0
    ordered = [(end, ends), *(p for p in pairs if p[0] != end)]
    common = {end: 0} | {t: i for i, (t, _) in enumerate(ordered[1 : COMMON + 1], 1)}
    by_class = table.groupBy(_class_of(F.col("token"), common).alias("c")).agg(F.sum("n").alias("n")).collect()
    totals = np.zeros(CLASSES)
    for row in by_class:
        totals[row["c"]] = row["n"]
    classes = [common.get(t, -1) if i <= COMMON else ending_class(t.encode()) for i, (t, _) in enumerate(ordered)]
    tokens = total["tokens"] or 0
    return Counts(
        {t.encode(): i for i, (t, _) in enumerate(ordered)},
        np.array([n for _, n in ordered], np.float64),
        np.array(classes, np.int64),
        totals,
        tokens,
        total["distinct"],
        # Good and Turing: as likely as words seen once, kept away from 0 and 1.
        (total["once"] + 1) / (tokens + total["distinct"] + 2),
    )


def train(texts: DataFrame, counts: Counts) -> Weights:
    """What shards of the texts learn, averaged after each of ROUNDS; ``texts`` has the binary column ``t``, and ``h`` to deal by.

    Shards and rounds follow the hashes and the number of tokens, and each shard takes its texts in order of hashes. So the
    weights don't depend on how the texts are split among tasks. Every text is learned from once.
    """
    weights = Weights.start(counts.class_totals)
    if "h" not in texts.columns:
        texts = texts.withColumn("h", F.xxhash64("t"))
    shards = max(1, -(-counts.tokens // SHARD_TOKENS))
    turn = F.pmod(F.shiftright("h", 32), F.lit(ROUNDS)).cast("int").alias("turn")
    dealt = texts.select("t", "h", F.pmod("h", F.lit(shards)).cast("int").alias("shard"), turn)
    for number in range(ROUNDS):
        weights = _round(dealt.filter(F.col("turn") == number), counts, weights, number)
    return weights


def _round(dealt: DataFrame, counts: Counts, weights: Weights, number: int) -> Weights:
    """All shards of a round learn from the same start; the average, each shard's share its number of tokens."""
    shared = dealt.sparkSession.sparkContext.broadcast((counts, weights))

    def run(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, start = shared.value
        codes, tokens = _Codes(counts), 0
        learned = Trainer(start, counts.class_totals, int(key[0]) * ROUNDS + number)
        for frame in frames:
            for part in chunks(frame["t"]):
                found, starts = codes.of(part)
                classes = codes.classes(found)
                near, far = _contexts(classes, starts)
                order = learned.rng.permutation(len(classes))
                near, far, target = near.take(order), far.take(order), classes.take(order)
                for i in range(0, len(order), BATCH):
                    learned.step(near[i : i + BATCH], far[i : i + BATCH], target[i : i + BATCH])
                tokens += len(classes)
        parts = np.array_split(learned.w.flat().astype(np.float64) * tokens, PARTS)
        yield pd.DataFrame({"part": range(PARTS), "tokens": tokens, "weights": [p.tobytes() for p in parts]})

    def add(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, tokens = 0.0, 0
        for frame in frames:
            for n, raw in zip(frame["tokens"], frame["weights"], strict=True):
                total = total + np.frombuffer(raw, np.float64)
                tokens += n
        yield pd.DataFrame({"part": [key[0]], "tokens": [tokens], "weights": [total.tobytes()]})

    schema = "part int, tokens long, weights binary"
    ordered = dealt.repartition("shard").sortWithinPartitions("shard", "h").select("shard", "t")
    summed = ordered.groupBy("shard").applyInPandas(run, schema).groupBy("part").applyInPandas(add, schema)
    rows = sorted(summed.collect(), key=lambda r: r["part"])
    if not rows:
        return weights
    return Weights.of(np.concatenate([np.frombuffer(r["weights"]) / r["tokens"] for r in rows]).astype(np.float32))


def score(
    docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", head: int = HEAD
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``held_out`` says which rows the model does not learn from. Scores are log10 probabilities of the whole text
    with its end; ``base_score`` is that of a unigram model with one added to each count. A NULL text is read as empty
    and has one token, its end. Repeated rows are learned from and scored as often as they occur; without any
    training row everything is unknown. Scores don't depend on how the rows are split among tasks. Other columns are not looked at. ``head`` bounds the words that
    are broadcast; it changes the plan, and the classes only if it is under COMMON.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(text).cast("binary").alias("t"),
    )
    in_small_batches(docs.sparkSession)
    # Copies with ids of their own go to different shards.
    training = rows.filter(~F.col("held_out")).select("t", F.xxhash64("doc_id", "t").alias("h"))
    table = stage(token_counts(training.select("t"), words_and_end), "words")
    start = head_from(table, head)
    counts = _gather(table, start)
    weights = train(training, counts)
    shared = docs.sparkSession.sparkContext.broadcast((counts, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, weights = shared.value
        codes, scorer = _Codes(counts), Scorer(weights, counts.class_totals)
        number = TaskContext.get().partitionId() << 33
        n_head = len(counts.head)
        with np.errstate(divide="ignore"):
            log_totals = np.log10(counts.class_totals)
            log_seen = math.log10(1 - counts.unseen)
            base = np.log10(counts.counts + 1) - counts.log_total
            share = np.log10(counts.counts) - log_totals[counts.classes] + log_seen
        if not counts.tokens:
            share[:], log_totals[:] = math.log10(counts.unseen), 0
        for batch in batches:
            columns: list[list] = [[] for _ in range(5)]
            ends, names, times, values = [0], [], [], []
            for part in chunks(batch.column("t").to_pylist()):
                found, starts = codes.of(part)
                classes = codes.classes(found)
                likely = scorer.log10(*_contexts(classes, starts), classes)
                if not counts.tokens:
                    likely[:] = 0
                common = found < n_head
                known = np.minimum(found, n_head - 1)
                sums = [
                    np.add.reduceat(x, starts[:-1])
                    for x in (
                        common & (counts.counts[known] > 0),
                        np.where(common, base[known], 0.0),
                        np.where(common, share[known] + likely, 0.0),
                    )
                ]
                # Others: per text and word, how often, and what the classes give.
                at = np.flatnonzero(~common)
                owner = np.searchsorted(starts, at, side="right") - 1
                limit = n_head + len(codes.others)
                pair, inverse = np.unique(owner * limit + found[at], return_inverse=True)
                gives = likely[at] - log_totals[classes[at]] + log_seen
                total = np.bincount(inverse, gives, len(pair)) if len(pair) else np.empty(0)
                count = np.bincount(inverse, minlength=len(pair)) if len(pair) else np.empty(0, np.int64)
                names.extend(codes.others[code - n_head] for code in (pair % limit).tolist())
                times.extend(count.tolist())
                values.extend(total.tolist())
                ends.extend((len(names) - len(pair) + np.searchsorted(pair // limit, np.arange(1, len(part) + 1))).tolist())
                columns[0].extend(range(number, number + len(part)))
                columns[1].extend(np.diff(starts).tolist())
                for held, x in zip(columns[2:], sums, strict=True):
                    held.extend(x.tolist())
                number += len(part)
            others = pa.StructArray.from_arrays(
                [pa.array(names, pa.binary()).cast(pa.string()), pa.array(times, pa.int64()), pa.array(values, pa.float64())],
                names=["token", "times", "gives"],
            )
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), others),
                ],
                names=["doc_id", "held_out", "row", "n_tokens", "known", "base", "score", "others"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = stage(
        rows.mapInArrow(
            run,
            f"doc_id {kind}, held_out boolean, row long, n_tokens long, known long, base double, score double, "
            "others array<struct<token:string,times:long,gives:double>>",
        ),
        "scores",
    )
    rare = scored.select("row", F.explode("others").alias("o")).select("row", "o.*")
    seen = table.filter(~in_head(start))
    met = rare.join(seen, "token", "left")
    n, times = F.coalesce("n", F.lit(0)), F.col("times")
    added = met.groupBy("row").agg(
        F.sum(F.when(n > 0, times).otherwise(0)).alias("more_known"),
        F.sum(times * (F.log10(n.cast("double") + 1) - counts.log_total)).alias("more_base"),
        F.sum(
            F.when(n > 0, F.col("gives") + times * F.log10(F.greatest(n, F.lit(1)).cast("double"))).otherwise(
                times * math.log10(counts.unseen)
            )
        ).alias("more_score"),
    )
    zero = F.lit(0.0)
    return scored.drop("others").join(added, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", zero)).alias("score"),
    )


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return score(read_table(spark, sf_dir, "documents"), held_out)

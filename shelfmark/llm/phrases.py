"""Phrases that occur together more often than their parts suggest, by Misra-Gries summaries and an exact second pass.

1. Texts become chunks of bounded size: a dictionary and word numbers, written to the shared folder.
2. The distinct phrases of each chunk, as hashes with their counts, are a Misra-Gries summary of the chunk that nothing
   was taken from. It is cut by hash ranges, whose number follows the number of words, and each range merges its
   summaries with more counters than the range's mass divided by the threshold: whatever occurs as often as the threshold
   keeps a counter. Back to the chunks go bits that tell which of their phrases survived.
3. Chunks count the survivors among their phrases exactly, as words; sums of these below the threshold go.

So equal hashes only cost a phrase that is counted in vain. Words are phrases of one word and take the same way. What
is left is joined by phrase: the counts of the parts give the scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import chunks, in_small_batches, read_table, stage

THRESHOLD = 10
MAX_WORDS = 3
TOP = 2000
#: Percent of a phrase's occurrences that a longer one must reach to take its place.
INSIDE = 50
#: Word occurrences, and distinct words, at which a chunk ends.
CHUNK_WORDS = 1 << 20
CHUNK_NAMES = 1 << 19
#: Occurrences of phrases in a hash range, about.
RANGE_MASS = 1 << 23
#: Language of texts without one.
NO_LANGUAGE = "und"

#: A-Z to a-z, a tab to a blank, characters that end a piece to line feeds.
_PIECES = bytes(
    10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_BREAK, _NOTHING = 0, -1


def _pack(values: np.ndarray) -> bytes:
    """Numbers byte by byte, compressed: bytes that are alike stand together."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(raw: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


class _Numbers(dict):
    """Numbers of the words of one language in a chunk; all languages of the chunk share one list of words."""

    def __init__(self, words: list[bytes]) -> None:
        super().__init__({b"\n": _BREAK, b"": _NOTHING})
        self.words = words

    def __missing__(self, word: bytes) -> int:
        self.words.append(word)
        self[word] = len(self.words)
        return len(self.words)


_CHUNK = "chunk long, langs array<string>, n_words array<long>, lang_of binary, sizes binary, words binary, numbers binary"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of texts: their languages, the words in them, the words' languages, and all texts as numbers of words.

    Number 0 stands between pieces; word ``i`` is the ``i - 1``-th of the list.
    """
    task, done = TaskContext.get().partitionId(), 0
    words: list[bytes] = []
    lang_of: list[tuple[int, str]] = []  # whose the words are from some place on
    known: dict[str, _Numbers] = {}
    numbers: list[np.ndarray] = []
    n_words: dict[str, int] = {}
    size = 0

    def flush() -> pa.RecordBatch:
        langs = list(n_words)
        ends = [start for start, _ in lang_of[1:]] + [len(words)]
        of = np.repeat([langs.index(lang) for _, lang in lang_of], [e - s for e, (s, _) in zip(ends, lang_of)])
        row = [
            pa.array([(task << 32) + done], pa.int64()),
            pa.array([langs], pa.list_(pa.string())),
            pa.array([[n_words[lang] for lang in langs]], pa.list_(pa.int64())),
            pa.array([_pack(of.astype("<u4"))], pa.binary()),
            pa.array([_pack(np.array([len(w) for w in words], "<u4"))], pa.binary()),
            pa.array([zstandard.ZstdCompressor(level=1).compress(b"".join(words))], pa.binary()),
            pa.array([_pack(np.concatenate(numbers).astype("<u4"))], pa.binary()),
        ]
        for held in (words, lang_of, known, numbers, n_words):
            held.clear()
        return pa.RecordBatch.from_arrays(row, names=[field.split()[0] for field in _CHUNK.split(", ")])

    for batch in batches:
        langs, place = batch.column("lang").to_pylist(), 0
        for part in chunks(batch.column("t").to_pylist()):
            by_lang: dict[str, list[bytes]] = {}
            for content in part:
                by_lang.setdefault(langs[place], []).append(content)
                place += 1
            for lang, texts in by_lang.items():
                if lang not in known:
                    known[lang] = _Numbers(words)
                    n_words[lang] = 0
                lang_of.append((len(words), lang))
                tokens = b"\n".join(texts).translate(_PIECES).replace(b"\n", b" \n ").split(b" ")
                found = np.fromiter(map(known[lang].__getitem__, tokens), np.int64, len(tokens))
                found = np.append(found[found != _NOTHING], _BREAK)
                numbers.append(found)
                n_words[lang] += int(np.count_nonzero(found))
                size += len(found)
            if size >= CHUNK_WORDS or len(words) >= CHUNK_NAMES:
                if words:
                    yield flush()
                    done += 1
                size = 0
    if words:
        yield flush()


class Chunk:
    """The distinct phrases of a chunk: per length the numbers of their words, hashes of all and how often they occur."""

    def __init__(self, row: dict, max_words: int) -> None:
        sizes = _unpack(row["sizes"], "<u4").astype(np.int64)
        blob, ends = zstandard.ZstdDecompressor().decompress(row["words"]), np.cumsum(sizes)
        self.words = [blob[end - size : end] for end, size in zip(ends.tolist(), sizes.tolist(), strict=True)]
        self.langs, self.lang_of = row["langs"], _unpack(row["lang_of"], "<u4")
        numbers = _unpack(row["numbers"], "<u4").astype(np.int64)
        seeds = [xxhash.xxh3_64_intdigest(lang.encode()) for lang in self.langs]
        hashes = np.zeros(len(self.words) + 1, np.uint64)
        whose = self.lang_of.tolist()
        hashes[1:] = [xxhash.xxh3_64_intdigest(w, seeds[l]) for w, l in zip(self.words, whose, strict=True)]
        # A phrase is known by the phrase without its last word, and that word.
        self.heads, self.lasts, found, counts = [], [], [], []
        start = np.flatnonzero(numbers)
        value, width = numbers[start], len(self.words) + 1
        hashed = None
        for length in range(1, max_words + 1):
            distinct, first, inverse, count = np.unique(value, return_index=True, return_inverse=True, return_counts=True)
            last = numbers[start[first] + length - 1]
            head = distinct // width if length > 1 else np.zeros(len(distinct), np.int64)
            word = hashes[last]
            hashed = word if hashed is None else _mix(hashed[head] * np.uint64(0x9E3779B97F4A7C15) + word)
            self.heads.append(head.astype(np.int32))
            self.lasts.append(last.astype(np.int32))
            found.append(hashed >> np.uint64(8))
            counts.append(count.astype(np.int32))
            # The next word, unless the piece ends.
            goes_on = np.flatnonzero(numbers[start + length] if len(start) else start)
            start = start[goes_on]
            value = inverse[goes_on] * width + numbers[start + length]
        self.hashes, self.counts = np.concatenate(found), np.concatenate(counts)
        self.order = np.argsort(self.hashes, kind="stable")

    def cuts(self, ranges: int) -> np.ndarray:
        """Where in the order by hash each of equally wide ranges starts."""
        part = (self.hashes[self.order] >> np.uint64(24)) * np.uint64(ranges) >> np.uint64(32)
        return np.searchsorted(part, np.arange(ranges + 1, dtype=np.uint64))

    def spell(self, chosen: np.ndarray) -> Iterator[tuple[int, list[str], list[bytes], np.ndarray]]:
        """By length: the languages, phrases and counts of those chosen."""
        start = 0
        for length, (heads, lasts) in enumerate(zip(self.heads, self.lasts, strict=True), 1):
            some = np.flatnonzero(chosen[start : start + len(heads)])
            columns, at = [], some
            for level in range(length - 1, -1, -1):
                columns.append(self.lasts[level][at])
                at = self.heads[level][at]
            spelled = [[self.words[i - 1] for i in column.tolist()] for column in columns[::-1]]
            phrases = spelled[0] if length == 1 else list(map(b" ".join, zip(*spelled, strict=True)))
            langs = self.lang_of[columns[-1] - 1]
            yield length, langs, phrases, self.counts[start + some]
            start += len(heads)


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


def merge(summaries: Iterator[tuple[np.ndarray, np.ndarray]], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """One Misra-Gries summary of at most ``capacity`` counters, and the most that any count lacks.

    Counters of equal hashes add up; while there are too many, the first that is one too many, by size, is taken off
    all, and those that reach zero go.
    """
    hashes, counts, lost = np.empty(0, np.uint64), np.empty(0, np.int64), 0
    waiting, n_waiting = [], 0

    def settle() -> None:
        nonlocal hashes, counts, lost
        both = np.concatenate([hashes, *(h for h, _ in waiting)])
        order = np.argsort(both, kind="stable")
        both, times = both[order], np.concatenate([counts, *(c for _, c in waiting)])[order]
        first = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else np.empty(0, np.int64)
        hashes = both[first]
        counts = np.add.reduceat(times, first) if len(first) else times
        if len(hashes) > capacity:
            less = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
            keep = counts > less
            hashes, counts, lost = hashes[keep], counts[keep] - less, lost + less
        waiting.clear()

    for summary in summaries:
        waiting.append(summary)
        n_waiting += len(summary[0])
        if n_waiting > capacity:
            settle()
            n_waiting = 0
    settle()
    return hashes, counts, lost


def _summaries(ranges: int, max_words: int):
    """Per chunk and hash range: hashes and counts of the chunk's phrases, in order of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = Chunk(row, max_words)
            cuts = chunk.cuts(ranges)
            hashes, counts = chunk.hashes[chunk.order], chunk.counts[chunk.order]
            parts = np.flatnonzero(np.diff(cuts)).tolist()
            some = [slice(cuts[p], cuts[p + 1]) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(parts, pa.int32()),
                    pa.array([row["chunk"]] * len(parts), pa.int64()),
                    pa.array([int(counts[s].sum(dtype=np.int64)) for s in some], pa.int64()),
                    pa.array([_pack(np.diff(hashes[s], prepend=np.uint64(0))) for s in some], pa.binary()),
                    pa.array([_pack(counts[s].astype("<u4")) for s in some], pa.binary()),
                ],
                names=["part", "chunk", "mass", "hashes", "counts"],
            )

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _survivors(threshold: int):
    """Of one hash range: per chunk one bit for each of its phrases, set if the merged summary holds it."""

    def run(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [row for frame in frames for row in frame.itertuples(index=False)]  # compressed
        hashes = lambda row: np.cumsum(_unpack(row.hashes, "<u8"), dtype=np.uint64)
        capacity = sum(row.mass for row in held) // threshold + 1
        summaries = ((hashes(row), _unpack(row.counts, "<u4").astype(np.int64)) for row in held)
        kept, counts, lost = merge(summaries, capacity)
        kept = kept[counts + lost >= threshold]
        if not len(kept):
            return
        for row in held:
            its = hashes(row)
            found = kept[np.minimum(np.searchsorted(kept, its), len(kept) - 1)] == its
            if found.any():
                bits = zstandard.ZstdCompressor(level=1).compress(np.packbits(found).tobytes())
                yield pd.DataFrame({"chunk": [row.chunk], "part": [key[0]], "bits": [bits]})

    return run


def _exact(ranges: int, max_words: int):
    """Per chunk: the phrases that survived, as words, and how often each occurs in the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = Chunk(row, max_words)
            cuts = chunk.cuts(ranges)
            chosen = np.zeros(len(chunk.order), bool)
            for found in row["found"]:
                part = slice(cuts[found["part"]], cuts[found["part"] + 1])
                bits = np.frombuffer(zstandard.ZstdDecompressor().decompress(found["bits"]), np.uint8)
                chosen[chunk.order[part]] = np.unpackbits(bits, count=part.stop - part.start).astype(bool)
            names = pa.array(chunk.langs, pa.string())
            for length, langs, phrases, counts in chunk.spell(chosen):
                yield pa.RecordBatch.from_arrays(
                    [
                        names.take(pa.array(langs)),
                        pa.array([length] * len(phrases), pa.int32()),
                        pa.array(phrases, pa.binary()).cast(pa.string()),
                        pa.array(counts.astype(np.int64), pa.int64()),
                    ],
                    names=["lang", "length", "phrase", "f"],
                )

    return run


def count_phrases(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    threshold: int = THRESHOLD,
    max_words: int = MAX_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """``lang, length, phrase, f`` for all phrases of up to ``max_words`` words that occur ``threshold`` times or more in
    their language, and ``lang, n``, the occurrences of all words in each language.

    Texts are lowered (A-Z) and split at ``. , ; : ! ?`` and line ends; phrases don't reach across. NULL texts have no
    words, a NULL language is ``und``. Repeated rows count each for itself.
    """
    in_small_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text).cast("binary").alias("t"))
    held = stage(texts.mapInArrow(_chunks, _CHUNK), "phrase-chunks")
    words = held.select(F.explode(F.arrays_zip("langs", "n_words")).alias("of"))
    totals = words.groupBy(F.col("of.langs").alias("lang")).agg(F.sum("of.n_words").alias("n"))
    mass = (totals.agg(F.sum("n")).first()[0] or 0) * max_words
    ranges = max(1, -(-mass // RANGE_MASS))
    sent = held.mapInArrow(_summaries(ranges, max_words), "part int, chunk long, mass long, hashes binary, counts binary")
    bits = sent.repartition(ranges, "part").groupBy("part").applyInPandas(_survivors(threshold), "chunk long, part int, bits binary")
    by_chunk = bits.groupBy("chunk").agg(F.collect_list(F.struct("part", "bits")).alias("found"))
    counted = held.join(by_chunk, "chunk").mapInArrow(_exact(ranges, max_words), "lang string, length int, phrase string, f long")
    summed = counted.groupBy("lang", "length", "phrase").agg(F.sum("f").alias("f"))
    return stage(summed.filter(F.col("f") >= threshold), "phrases"), totals


def _score_parts() -> Column:
    """What is divided, and by what. Exact as long as counts stay below 10^16."""
    a, left, right = (F.col(name).cast("decimal(19,0)") for name in ("a", "l", "r"))
    squared = (a * a * F.lit(1_000_000).cast("decimal(7,0)")).alias("squared")
    return F.struct(squared, (left * right).alias("parts"))


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    threshold: int = THRESHOLD,
    max_words: int = MAX_WORDS,
    inside: int = INSIDE,
    top: int = TOP,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of two words or more of each language.

    A phrase that occurs ``a`` times is cut in two where its score, ``10^6 a^2 div (l r)`` with the counts ``l`` and
    ``r`` of both parts, is lowest, the first such place deciding. Phrases go that lie in a longer one with at
    least ``inside`` percent of their count. Order is by score, count (both falling) and phrase (by bytes). The rest is as
    in :func:`count_phrases`; empty tables give an empty result, and other columns are not looked at.
    """
    counted, totals = count_phrases(docs, lang, text, threshold, max_words)
    long = counted.filter("length > 1").select("lang", "phrase", "length", F.col("f").alias("a"))
    words = F.split("phrase", " ")
    joined = lambda start, size: F.array_join(F.slice("words", start, size), " ")
    # Every place to cut at.
    cut = long.select("*", words.alias("words")).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1)))
    cut = cut.select(
        "lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"),
        joined(F.col("k") + 1, F.col("length") - F.col("k")).alias("rest"),
    )
    # Parts of a phrase occur as often as it does: all of them are counted. Adaptive execution splits hot parts.
    lefts = counted.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rights = counted.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cut = cut.join(lefts, ["lang", "first"]).join(rights, ["lang", "rest"]).withColumn("s", _score_parts())
    cut = cut.withColumn("score", F.expr("s.squared div s.parts"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = cut.groupBy("lang", "phrase").agg(F.first("a").alias("a"), lowest)
    if max_words > 2:
        longer = long.filter("length > 2").select("lang", F.col("a").alias("f"), "length", words.alias("words"))
        size = F.explode(F.sequence(F.lit(2), F.col("length") - 1)).alias("size")
        longer = longer.select("*", size).select(
            "*", F.explode(F.sequence(F.lit(1), F.col("length") - F.col("size") + 1)).alias("start")
        )
        within = longer.groupBy("lang", joined(F.col("start"), F.col("size")).alias("phrase")).agg(F.max("f").alias("f"))
        scored = scored.join(within, ["lang", "phrase"], "left")
        scored = scored.filter(F.col("f").isNull() | (100 * F.col("f") < inside * F.col("a")))
    # A language may hold a third of all phrases: the best of buckets first.
    order = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    buckets = max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(buckets))
    best = scored.withColumn("place", F.row_number().over(Window.partitionBy("lang", bucket).orderBy(*order)))
    best = best.filter(F.col("place") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return (
        best.filter(F.col("rank") <= top).join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang, unnest(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
word_lists AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces),
lengths AS (SELECT unnest(range(1, {MAX_WORDS} + 1)) AS length),
starts AS (SELECT lang, length, words, unnest(range(1, len(words) - length + 2)) AS start FROM word_lists, lengths),
counts AS (
  SELECT lang, length, array_to_string(words[start:start + length - 1], ' ') AS phrase, count(*) AS f
  FROM starts GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM word_lists GROUP BY lang),
candidates AS (
  SELECT lang, length, phrase, f AS a, string_split(phrase, ' ') AS words FROM counts
  WHERE length > 1 AND f >= {THRESHOLD}),
cuts AS (SELECT *, unnest(range(1, length)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
         CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:c.k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[c.k + 1:c.length], ' ')),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, a AS f, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS phrase
  FROM candidates WHERE length = 3),
within AS (SELECT lang, phrase, max(f) AS f FROM longer GROUP BY lang, phrase),
ranked AS (
  SELECT lowest.*, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, lowest.phrase) AS rank
  FROM lowest LEFT JOIN within w ON w.lang = lowest.lang AND w.phrase = lowest.phrase
  WHERE w.f IS NULL OR 100 * w.f < {INSIDE} * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}
"""

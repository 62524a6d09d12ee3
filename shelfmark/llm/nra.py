"""Ranked lexical search by the NRA method: no random accesses, only reads of impact-sorted lists.

Tasks that read documents make shards of an inverted index, each of a bounded number of documents and postings. For a
query every list of the shard is in order of falling gain (the weight of the term times the impact of the document), and
all lists are read in step, each round twice as deep as the one before. What a document has gained so far is its lower
bound; its upper bound adds the last gain read of each list that it has not been met in. Reading stops when the upper
bounds of all other documents, those never met among them, lose against the k-th lower bound, ids deciding ties, and when
both bounds of the best k are equal, so that their scores are final. Shards use the statistics of the whole collection:
their best k merge to the best k of all.

Queries come in blocks of bounded size, and each block takes two passes over the shards: one to add up the document
frequencies of its terms, one to search.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from shelfmark.llm.common import chunks, in_small_batches, read_table, stage
from shelfmark.session import fresh_dir

K = 10
#: Documents and postings of a shard.
SHARD_DOCS = 1 << 13
SHARD_POSTINGS = 1 << 21
#: Postings of each list that the first round reads; every round doubles the depth.
FIRST_DEPTH = 32
#: Items and distinct terms of a pass: at most 16 bytes a term are broadcast. An item of more terms goes alone.
PASS_ITEMS = 4096
PASS_TERMS = 1 << 18
#: Words that a worker remembers the hashes of.
KNOWN_WORDS = 1 << 20
#: A-Z to a-z; ASCII characters that are neither letters nor digits to blanks.
_TERM_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) < KNOWN_WORDS:
            self[word] = found
        return found


def terms_of(text: bytes, hashes: _Hashes) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of the distinct terms, how often each occurs, and how many terms there are with repeats."""
    words = text.translate(_TERM_BYTES).split()
    counts = Counter(words)
    n = len(counts)
    return (
        np.fromiter(map(hashes.__getitem__, counts), np.uint64, n),
        np.fromiter(counts.values(), np.int64, n),
        len(words),
    )


def _packed(values: np.ndarray, kind: str) -> pa.Array:
    return pa.array([zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes())], pa.binary())


def _opened(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


_KINDS = {"lengths": "<u8", "terms": "<u8", "counts": "<u4", "docs": "<u2", "times": "<u4"}


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per shard: the documents with a term, their lengths, and postings in order of terms and documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        ids, lengths, terms, times, postings = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            doc = np.repeat(np.arange(len(ids)), [len(t) for t in terms])
            term, time = np.concatenate(terms), np.concatenate(times)
            by = np.argsort(term, kind="stable")
            names, first = np.unique(term[by], return_index=True)
            held = {"lengths": np.array(lengths), "terms": names, "counts": np.diff(first, append=len(by))}
            held |= {"docs": doc[by], "times": np.minimum(time[by], 2**32 - 1)}
            row = [
                pa.array([[i.as_py() for i in ids]], pa.list_(ids[0].type)),
                pa.array([len(ids)], pa.int64()),
                pa.array([int(sum(lengths))], pa.int64()),
                *(_packed(held[name], kind) for name, kind in _KINDS.items()),
            ]
            for column in (ids, lengths, terms, times):
                column.clear()
            return pa.RecordBatch.from_arrays(row, names=["doc_ids", "n_docs", "n_terms", *_KINDS])

        for batch in batches:
            names, done = batch.column("doc_id"), 0
            for part in chunks(batch.column("t").to_pylist()):
                for content in part:
                    term, time, n = terms_of(content, hashes)
                    if n:
                        ids.append(names[done])
                        lengths.append(n)
                        terms.append(term)
                        times.append(time)
                        postings += len(term)
                    done += 1
                    if len(ids) >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                        yield flush()
                        postings = 0
        if ids:
            yield flush()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    packed = ", ".join(f"{name} binary" for name in _KINDS)
    return rows.mapInArrow(run, f"doc_ids array<{kind}>, n_docs long, n_terms long, {packed}")


def _items(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Per item the hashes of its distinct terms. Rows with the same id are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            names, done = batch.column("item_id"), 0
            for part in chunks(batch.column("t").to_pylist()):
                found = [terms_of(content, hashes)[0] for content in part]
                which = np.repeat(np.arange(done, done + len(part)), [len(f) for f in found])
                done += len(part)
                term = pa.array(np.concatenate(found).view(np.int64), pa.int64())
                yield pa.RecordBatch.from_arrays([names.take(pa.array(which)), term], names=["item_id", "term"])

    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("binary").alias("t"))
    kind = rows.schema["item_id"].dataType.simpleString()
    terms = rows.mapInArrow(run, f"item_id {kind}, term long").distinct()
    return terms.groupBy("item_id").agg(F.collect_list("term").alias("terms"))


def _frequencies(index: DataFrame, terms: Broadcast) -> np.ndarray:
    """In how many documents of all shards each term of a pass occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms.value), np.int64)
        for batch in batches:
            for raw, counts in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                names = _opened(raw, "<u8")
                at = np.minimum(np.searchsorted(names, terms.value), len(names) - 1)
                total += np.where(names[at] == terms.value, _opened(counts, "<u4")[at], 0)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], names=["place", "df"])

    counted = index.select("terms", "counts").mapInArrow(count, "place long, df long")
    total = np.zeros(len(terms.value), np.int64)
    # At most as many rows as the pass has terms.
    for row in counted.groupBy("place").agg(F.sum("df").alias("df")).collect():
        total[row["place"]] = row["df"]
    return total


def impacts(times: np.ndarray, lengths: np.ndarray, n: int, total: int) -> np.ndarray:
    """``(10^9 tf) div (1000 tf + 8 m)`` with ``m = 10 + (90 length n) div total``."""
    if len(lengths) and 90 * int(lengths.max()) * n >= 1 << 63:
        lengths = lengths.astype(object)
    m = 10 + (90 * lengths * n // total)
    return (1_000_000_000 * times // (1000 * times + 8 * m)).astype(np.int64)


class Lists:
    """The lists of a shard for the terms of a pass, each in order of falling gain."""

    def __init__(self, row: dict, terms: np.ndarray, weights: np.ndarray, n: int, total: int) -> None:
        held = {name: _opened(row[name], kind) for name, kind in _KINDS.items()}
        lengths = held["lengths"].astype(np.int64)
        self.n = len(lengths)
        ends = np.cumsum(held["counts"], dtype=np.int64)
        at = np.minimum(np.searchsorted(held["terms"], terms), len(ends) - 1)
        # Terms without weight add nothing to any score.
        here = np.flatnonzero((held["terms"][at] == terms) & (weights > 0))
        sizes = held["counts"][at[here]].astype(np.int64)
        first = np.cumsum(sizes) - sizes
        posting = np.repeat(ends[at[here]] - sizes - first, sizes) + np.arange(sizes.sum())
        docs = held["docs"][posting].astype(np.int64)
        gains = impacts(held["times"][posting].astype(np.int64), lengths[docs], n, total)
        gains *= np.repeat(weights[here], sizes)
        order = np.lexsort((docs, -gains, np.repeat(np.arange(len(here)), sizes)))
        self.docs, self.gains = docs[order], gains[order].astype(np.float64)  # sums stay exact below 2^53
        self.first = np.full(len(terms), -1, np.int64)
        self.first[here] = first
        self.end = np.full(len(terms), -1, np.int64)
        self.end[here] = first + sizes

    def best(self, places: np.ndarray, rank: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``k`` documents for the terms at ``places``, best first, and their scores.

        ``rank`` orders the documents whose scores are equal.
        """
        places = places[self.first[places] >= 0]
        first, end = self.first[places], self.end[places]
        lower, read, depth = np.zeros(self.n), 0, FIRST_DEPTH
        while True:
            reach = np.minimum(first + depth, end)
            new = _runs(np.minimum(first + read, reach), reach)
            lower += np.bincount(self.docs[new], self.gains[new], self.n)
            # Whatever a list still holds gains no more than what was read last.
            left = np.where(reach < end, self.gains[reach - 1], 0.0)
            open_ = left > 0
            upper = lower
            if open_.any():
                met = np.zeros(self.n)
                np.add.at(met, self.docs[_runs(first[open_], reach[open_])], np.repeat(left[open_], (reach - first)[open_]))
                upper = lower + left.sum() - met
            top = np.flatnonzero(lower > 0)
            if len(top) > k:
                top = top[lower[top] >= np.partition(lower[top], len(top) - k)[len(top) - k]]
            top = top[np.lexsort((rank[top], -lower[top]))][:k]
            if not open_.any() or self._settled(top, lower, upper, rank, k):
                return top, lower[top].astype(np.int64)
            read, depth = depth, 2 * depth

    def _settled(self, top: np.ndarray, lower: np.ndarray, upper: np.ndarray, rank: np.ndarray, k: int) -> bool:
        if (upper[top] > lower[top]).any():
            return False
        other = np.ones(self.n, bool)
        other[top] = False
        if len(top) < k:
            return not (upper[other] > 0).any()
        last = top[-1]
        return not ((upper > lower[last]) & other).any() and not (
            (upper == lower[last]) & other & (rank < rank[last])
        ).any()


def _runs(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers from each ``first`` to before its ``end``."""
    sizes = end - first
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _search(
    index: DataFrame, terms: Broadcast, items: list, df: np.ndarray, size: dict, schema: StructType, k: int
) -> DataFrame:
    """The best ``k`` of each shard for each item of a pass."""
    weights = np.floor(1000 * np.log((2 * size["n"] + 2) / (2 * df + 1))).astype(np.int64)
    shared = index.sparkSession.sparkContext.broadcast((weights, items))
    kind = to_arrow_type(schema["item_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items = shared.value
        for batch in batches:
            for number in range(batch.num_rows):
                row = {name: batch.column(name)[number].as_py() for name in _KINDS}
                lists = Lists(row, terms.value, weights, size["n"], size["total"])
                ids = batch.column("doc_ids")[number].values
                rank = np.empty(len(ids), np.int64)
                rank[pc.array_sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
                asked, docs, scores = [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
                for item, places in items:
                    top, score = lists.best(places, rank, k)
                    asked.extend([item] * len(top))
                    docs.append(top)
                    scores.append(score)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(asked, kind),
                        ids.take(pa.array(np.concatenate(docs))),
                        pa.array(np.concatenate(scores), pa.int64()),
                    ],
                    names=["item_id", "doc_id", "score"],
                )

    return index.select("doc_ids", *_KINDS).mapInArrow(run, schema)


def ranked(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    k: int = K,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of greatest score for each item, equal scores by id.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lowered. The terms of an item
    count once each; rows with the same item id, also NULL, are one item. Documents without a common term with a
    weight above 0 are not returned, so NULL, empty and blank texts neither find nor are found. Repeated rows are found as
    often as they occur; a NULL id comes last among equal scores. Empty tables give an empty result; other columns are
    not looked at.
    """
    spark = docs.sparkSession
    in_small_batches(spark)
    index = stage(build_index(docs, doc_id, text), "nra-index")
    size = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("total")).first().asDict()
    asked = stage(_items(items, item_id, item_text), "nra-items")
    schema = StructType().add("item_id", items.schema[item_id].dataType).add("doc_id", docs.schema[doc_id].dataType)
    schema = schema.add("score", "long")
    folder = fresh_dir(spark, "nra-found")
    spark.createDataFrame([], schema).write.parquet(folder)
    held: list[tuple] = []

    def search() -> None:
        distinct = np.unique(np.concatenate([terms for _, terms in held]))
        terms = spark.sparkContext.broadcast(distinct)
        placed = [(name, np.searchsorted(distinct, its)) for name, its in held]
        found = _search(index, terms, placed, _frequencies(index, terms), size, schema, k)
        found.write.mode("append").parquet(folder)
        held.clear()

    if size["n"]:
        # One pass of items at a time is in the driver's memory.
        for row in asked.toLocalIterator():
            terms = np.array(row["terms"], np.int64).view(np.uint64)
            if held and (len(held) >= PASS_ITEMS or sum(len(t) for _, t in held) + len(terms) > PASS_TERMS):
                search()
            held.append((row["item_id"], terms))
        if held:
            search()
    place = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    merged = spark.read.schema(schema).parquet(folder).withColumn("rank", F.row_number().over(place))
    return merged.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op13_nra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


ORACLE = f"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents
  UNION ALL
  SELECT 'i', item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) FROM benchmark),
postings AS (SELECT id AS doc_id, term, count(*) AS tf FROM words WHERE kind = 'd' GROUP BY ALL),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY doc_id),
collection AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM postings, collection GROUP BY term, n_docs),
scores AS (
  SELECT i.id AS item_id, p.doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // total)))) AS BIGINT) AS score
  FROM (SELECT DISTINCT id, term FROM words WHERE kind = 'i') i JOIN postings p USING (term) JOIN weights USING (term)
  JOIN lengths USING (doc_id), collection GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
           FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {K}
"""

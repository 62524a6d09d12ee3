"""Exact BM25 search over an inverted index in shards, with block-max WAND pruning.

Every task that reads documents makes a shard: an inverted index of its documents, which are numbered by falling
length so that documents of a block are alike. Per term and block of 64 documents the index gives the greatest
weight. For a query the weights of all its terms' blocks add up to a bound for each block. The blocks of greatest
bound are scored first; from then on only blocks whose bound reaches the k-th best score are, and the rest is
never touched. The bounds of many terms add up to more than any document has: queries of more than a few terms are
scored at once. The few very common terms of a shard tell little and fill every block; they are held as full
rows instead, are scored for many queries in one matrix product of single precision, and enter the bounds with these sums;
documents that may be among the best are scored exactly. What a task has found in one shard bounds the next ones.
Shards use the statistics of the whole collection, so their best k merge to the exact best k.

Queries come in blocks of bounded size. Each block takes two passes over the shards: one to add up the
document frequencies of its terms, one to search. Terms are 64-bit hashes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import chunks, in_small_batches, read_table, stage
from shelfmark.session import fresh_dir

K = 10
K1 = 1.2
B = 0.75
#: Scores are compared by this many decimals; then the smaller id wins.
DECIMALS = 6
#: Documents of a block; documents and postings of a shard.
BLOCK = 64
SHARD_DOCS = 1 << 15
SHARD_POSTINGS = 1 << 22
#: Blocks that are scored before anything is skipped.
FIRST_BLOCKS = 8
#: Queries of more terms, without the very common ones, are scored without bounds.
BOUNDED_TERMS = 64
#: More than the relative error of a sum of DENSE_TERMS products of single precision.
ERROR = 1e-4
#: Terms that occur in a 16th of a shard's documents, and 512 at most, are held as full rows; cells of a product.
DENSE_SHARE = 16
DENSE_TERMS = 512
DENSE_CELLS = 1 << 22
#: Queries and query terms of one pass: at most 16 bytes a term are broadcast, and a query of more terms goes alone.
PASS_QUERIES = 8192
PASS_TERMS = 1 << 21
#: Document frequencies are added up in so many parts.
PARTS = 16


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) < 1 << 20:
            self[word] = found
        return found


def terms_of(text: bytes, hashes: _Hashes) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of the distinct words (A-Z lowered), how often each occurs, and the number of words."""
    words = text.lower().split()
    counts = Counter(words)
    n = len(counts)
    return np.fromiter(map(hashes.__getitem__, counts), np.uint64, n), np.fromiter(counts.values(), np.int64, n), len(words)


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _opened(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per shard: its documents, their lengths, and the postings in order of terms and documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        ids, lengths, terms, times, postings = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            order = np.argsort(-np.array(lengths), kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            doc = np.repeat(place, [len(t) for t in terms])
            term, time = np.concatenate(terms), np.concatenate(times)
            by = np.lexsort((doc, term))
            term, doc, time = term[by], doc[by], time[by]
            names, first = np.unique(term, return_index=True)
            found = [
                pa.array([[ids[i].as_py() for i in order]], pa.list_(ids[0].type)),
                pa.array([len(ids)], pa.int64()),
                pa.array([int(sum(lengths))], pa.int64()),
                *(
                    pa.array([_packed(x)], pa.binary())
                    for x in (
                        np.array(lengths)[order].astype("<u4"),
                        names.astype("<u8"),
                        np.diff(first, append=len(doc)).astype("<u4"),
                        doc.astype("<u2"),
                        np.minimum(time, 2**32 - 1).astype("<u4"),
                    )
                ),
            ]
            for held in (ids, lengths, terms, times):
                held.clear()
            return pa.RecordBatch.from_arrays(found, names="doc_ids n_docs n_words lengths terms counts docs times".split())

        for batch in batches:
            names, done = batch.column("doc_id"), 0
            for part in chunks(batch.column("t").to_pylist()):
                for content in part:
                    term, time, n = terms_of(content, hashes)
                    ids.append(names[done])
                    done += 1
                    lengths.append(n)
                    terms.append(term)
                    times.append(time)
                    postings += len(term)
                    if len(ids) >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                        yield flush()
                        postings = 0
        if ids:
            yield flush()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    packed = ", ".join(f"{name} binary" for name in "lengths terms counts docs times".split())
    return rows.mapInArrow(run, f"doc_ids array<{kind}>, n_docs long, n_words long, {packed}")


@dataclass
class Queries:
    """A pass: per query its number and, in ascending order of terms, the places of its terms and how often each occurs."""

    terms: np.ndarray  # distinct hashes, sorted
    ends: np.ndarray
    places: np.ndarray
    times: np.ndarray


class Shard:
    """A shard's postings with weights, the greatest weight per term and block, and the search."""

    def __init__(self, row: dict, mean_length: float) -> None:
        lengths = _opened(row["lengths"], "<u4").astype(np.float64)
        self.terms = _opened(row["terms"], "<u8")
        counts = _opened(row["counts"], "<u4").astype(np.int64)
        self.docs = _opened(row["docs"], "<u2").astype(np.int64)
        times = _opened(row["times"], "<u4").astype(np.float64)
        self.n = len(lengths)
        self.weights = times * (K1 + 1) / (times + K1 * (1 - B + B * lengths[self.docs] / (mean_length or 1)))
        self.starts = starts = np.concatenate([[0], np.cumsum(counts)])
        # Runs of postings of one term in one block.
        block = self.docs // BLOCK
        change = np.ones(len(block), bool)
        change[1:] = block[1:] != block[:-1]
        change[starts[:-1][counts > 0]] = True
        self.run_start = np.flatnonzero(change)
        self.run_end = np.append(self.run_start[1:], len(block))
        self.run_block = block[self.run_start]
        self.run_most = np.maximum.reduceat(self.weights, self.run_start) if len(block) else np.empty(0)
        self.term_runs = np.searchsorted(self.run_start, starts)

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Index of each term in the shard, or -1."""
        at = np.minimum(np.searchsorted(self.terms, terms), max(len(self.terms) - 1, 0))
        return np.where(self.terms[at] == terms, at, -1) if len(self.terms) else np.full(len(terms), -1)

    def frequencies(self, terms: np.ndarray) -> np.ndarray:
        at = self.find(terms)
        return np.where(at >= 0, self.starts[at + 1] - self.starts[at], 0) if len(self.terms) else np.zeros(len(terms), np.int64)

    def _score(self, runs: np.ndarray, factors: np.ndarray) -> np.ndarray:
        sizes = self.run_end[runs] - self.run_start[runs]
        at = np.repeat(self.run_start[runs] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        at += np.arange(len(at))
        return np.bincount(self.docs[at], self.weights[at] * np.repeat(factors, sizes), self.n)

    def _score_all(self, at: np.ndarray, factors: np.ndarray) -> np.ndarray:
        """The scores of all documents by terms of the shard."""
        firsts, sizes = self.starts[at], self.starts[at + 1] - self.starts[at]
        places = np.repeat(firsts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        places += np.arange(len(places))
        weights = self.weights.take(places)
        weights *= np.repeat(factors, sizes)
        return np.bincount(self.docs.take(places), weights, self.n)

    def make_dense(self) -> None:
        """Hold the commonest terms as full rows, which a matrix product scores for many queries at once."""
        counts = np.diff(self.starts)
        common = np.argsort(-counts, kind="stable")[:DENSE_TERMS]
        common = common[counts[common] * DENSE_SHARE >= self.n]
        self.dense_row = np.full(len(counts), -1)
        self.dense_row[common] = np.arange(len(common))
        self.exact = np.zeros((self.n, len(common)))
        for row, term in enumerate(common):
            part = slice(self.starts[term], self.starts[term + 1])
            self.exact[self.docs[part], row] = self.weights[part]
        self.dense = np.ascontiguousarray(self.exact.T, np.float32)

    def best(self, at: np.ndarray, factors: np.ndarray, k: int, base: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Documents (by number) that may be among the best k, and their rounded scores.

        ``at`` are the shard's terms of a query in ascending order, ``factors`` their weights in the query, ``base``
        what other terms of the query give to each document.
        """
        total = np.zeros(self.n) if base is None else base.copy()
        docs = self._add(total, at, factors, k)
        return docs, np.round(total[docs], DECIMALS)

    def _add(self, total: np.ndarray, at: np.ndarray, factors: np.ndarray, k: int, least: float = 0.0, error: float = 0.0) -> np.ndarray:
        """Adds the terms' scores to ``total``. Returns the documents that may be among the best k and reach ``least``.

        ``error`` is the relative error of the sums. Documents that cannot be among the best may lack scores of some terms.
        """
        slack, starts = 2 * 10.0**-DECIMALS, np.arange(0, self.n, BLOCK)

        def enough() -> float:
            """Reached by the best k, as k blocks hold a document that does."""
            most = np.maximum.reduceat(total, starts)
            if len(most) < k:
                most = total
            kth = np.partition(most, len(most) - k)[len(most) - k] if len(most) >= k else 0.0
            return max(kth, least) * (1 - error) - slack

        if len(at) > BOUNDED_TERMS:
            total += self._score_all(at, factors)
        else:
            counts = self.term_runs[at + 1] - self.term_runs[at]
            runs = np.repeat(self.term_runs[at] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
            runs += np.arange(len(runs))
            factors = np.repeat(factors, counts)
            blocks = self.run_block[runs]
            bounds = np.bincount(blocks, self.run_most[runs] * factors, len(starts)) + np.maximum.reduceat(total, starts)
            # The blocks of greatest bound first; then those whose bound reaches the k-th score, rounding allowed for.
            first = np.zeros(len(starts), bool)
            first[np.argsort(-bounds)[:FIRST_BLOCKS]] = True
            for chosen in (lambda: first, lambda: ~first & (bounds >= enough())):
                keep = chosen()[blocks]
                total += self._score(runs[keep], factors[keep])
        docs = np.flatnonzero((total > 0) & (total >= enough()))
        if len(docs) > k:
            scores = total[docs]
            docs = docs[scores >= np.partition(scores, len(scores) - k)[len(scores) - k] * (1 - error) - slack]
        return docs


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {name: batch.column(name)[i].as_py() for name in ("lengths", "terms", "counts", "docs", "times")}


def _frequencies(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """In how many documents of all shards each term occurs."""
    shared = index.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for terms, counts in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                names = _opened(terms, "<u8")
                if len(names):
                    at = np.minimum(np.searchsorted(names, shared.value), len(names) - 1)
                    total += np.where(names[at] == shared.value, _opened(counts, "<u4")[at], 0)
        parts = [p.tobytes() for p in np.array_split(total, PARTS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(parts, pa.binary())], names=["part", "n"])

    def add(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = sum(np.frombuffer(raw, np.int64) for frame in frames for raw in frame["n"])
        yield pd.DataFrame({"part": [key[0]], "n": [total.tobytes()]})

    schema = "part int, n binary"
    summed = index.select("terms", "counts").mapInArrow(count, schema).groupBy("part").applyInPandas(add, schema)
    rows = sorted(summed.collect(), key=lambda r: r["part"])
    shared.unpersist()
    return np.concatenate([np.frombuffer(r["n"], np.int64) for r in rows]) if rows else np.zeros(len(terms), np.int64)


def _search(index: DataFrame, queries: Queries, names: list, kind: str, n: int, mean_length: float, k: int) -> DataFrame:
    """The best k of each shard for each query of a pass."""
    found = _frequencies(index, queries.terms)
    idf = np.log(1 + (n - found + 0.5) / (found + 0.5))
    shared = index.sparkSession.sparkContext.broadcast((queries, idf, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, idf, names = shared.value
        # Of each query a score that k documents of the task's shards so far have.
        least = np.zeros(len(queries.ends) - 1)
        for batch in batches:
            for number, row in enumerate(_rows(batch)):
                shard = Shard(row, mean_length)
                ids = batch.column("doc_ids")[number].values
                # Equal scores go to smaller ids, NULL last.
                rank = np.empty(len(ids), np.int64)
                rank[pa.compute.array_sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
                shard.make_dense()
                at = shard.find(queries.terms)
                asked, docs, scores = [], [], []
                n_queries = len(queries.ends) - 1
                step = max(16, DENSE_CELLS // max(shard.n, shard.dense.shape[0]))
                for start in range(0, n_queries, step):
                    some = range(start, min(start + step, n_queries))
                    held, common = [], np.zeros((len(some), shard.dense.shape[0]))
                    for row, query in enumerate(some):
                        part = slice(queries.ends[query], queries.ends[query + 1])
                        places = queries.places[part]
                        terms, factors = at[places], idf[places] * queries.times[part]
                        here = terms >= 0
                        terms, factors = terms[here], factors[here]
                        dense = shard.dense_row[terms]
                        common[row, dense[dense >= 0]] = factors[dense >= 0]
                        held.append((terms[dense < 0], factors[dense < 0]))
                    bases = common.astype(np.float32) @ shard.dense
                    for query, (terms, factors), base, exact in zip(some, held, bases, common, strict=True):
                        total = base.astype(np.float64)
                        doc = shard._add(total, terms, factors, k, least[query], ERROR)
                        score = np.round(total[doc] - base[doc] + shard.exact[doc] @ exact, DECIMALS)
                        top = np.lexsort((rank[doc], -score))[:k]
                        if len(top) == k:
                            least[query] = max(least[query], score[top[-1]])
                        asked.extend([query] * len(top))
                        docs.append(doc[top])
                        scores.append(score[top])
                if asked:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([names[q] for q in asked], batch.schema.field("doc_ids").type.value_type),
                            ids.take(pa.array(np.concatenate(docs))),
                            pa.array(np.concatenate(scores), pa.float64()),
                        ],
                        names=["query_id", "doc_id", "score"],
                    )

    return index.select("doc_ids", "lengths", "terms", "counts", "docs", "times").mapInArrow(
        run, f"query_id {kind}, doc_id {kind}, score double"
    )


def top_k(
    docs: DataFrame, is_query: Column, doc_id: str = "doc_id", text: str = "text", k: int = K
) -> DataFrame:
    """``query_id, rank, doc_id, score``: the ``k`` documents of greatest BM25 score for each row that asks.

    The query is the row's whole text, a word that occurs twice counting twice; all rows are searched, the
    asking one too. Scores are rounded to six decimals; equal ones go to the smaller id, NULL last. Documents that
    share no word with the query are not returned, so NULL and empty texts neither find nor are found. Rows
    that ask with a NULL id don't. Repeated rows are found as often as they occur, and ask as one.
    An empty table gives an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    in_small_batches(spark)
    index = stage(build_index(docs, doc_id, text), "bm25-index")
    size = index.agg(F.sum("n_docs").alias("n"), F.sum("n_words").alias("words")).first()
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"query_id {kind}, doc_id {kind}, score double"
    folder = fresh_dir(spark, "bm25-found")
    spark.createDataFrame([], schema).write.parquet(folder)
    asking = docs.filter(is_query & F.col(doc_id).isNotNull() & F.col(text).isNotNull())
    asking = asking.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("t")).dropDuplicates()

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            terms, times = [], []
            for part in chunks(batch.column("t").to_pylist()):
                for content in part:
                    term, time, _ = terms_of(content, hashes)
                    order = np.argsort(term)
                    terms.append(term[order].tobytes())
                    times.append(time[order].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(terms, pa.binary()), pa.array(times, pa.binary())], names=["id", "terms", "times"]
            )

    prepared = stage(asking.mapInArrow(prepare, f"id {kind}, terms binary, times binary"), "bm25-queries")
    names, terms, times = [], [], []

    def search() -> None:
        distinct, places = np.unique(np.concatenate(terms), return_inverse=True)
        ends = np.concatenate([[0], np.cumsum([len(t) for t in terms])])
        queries = Queries(distinct, ends, places, np.concatenate(times).astype(np.float64))
        mean = (size["words"] or 0) / size["n"]
        found = _search(index, queries, list(names), kind, size["n"], mean, k)
        found.write.mode("append").parquet(folder)
        for held in (names, terms, times):
            held.clear()

    # One pass of queries at a time is in the driver's memory.
    for row in prepared.toLocalIterator():
        term = np.frombuffer(row["terms"], np.uint64)
        if names and (len(names) >= PASS_QUERIES or sum(map(len, terms)) + len(term) > PASS_TERMS):
            search()
        if len(term):
            names.append(row["id"])
            terms.append(term)
            times.append(np.frombuffer(row["times"], np.int64))
    if names:
        search()
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    merged = spark.read.schema(schema).parquet(folder).withColumn("rank", F.row_number().over(place))
    return merged.filter(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def op5_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "documents"), F.col("doc_id") % 100 == 0)


ORACLE = f"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')) AS term
  FROM documents),
postings AS (SELECT doc_id, term, count(*) AS times FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, sum(times) AS length FROM postings GROUP BY doc_id),
collection AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT sum(times) FROM postings) AS words),
idf AS (SELECT term, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf
        FROM postings, collection GROUP BY term, n),
scores AS (
  SELECT q.doc_id AS query_id, d.doc_id,
         round(sum(q.times * idf * d.times * {K1 + 1}
                   / (d.times + {K1} * ({1 - B} + {B} * length / (words / n)))), {DECIMALS}) AS score
  FROM postings q JOIN postings d ON q.term = d.term JOIN idf ON idf.term = q.term
  JOIN lengths ON lengths.doc_id = d.doc_id, collection
  WHERE q.doc_id % 100 = 0 GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scores)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {K}
"""

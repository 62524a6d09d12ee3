"""Approximate nearest neighbours by a forest of sorted hash prefixes.

Each tree gives every vector a long string of bits, the sides of random planes that it lies on; a tree is the
array of these strings in order. A query goes down each tree to the longest prefix that it shares and then up in
all trees at once, a bit at a time, until the vectors that share the prefix add up to enough in all trees
together. Those are scored exactly.

Prefixes are counted first, up to a bounded depth, which gives the height to go up to for any query. The
arrays are cut into blocks of bounded size along prefixes; a query visits the blocks that its prefixes cover and
brings back its best from each. Inner products are turned into angles by one more coordinate that lifts all
vectors to the greatest length; as that blurs the angles of much shorter ones, each range of lengths is a forest of
its own, and every query goes to all of them.

Equal vectors are one entry of the forest, with the smallest ids that a result can need.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import read_table, stage

TREES = 48
#: Bits of a hash string.
BITS = 32
#: Prefixes are counted to this depth at most: the counts of all trees stay under 26 MB.
DEPTH = 16
#: A query goes up until EFFORT * rows ** GROWTH vectors share its prefixes. For unit vectors, a neighbour at a cosine
#: of 0.43 shares a bit with probability 0.64, a stranger with 0.5: the exponent is log(0.64) / log(0.5).
EFFORT = 24.0
GROWTH = 0.65
#: Beyond ANCHOR rows a greater share is needed for the same recall: the exponent grows by FURTHER.
ANCHOR = 51_282
FURTHER = 0.2
#: Greatest and smallest length of a range differ by this factor, but for the longest vectors, as many as are scored all,
#: and for those that are shorter than the first RANGES - 1 ranges.
RATIO = 1.25
SCANNED = 8192
RANGES = 6
#: Vectors of a block.
BLOCK = 4096
#: Queries that meet a block in one task, about.
BLOCK_QUERIES = 1 << 15
#: Results that are scored again, in one fixed order of summation, per block and query.
SPARE = 8


@dataclass
class Forest:
    """Planes, lengths and the counts that all tasks share."""

    planes: np.ndarray  # coordinates + 1, trees * bits
    longest: float
    depth: int
    sums: np.ndarray | None = None  # per tree: vectors before each prefix of full depth
    first_block: np.ndarray | None = None  # per tree and prefix of full depth
    splits: np.ndarray | None = None
    wanted: float = 0.0

    def strings(self, vectors: np.ndarray, as_queries: bool) -> np.ndarray:
        """Hash strings, one column a tree."""
        out = np.empty((len(vectors), TREES), np.uint32)
        for start in range(0, len(vectors), 2048):
            part = vectors[start : start + 2048]
            lift = np.zeros(len(part))
            if not as_queries:
                lift = np.sqrt(np.maximum(self.longest**2 - (part * part).sum(axis=1), 0))
            sides = part @ self.planes[:-1] + lift[:, None] * self.planes[-1] > 0
            packed = np.packbits(sides.reshape(len(part), TREES, BITS), axis=2)
            out[start : start + 2048] = packed.view(">u4")[:, :, 0]
        return out

    def heights(self, strings: np.ndarray) -> np.ndarray:
        """Per query the longest prefix (in bits) at which all trees together hold enough."""
        found = np.zeros(len(strings), np.int64)
        trees = np.arange(TREES)
        for bits in range(1, self.depth + 1):
            prefix = (strings >> np.uint32(BITS - bits)).astype(np.int64)
            low, high = prefix << (self.depth - bits), (prefix + 1) << (self.depth - bits)
            enough = (self.sums[trees, high] - self.sums[trees, low]).sum(axis=1) >= self.wanted
            found[enough] = bits
        return found


def _finite(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _entries(vectors: DataFrame, is_query: Column, nearest: int) -> DataFrame:
    """One row per distinct vector: ``entry, vector, ids`` (the smallest, enough for any result), ``asked``."""
    keyed = vectors.withColumns({"k1": F.xxhash64("vector"), "k2": F.xxhash64(F.lit(23), "vector")})
    place = Window.partitionBy("k1", "k2").orderBy("id")
    # Spark keeps the first ranks in each task before it shuffles, so copies of one vector don't pile up.
    first = keyed.select("k1", "k2", "id").distinct().withColumn("n", F.row_number().over(place))
    ids = (
        first.filter(F.col("n") <= nearest + 1)
        .groupBy("k1", "k2")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    asked = keyed.groupBy("k1", "k2").agg(F.max(is_query).alias("asked"))
    alike = Window.partitionBy("k1", "k2").orderBy("id")
    one = keyed.select("k1", "k2", "id", "vector").withColumn("n", F.row_number().over(alike)).filter("n = 1")
    rows = one.select("k1", "k2", "vector").join(ids, ["k1", "k2"]).join(asked, ["k1", "k2"])
    return rows.withColumn("entry", F.monotonically_increasing_id())


def wanted(rows: int, k: int, effort: float = EFFORT) -> float:
    """How many vectors of a forest of that many are to share a query's prefixes."""
    return max(effort * rows**GROWTH * max(1.0, rows / ANCHOR) ** FURTHER, 8.0 * k)


def _cut_lengths(buckets: list[tuple[int, int, float]]) -> list[tuple[int, int, int, float]]:
    """``first, last, vectors, longest`` of each range, out of the same of each bucket of lengths, longest first."""
    found: list[tuple[int, int, int, float]] = []
    for bucket, n, longest in buckets:
        joins = found and (len(found) == RANGES or (len(found) == 1 and found[0][2] + n <= SCANNED))
        if joins:
            first, _, before, greatest = found[-1]
            found[-1] = first, bucket, before + n, greatest
        else:
            found.append((bucket, bucket, n, longest))
    return found


def _count_prefixes(entries: DataFrame, forest: Forest, width: int) -> np.ndarray:
    """Vectors per tree and prefix of full depth."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = 1 << forest.depth
        found = np.zeros((TREES, cells), np.int32)
        for batch in batches:
            strings = forest.strings(_matrix(batch.column("vector"), width), False) >> np.uint32(BITS - forest.depth)
            for tree in range(TREES):
                found[tree] += np.bincount(strings[:, tree], minlength=cells).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(TREES), pa.int32()), pa.array([row.tobytes() for row in found], pa.binary())],
            names=["tree", "counts"],
        )

    def add(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = sum(np.frombuffer(raw, np.int32).astype(np.int64) for frame in frames for raw in frame["counts"])
        yield pd.DataFrame({"tree": [key[0]], "counts": [total.tobytes()]})

    schema = "tree int, counts binary"
    summed = entries.select("vector").mapInArrow(count, schema).groupBy("tree").applyInPandas(add, schema)
    counts = np.zeros((TREES, 1 << forest.depth), np.int64)
    for row in summed.collect():
        counts[row["tree"]] = np.frombuffer(row["counts"], np.int64)
    return counts


def _cut_blocks(counts: np.ndarray, depth: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each prefix: the shortest prefixes with at most ``block`` vectors.

    Prefixes of full depth that hold more are dealt to several blocks.
    """
    first = np.zeros(counts.shape, np.int64)
    splits = np.ones(counts.shape, np.int64)
    number = 0
    for tree in range(TREES):
        open_ = [(0, 0)]
        sums = np.concatenate([[0], np.cumsum(counts[tree])])
        while open_:
            bits, prefix = open_.pop()
            low, high = prefix << (depth - bits), (prefix + 1) << (depth - bits)
            held = int(sums[high] - sums[low])
            if held > block and bits < depth:
                # The lower half comes off the stack first: blocks are numbered in order of prefixes.
                open_ += [(bits + 1, 2 * prefix + 1), (bits + 1, 2 * prefix)]
                continue
            parts = max(1, -(-held // block))
            first[tree, low:high], splits[tree, low:high] = number, parts
            number += parts
    return first, splits


def _best(scores: np.ndarray, many: int) -> np.ndarray:
    """Indices of the greatest scores of a row, in no order."""
    return np.argpartition(-scores, many - 1)[:many] if many < len(scores) else np.arange(len(scores))


_POINT_SCHEMA = "block long, strings binary, entries binary, smallest binary, vectors binary"
_QUERY_SCHEMA = "block long, low binary, high binary, entries binary, vectors binary"


def _by_block(blocks: np.ndarray) -> list[tuple[int, np.ndarray]]:
    order = np.argsort(blocks, kind="stable")
    cuts = np.flatnonzero(np.diff(blocks[order])) + 1
    return [(int(blocks[part[0]]), part) for part in np.split(order, cuts) if len(part)]


def _search(
    entries: DataFrame,
    asking: DataFrame,
    n: int,
    longest: float,
    width: int,
    exact: type,
    k: int,
    effort: float,
    seed: int,
) -> DataFrame:
    """``query, entry, score``: the best that a forest of the ``n`` ``entries`` has for those ``asking``."""
    planes = np.random.default_rng(seed).normal(size=(width + 1, TREES * BITS))
    depth = int(np.clip(np.ceil(np.log2(n + 1)), 4, DEPTH))
    forest = Forest(planes, longest, depth)
    counts = _count_prefixes(entries, forest, width)
    forest.sums = np.concatenate([np.zeros((TREES, 1), np.int64), np.cumsum(counts, axis=1)], axis=1)
    forest.first_block, forest.splits = _cut_blocks(counts, depth, BLOCK)
    forest.wanted = wanted(n, k, effort)
    shared = entries.sparkSession.sparkContext.broadcast(forest)

    def deal_points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            rows = _matrix(batch.column("vector"), width)
            entry, smallest = batch.column("entry").to_numpy(), batch.column("smallest").to_numpy()
            strings = forest.strings(rows, False)
            out = []
            for tree in range(TREES):
                prefix = strings[:, tree] >> np.uint32(BITS - forest.depth)
                # Entry numbers count up within a task, so they deal a crowded prefix evenly.
                blocks = forest.first_block[tree, prefix] + entry % forest.splits[tree, prefix]
                for block, part in _by_block(blocks):
                    arrays = strings[part, tree], entry[part], smallest[part], rows[part].astype(exact)
                    out.append((block, *(np.ascontiguousarray(a).tobytes() for a in arrays)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), *[pa.binary()] * 4])],
                names=["block", "strings", "entries", "smallest", "vectors"],
            )

    def deal_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            rows = _matrix(batch.column("vector"), width)
            entry = batch.column("entry").to_numpy()
            strings = forest.strings(rows, True)
            up = (BITS - forest.heights(strings)).astype(np.uint64)
            out = []
            for tree in range(TREES):
                low = strings[:, tree].astype(np.uint64) >> up << up
                high = low + (np.uint64(1) << up) - np.uint64(1)
                shift = np.uint64(BITS - forest.depth)
                first, last = (low >> shift).astype(np.int64), (high >> shift).astype(np.int64)
                start = forest.first_block[tree, first]
                end = forest.first_block[tree, last] + forest.splits[tree, last]
                many = end - start
                who = np.repeat(np.arange(len(rows)), many)
                blocks = np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many) + start[who]
                for block, at in _by_block(blocks):
                    part = who[at]
                    arrays = low[part], high[part], entry[part], rows[part].astype(exact)
                    out.append((block, *(a.tobytes() for a in arrays)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), *[pa.binary()] * 4])],
                names=["block", "low", "high", "entries", "vectors"],
            )

    def search(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(points) and len(queries):
            strings = np.frombuffer(b"".join(points["strings"]), np.uint32)
            order = np.argsort(strings, kind="stable")
            strings = strings[order].astype(np.uint64)
            entry = np.frombuffer(b"".join(points["entries"]), np.int64)[order]
            smallest = np.frombuffer(b"".join(points["smallest"]), np.int64)[order]
            rows = np.frombuffer(b"".join(points["vectors"]), exact).reshape(-1, width)[order].astype(np.float64)
            low, high = (np.frombuffer(b"".join(queries[c]), np.uint64) for c in ("low", "high"))
            asker = np.frombuffer(b"".join(queries["entries"]), np.int64)
            asked = np.frombuffer(b"".join(queries["vectors"]), exact).reshape(-1, width).astype(np.float64)
            start, end = np.searchsorted(strings, low), np.searchsorted(strings, high, side="right")
            # Queries with the same stretch of the array are one matrix product.
            for _, part in _by_block(start * (len(strings) + 1) + end):
                for some in np.array_split(part, -(-len(part) // 256)):
                    i, j = start[some[0]], end[some[0]]
                    if i == j:
                        continue
                    scores = asked[some] @ rows[i:j].T
                    for query, row in zip(some, scores, strict=True):
                        best = _best(row, k + 1 + SPARE) + i
                        again = (rows[best] * asked[query]).sum(axis=1)
                        keep = np.lexsort((smallest[best], -again))[: k + 1]
                        found.append((np.full(len(keep), asker[query]), entry[best[keep]], again[keep]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0)] * 3
        return pd.DataFrame({"query": columns[0], "entry": columns[1], "score": columns[2]}).astype(
            {"query": "int64", "entry": "int64", "score": "float64"}
        )

    listed = entries.withColumn("smallest", F.col("ids")[0])
    points = listed.select("vector", "entry", "smallest").mapInArrow(deal_points, _POINT_SCHEMA)
    queries = asking.mapInArrow(deal_queries, _QUERY_SCHEMA)
    points, queries = _in_chunks(points, queries)
    return (
        points.groupBy("block", "chunk")
        .cogroup(queries.groupBy("block", "chunk"))
        .applyInPandas(search, "query long, entry long, score double")
    )


def _in_chunks(points: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Deals the queries of a block that very many ask to chunks, and repeats the block's points, a bounded number, for each."""
    asked = queries.groupBy("block").agg(F.sum(F.octet_length("entries") / 8).alias("n"))
    hot = asked.filter(F.col("n") > BLOCK_QUERIES)
    hot = hot.select("block", F.ceil(F.col("n") / BLOCK_QUERIES).cast("int").alias("chunks"))
    hot = stage(hot, "asked-blocks")  # at most one row for each BLOCK_QUERIES queries
    chunks_of = F.coalesce("chunks", F.lit(1))
    points = points.join(F.broadcast(hot), "block", "left")
    points = points.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks_of - 1))).drop("chunks")
    queries = queries.join(F.broadcast(hot), "block", "left")
    chunk = F.pmod(F.xxhash64("entries"), chunks_of).cast("int")
    return points, queries.withColumn("chunk", chunk).drop("chunks")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = 20,
    effort: float = EFFORT,
    seed: int = 5,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products found for each query.

    ``is_query`` says which rows of ``vectors`` ask; all rows with another id answer. Ties go to the smaller id.
    Vectors that are NULL, empty, zero or hold NULL or non-finite components, and NULL ids, take no part;
    neither do vectors of other than the commonest number of components (of equally common ones the
    smallest). Rows repeated with their id are one. With ``k`` or fewer candidates all are returned; an empty table
    gives an empty result. Other columns are not looked at. All rows are indexed.
    """
    spark = vectors.sparkSession
    fine = vectors.select(
        F.col(vec_id).cast("long").alias("id"), is_query.alias("q"), F.col(embedding).alias("vector")
    ).filter(F.col("id").isNotNull() & _finite(F.col("vector")))
    result = "query_id long, rank int, vec_id long, score double"
    widths = fine.groupBy(F.size("vector").alias("w")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").first()
    if widths is None:
        return spark.createDataFrame([], result)
    width = widths["w"]
    fine = fine.filter(F.size("vector") == width)
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    rows = _entries(fine, F.coalesce("q", F.lit(False)), k).withColumn("length", F.sqrt(square))
    entries = stage(rows, "forest-entries")
    steps = F.log(F.lit(entries.agg(F.max("length")).first()[0])) - F.log("length")
    bucket = F.coalesce(F.floor(steps / float(np.log(RATIO))).cast("int"), F.lit(1 << 20))
    held = entries.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.max("length").alias("longest"))
    lengths = _cut_lengths(sorted(tuple(row) for row in held.collect()))
    exact = np.float32 if entries.schema["vector"].dataType.elementType.simpleString() == "float" else np.float64
    asking = entries.filter("asked").select("vector", "entry")
    met = None
    for first, last, n, longest in lengths:
        some = _search(entries.filter(bucket.between(first, last)), asking, n, longest, width, exact, k, effort, seed)
        met = some if met is None else met.union(some)
    listed = entries.withColumn("smallest", F.col("ids")[0])
    # A vector that several trees find has the same score in each.
    pairs = met.groupBy("query", "entry").agg(F.max("score").alias("score"))
    few = Window.partitionBy("query").orderBy(F.desc("score"), "smallest")
    best = (
        pairs.join(listed.select("entry", "ids", "smallest"), "entry")
        .withColumn("n", F.row_number().over(few))
        .filter(F.col("n") <= k + 1)
    )
    answers = best.select("query", "score", F.explode("ids").alias("vec_id"))
    by_id = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    answers = answers.withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1)
    # Whoever asks: all ids of the entry that are queries.
    keys = [F.xxhash64("vector").alias("k1"), F.xxhash64(F.lit(23), "vector").alias("k2")]
    askers = fine.filter("q").select(F.col("id").alias("query_id"), *keys).distinct()
    askers = askers.join(entries.select("k1", "k2", F.col("entry").alias("query")), ["k1", "k2"])
    final = askers.join(answers.drop("n"), "query").filter("vec_id <> query_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return final.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)

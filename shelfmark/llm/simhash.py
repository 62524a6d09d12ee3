"""SimHash near-duplicates by a grid join over popcounts of segments.

A fingerprint of 64 bits is cut into 16 segments of 4 bits; their popcounts are a point in a grid. One differing
bit moves the point by one step in one direction, so the Manhattan distance of two points is at most the
number of differing bits. Fingerprints that differ in ``d`` bits or fewer therefore meet in a cell that is at
most ``ceil(d / 2)`` steps from one and ``floor(d / 2)`` from the other; here both go ``ceil(d / 2)`` steps. Cells
with few fingerprints are joined with themselves and every pair is verified by its differing bits.

In a crowded cell no pairs are formed: its fingerprints spread to every value that ``floor(d / 2)`` (near) or
``ceil(d / 2)`` (far) flipped bits give. Two values that differ in ``d`` bits or fewer share such a value, one of
them near; and whoever shares one with a near fingerprint differs from it in at most ``d`` bits. Each
value links all its fingerprints to its smallest near one: as many links as rows, no link lost.

The points are bit arithmetic on one long: the popcounts of 16 nibbles lie in the nibbles of a word.

All joins here are merges: Spark sizes a table by the files it comes from, but a fingerprint becomes 33 or 65 rows, and
what is broadcast passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import (
    as_row,
    columns_of,
    free_name,
    from_row,
    in_small_batches,
    read_table,
    stage,
    stage_at,
    text_keys,
    texts_in,
    worker_memory,
)
from shelfmark.llm.components import smallest_reachable
from shelfmark.session import fresh_dir
from shelfmark.sources.storage import drop

SEED = 42
SHINGLE = 3
MAX_BITS = 2
#: Cells with more fingerprints than this are linked through shared values instead of pairs.
PAIRED_CELL = 8
#: Fingerprints that a task spreads to cells or values.
DEALT = 1 << 14


def _hashes(text: bytes, words_per_shingle: int) -> list[int]:
    words = text.lower().split()  # bytes: lowers A-Z only, splits at the six ASCII white-space characters
    if not words:
        return []
    if len(words) <= words_per_shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    shifted = [words[i:] for i in range(words_per_shingle)]
    return [xxhash.xxh64_intdigest(shingle, SEED) for shingle in map(b" ".join, zip(*shifted))]


def _majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    votes = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(part, axis=1, bitorder="little")
        votes += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, words_per_shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of a text; 0 without words."""
    hashes = _hashes(text, words_per_shingle)
    return _majority(np.array(hashes, dtype=np.uint64)) if hashes else 0


def with_fingerprints(
    docs: DataFrame, text: str = "text", name: str = "fingerprint", words_per_shingle: int = SHINGLE
) -> DataFrame:
    """All columns of ``docs`` and the fingerprint as a signed long, in one pass without a shuffle."""
    in_small_batches(docs.sparkSession)
    rows = docs.select(as_row(docs).alias("r"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_memory("simhash")
        for batch in batches:
            texts = texts_in(batch, "r", text).to_pylist()
            found = [fingerprint(t or b"", words_per_shingle) for t in texts]
            signed = pa.array(np.array(found, dtype=np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("r"), signed], names=["r", "f"])

    kinds = rows.select("r").schema.add("f", "long")
    found = rows.mapInArrow(compute, kinds)
    return found.select(*from_row("r", docs), F.col("f").alias(name))


def _bits(pattern: int) -> Column:
    """A mask as a signed long."""
    return F.lit(pattern - (1 << 64) if pattern >> 63 else pattern).cast("long")


def popcounts(fingerprint: Column) -> Column:
    """Popcounts (0 to 4) of the 16 segments, each in its own 4 bits of a long."""
    planes = [F.shiftrightunsigned(fingerprint, bit).bitwiseAND(_bits(0x1111111111111111)) for bit in range(4)]
    return planes[0] + planes[1] + planes[2] + planes[3]


def _steps(cell: Column) -> Column:
    """The cell itself and those one step away, as far as the grid reaches."""
    near = [cell]
    for shift in range(0, 64, 4):
        count, one = F.shiftrightunsigned(cell, shift).bitwiseAND(F.lit(15)), _bits(1 << shift)
        # Adding within a nibble never carries, so XOR with the changed nibble is the sum without overflow.
        up = cell.bitwiseXOR(F.shiftleft(count.bitwiseXOR(count + 1), shift))
        down = cell.bitwiseXOR(F.shiftleft(count.bitwiseXOR(count - 1), shift))
        near += [F.when(count < 4, up), F.when(count > 0, down)]
    return F.filter(F.array(*near), lambda x: x.isNotNull())


def _flips(value: Column) -> Column:
    """The value itself and those that differ from it in one bit."""
    return F.array(value, *[value.bitwiseXOR(_bits(1 << bit)) for bit in range(64)])


def _dealt(values: DataFrame, rows: int) -> DataFrame:
    """Values ``f``, each of which becomes 33 rows or more: as many partitions as ``rows`` of them ask for, not their few bytes.

    They are dealt by a hash: Spark leaves out a second exchange by the column itself and merges the first's partitions.
    """
    return values.repartition(max(1, -(-rows // DEALT)), F.xxhash64("f"))


def _spread(rows: DataFrame, column: str, around, rounds: int) -> DataFrame:
    for _ in range(rounds):
        rows = rows.withColumn(column, F.explode(around(F.col(column))))
    return rows.distinct() if rounds > 1 else rows


def links(
    fingerprints: DataFrame, max_bits: int = MAX_BITS, paired_cell: int = PAIRED_CELL, folder: str | None = None
) -> DataFrame:
    """Links ``a, b`` that join exactly the fingerprints that chains of ``max_bits`` differing bits join.

    ``fingerprints`` has one column ``f`` of distinct longs without NULL. The cells that two or more share are
    staged in ``folder``, which the caller may drop after the links are used.
    """
    far, near = (max_bits + 1) // 2, max_bits // 2
    rows = fingerprints.count()
    fingerprints = _dealt(fingerprints, rows)
    cells = _spread(fingerprints.withColumn("cell", popcounts(F.col("f"))), "cell", _steps, far)
    shared = cells.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    met = stage_at(cells.join(shared.hint("merge"), "cell"), folder or fresh_dir(fingerprints.sparkSession, "simhash-cells"))

    small = met.filter(F.col("n") <= paired_cell)
    left = small.select("cell", F.col("f").alias("a"))
    right = small.select("cell", F.col("f").alias("b"))
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = left.join(right.hint("merge"), "cell").filter((F.col("a") < F.col("b")) & (differing <= max_bits)).select("a", "b")

    crowded = _dealt(met.filter(F.col("n") > paired_cell).select("f").distinct(), rows).withColumn("value", F.col("f"))
    at_far = _spread(crowded, "value", _flips, far)
    at_near = at_far if near == far else _spread(crowded, "value", _flips, near)
    centres = at_near.groupBy("value").agg(F.min("f").alias("a"))
    stars = at_far.join(centres.hint("merge"), "value").filter(F.col("a") != F.col("f")).select("a", F.col("f").alias("b"))
    return pairs.union(stars).distinct()


def groups(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``f, root`` for each distinct fingerprint of a column ``f``: equal roots are linked by chains."""
    distinct = fingerprints.select("f").distinct()
    spark = fingerprints.sparkSession
    folder = fresh_dir(spark, "simhash-cells")
    linked = smallest_reachable(links(distinct, max_bits, folder=folder))
    drop(spark, folder)
    linked = linked.withColumnRenamed("node", "f").hint("merge")
    return distinct.join(linked, "f", "left").select(
        "f", F.coalesce("root", "f").alias("root")
    )


def components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words_per_shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs``.

    ``fingerprint`` is a signed long, ``component_id`` the smallest id that a chain of links reaches. NULL and
    blank texts have fingerprint 0 and are linked like others. Repeated rows appear as often as they do in
    ``docs``. A NULL id stays NULL and is never the smallest, unless a component has no other. Other columns
    are not looked at. Texts are read once and not shuffled; later steps see 16 bytes a row.
    """
    seen = with_fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")), "t", "f", words_per_shingle)
    seen = stage(seen.select("doc_id", "f"), "simhash-fingerprints")
    smallest = seen.groupBy("f").agg(F.min("doc_id").alias("first"))
    grouped = stage(groups(seen, max_bits), "simhash-groups")
    by_root = grouped.join(smallest.hint("merge"), "f").groupBy("root").agg(F.min("first").alias("component_id"))
    named = grouped.join(by_root.hint("merge"), "root").select("f", "component_id")
    return seen.join(named.hint("merge"), "f").select("doc_id", F.col("f").alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words_per_shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row of smallest id, NULL last.

    Of repeated rows exactly one stays. Extra columns are kept whatever their names.
    """
    k1, k2 = free_name(docs, "k1"), free_name(docs, "k2")
    keys = text_keys(F.col(doc_id), F.col(text))
    seen = with_fingerprints(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"), *keys), "t", "f", words_per_shingle)
    seen = stage(seen.select("f", "id", "k1", "k2"), "simhash-rows")
    # The row of smallest id per fingerprint, then per component: reduced before each shuffle.
    order = F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")
    firsts = seen.groupBy("f").agg(F.min(order).alias("first"))
    grouped = groups(firsts, max_bits)
    kept = grouped.join(firsts.hint("merge"), "f").groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.k1").alias(k1), F.col("first.k2").alias(k2))
    # Rows of one id and text: each task lets one through, then one of those stays. The join meets them where they are.
    place, number = Window.partitionBy(k1, k2).orderBy(k1), free_name(docs, "n")
    keyed = docs.withColumns({k1: keys[0], k2: keys[1]}).withColumn(number, F.row_number().over(place))
    single = keyed.filter(F.col(number) == 1)
    return single.join(kept.hint("merge"), [k1, k2], "left_semi").select(*columns_of(docs))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")

"""Packing documents into sequences of fixed length by cutting stock.

A document's whole sequences are cut off from its start; the remainder, shorter than a sequence, is one piece.
The histogram of remainder lengths goes to a cutting-stock program (:mod:`shelfmark.llm.cutting`), whose
patterns say which lengths share a sequence. Remainders of one length are numbered, and the numbers tell each its
pattern, sequence and place. The few that no tight pattern takes are laid end to end and cut at sequence
ends; the end of that stretch goes to sequences of powers of two, which need no padding.

Numbering needs no sort and no shuffle of documents: every task numbers the remainders of each length that it
meets, and the counts per task and length, added up, give where each task's numbers begin.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.bpe import encoder
from shelfmark.llm.common import chunks, in_small_batches, read_table, stage
from shelfmark.llm.cutting import whole_patterns

SEQUENCE = 1024
END_ID = 0
BYTE_BPE = "byte_bpe_50k.json"

_MEASURED = (
    "doc_id {kind}, doc_tokens long, whole_crc32 array<long>, rest int, rest_crc32 long, rest_ids binary, "
    "part int, number long, whole_before long"
)


def _measure(path: str, sequence: int, end_id: int) -> Callable:
    """Per document: length, checksums of its whole sequences and its remainder, and the task's numbering."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        part = TaskContext.get().partitionId()
        numbers, whole = Counter(), 0
        for batch in batches:
            rows = []
            for texts in chunks(batch.column("t").to_pylist(), empty=""):
                for raw in code.encode(texts):
                    ids = np.concatenate([np.frombuffer(raw, code.dtype), np.array([end_id], code.dtype)]).astype("<u4")
                    cut = len(ids) // sequence * sequence
                    crcs = [zlib.crc32(ids[i : i + sequence].tobytes()) for i in range(0, cut, sequence)]
                    rest = ids[cut:]
                    size = len(rest)
                    rows.append(
                        (
                            len(ids),
                            crcs,
                            size,
                            zlib.crc32(rest.tobytes()),
                            rest.astype(code.dtype).tobytes(),
                            part,
                            numbers[size],
                            whole,
                        )
                    )
                    numbers[size] += 1
                    whole += len(crcs)
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            names = "doc_tokens whole_crc32 rest rest_crc32 rest_ids part number whole_before".split()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *names])

    return run


@dataclass
class _Places:
    """Per remainder length: numbers from ``first`` on lie in sequences from ``sequence`` on, at ``offset``.

    A negative offset stands for the stretch that is cut: ``sequence`` is then where in it the numbers begin.
    """

    first: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)


@dataclass
class _Stretch:
    """Remainders laid end to end and cut into ``whole`` sequences of full length and some of powers of two."""

    sequence: int
    whole: int
    tail: list[int]

    def cut(self, at: int) -> tuple[int, int, int]:
        """The sequence that holds a place of the stretch, by number, and where it starts and ends."""
        number = at // self.sequence
        if number < self.whole:
            return number, number * self.sequence, (number + 1) * self.sequence
        start = self.whole * self.sequence
        for number, size in enumerate(self.tail, self.whole):
            if at < start + size:
                break
            start += size
        return number, start, start + size


def _plan(histogram: dict[int, int], base: int, sequence: int) -> tuple[dict[int, _Places], _Stretch, int]:
    """Places of all remainders, the stretch that is cut, and the first cut sequence."""
    lengths = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[size] for size in lengths.tolist()], np.int64)
    patterns, left = whole_patterns(lengths, demand, sequence)
    places = {size: _Places() for size in lengths.tolist()}
    given = Counter()

    def give(size: int, times: int, sequence_id: int, offset: int) -> None:
        held = places[size]
        held.first.append(given[size])
        held.sequence.append(sequence_id)
        held.offset.append(offset)
        given[size] += int(times)

    for pattern, times in patterns:
        offset = 0
        for i, count in pattern.items():
            for _ in range(count):
                give(int(lengths[i]), times, base, offset)
                offset += int(lengths[i])
        base += times
    stretch = 0
    for size, times in zip(lengths.tolist(), left.tolist(), strict=True):
        if times:
            give(size, times, stretch, -1)
            stretch += size * times
    whole, tail = divmod(stretch, sequence)
    tails = [1 << bit for bit in reversed(range(tail.bit_length())) if tail >> bit & 1]
    return places, _Stretch(sequence, whole, tails), base


def _place(places: dict[int, _Places], stretch: _Stretch, cut_base: int, dtype: np.dtype) -> Callable:
    """Pieces of the remainders; ``rest_ids`` is NULL but for those to be cut."""
    # One sorted table for all lengths: a length and a number make one key.
    order = sorted(places)
    keys = np.concatenate([np.array(places[size].first, np.int64) + (size << 42) for size in order] or [[]]).astype(np.int64)
    sequence = np.concatenate([places[size].sequence for size in order] or [[]]).astype(np.int64)
    offset = np.concatenate([places[size].offset for size in order] or [[]]).astype(np.int64)
    names = "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()

    def cut_piece(row: int, doc_tokens: int, size: int, raw: bytes, begin: int) -> Iterator[tuple]:
        """The pieces of a remainder that lies at ``begin`` of the stretch."""
        ids = np.frombuffer(raw, dtype).astype("<u4")
        done = 0
        while done < size:
            number, start, end = stretch.cut(begin + done)
            take = min(size - done, end - begin - done)
            crc = zlib.crc32(ids[done : done + take].tobytes())
            yield row, doc_tokens - size + done, take, crc, doc_tokens, cut_base + number, begin + done - start
            done += take

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("rest").to_numpy().astype(np.int64)
            tokens, crc = batch.column("doc_tokens").to_numpy(), batch.column("rest_crc32").to_numpy()
            key = (size << 42) + batch.column("rank").to_numpy()
            at = np.searchsorted(keys, key, side="right") - 1
            within = key - keys[at]
            cut = offset[at] < 0
            whole = np.flatnonzero(~cut)
            found = [whole, tokens - size, size, crc, tokens, sequence[at] + within, offset[at]]
            found = [found[0], *(column[whole] for column in found[1:])]
            begin = sequence[at] + within * size
            pieces = [
                piece
                for row in np.flatnonzero(cut).tolist()
                for piece in cut_piece(
                    row, int(tokens[row]), int(size[row]), batch.column("rest_ids")[row].as_py(), int(begin[row])
                )
            ]
            if pieces:
                more = np.array(pieces, np.int64).T
                found = [np.concatenate(pair) for pair in zip(found, more, strict=True)]
            ids = batch.column("doc_id").take(pa.array(found[0]))
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, found[1:])], names=names)

    return run


def pack(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Each document's ids (of the tokenizer at ``path``, no special tokens added, then ``end_id``) lie in exactly one
    piece each; ``start`` counts the document's ids before the piece, ``offset`` the sequence's ids before it.
    Sequences are numbered without gaps; at most one document is cut at a sequence's end and only for lack of
    a tight pattern, or if it is longer than a sequence. A NULL or empty text has one id, its end. Repeated
    rows are packed each for itself; NULL ids stay NULL. Other columns are not looked at.
    The driver sees counts per length, patterns and fills with their multiplicity: their number depends on ``sequence``
    alone.
    """
    spark = docs.sparkSession
    in_small_batches(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    measured = stage(rows.mapInArrow(_measure(path, sequence, end_id), _MEASURED.format(kind=kind)), "pack-measured")
    counts = measured.groupBy("part", "rest").agg(F.count("*").alias("n"))
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = stage(counts.withColumn("begin", F.coalesce(F.sum("n").over(before), F.lit(0))), "pack-counts")
    histogram = {r["rest"]: r["n"] for r in begins.groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    histogram.pop(0, None)

    # Whole sequences come first, in order of tasks.
    whole = measured.groupBy("part").agg(F.sum(F.size("whole_crc32")).cast("long").alias("n"))
    whole = whole.withColumn(
        "whole_begin",
        F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    total = whole.agg(F.sum("n")).first()[0] or 0
    places, stretch, cut_base = _plan(histogram, total, sequence)
    columns = "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    spans = measured.filter(F.size("whole_crc32") > 0).select(
        "doc_id", "doc_tokens", "part", "whole_before", F.posexplode("whole_crc32").alias("k", "ids_crc32")
    )
    full = spans.join(whole, "part").select(
        "doc_id",
        (F.col("k").cast("long") * sequence).alias("start"),
        F.lit(sequence).cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        (F.col("whole_begin") + F.col("whole_before") + F.col("k")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    # Ids travel only with remainders that are cut; whether one is depends on its length and number.
    bounds = [
        (size, p.first[i])
        for size, p in places.items()
        for i in range(len(p.first))
        if p.offset[i] < 0
    ]
    cut_from = spark.createDataFrame(bounds, "rest int, cut_from long")
    rests = (
        measured.filter("rest > 0")
        .join(begins.select("part", "rest", "begin"), ["part", "rest"])
        .withColumn("rank", F.col("begin") + F.col("number"))
        .join(F.broadcast(cut_from), "rest", "left")  # at most a row per length
        .withColumn("rest_ids", F.when(F.col("rank") >= F.col("cut_from"), F.col("rest_ids")))
        .select("doc_id", "doc_tokens", "rest", "rest_crc32", "rest_ids", "rank")
    )
    dtype = encoder(path).dtype
    pieces = rests.mapInArrow(_place(places, stretch, cut_base, dtype), schema)
    return full.select(*columns).union(pieces.select(*columns))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))

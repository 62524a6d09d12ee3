"""Token ids in files: one zstandard frame per document, with a dictionary that all documents share.

A folder holds ``dictionary`` (its bytes and their sha256) and ``blocks``, Parquet rows in ascending order of ids.
A block is some documents in a row: their frames, one after the other, and an index of offsets, so that one
short document is read by decompressing its own frame only. Each block names the dictionary it needs. Spark's
writers and readers move the files, so the folder may be in any store that Spark reaches.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.bpe import encoder
from shelfmark.llm.common import chunks, in_small_batches, read_table
from shelfmark.session import fresh_dir

BYTE_BPE = "byte_bpe_50k.json"
END_ID = 0
LEVEL = 1
DICTIONARY_BYTES = 1 << 16
#: The dictionary is trained on this many documents at most, of this many bytes at most each.
SAMPLE_ROWS = 2000
SAMPLE_BYTES = 1 << 14
#: A block ends after so many documents or bytes.
BLOCK_ROWS = 512
BLOCK_BYTES = 1 << 20


def _ids(texts: Sequence[str], path: str, end_id: int) -> list[bytes]:
    """Serialized ids of each text, with the end."""
    code = encoder(path)
    end = np.array([end_id], code.dtype).tobytes()
    return [raw + end for raw in code.encode(texts)]


def train_dictionary(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID
) -> bytes:
    """A dictionary from the serialized ids of up to SAMPLE_ROWS documents, those of smallest hash of the id.

    Texts beyond SAMPLE_BYTES are not sampled: the dictionary is for documents too short to have a context of
    their own. Where the sample is too small to train on, it is the dictionary itself; it may be empty.
    """
    keyed = docs.select(F.xxhash64(doc_id).alias("h"), F.col(text).alias("t"))
    # SAMPLE_ROWS hashes, found without reading texts; repeated ids count once.
    chosen = keyed.select("h").distinct().orderBy("h").limit(SAMPLE_ROWS)
    short = keyed.filter(F.col("t").isNotNull() & (F.col("t") != "") & (F.octet_length("t") <= SAMPLE_BYTES))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch.column("t").to_pylist(), path, end_id)
            yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(ids, pa.binary())], names=["h", "ids"])

    sampled = short.join(F.broadcast(chosen), "h", "left_semi").dropDuplicates(["h"]).select("t", "h")
    rows = sampled.mapInArrow(encode, "h long, ids binary").collect()
    samples = [bytes(r["ids"]) for r in sorted(rows, key=lambda r: r["h"])]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def _shared(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def write_tokens(
    docs: DataFrame, folder: str, path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID
) -> None:
    """The ids of all texts (tokenizer at ``path``, no special tokens added, then ``end_id``) into ``folder``.

    Documents are in ascending order of ids, NULL ids last, equal ids as they come. A NULL or empty text has
    one id, its end. Repeated rows are written as often as they occur, an empty table gives files without
    blocks. Texts are dealt to tasks by ranges of ids; each task sorts and writes its range. Other columns
    are not looked at.
    """
    spark = docs.sparkSession
    in_small_batches(spark)
    dictionary = train_dictionary(docs, path, doc_id, text, end_id)
    digest = hashlib.sha256(dictionary).hexdigest()
    width = encoder(path).dtype.itemsize
    spark.createDataFrame([(digest, bytearray(dictionary), width)], "dict_hash string, bytes binary, width int").coalesce(
        1
    ).write.parquet(f"{folder}/dictionary")
    shared = spark.sparkContext.broadcast(dictionary)
    # The tie lets many rows of one id lie in several ranges; to find the ranges no text is read.
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("t"), F.monotonically_increasing_id().alias("tie")
    )
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie").asc()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=_shared(shared.value)).compress
        part = TaskContext.get().partitionId()
        number, before = 0, 0
        ids, frames, sizes = [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal number, before
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])])
            values = [
                pa.array([part], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([before], pa.int64()),
                pa.array([digest], pa.string()),
                pa.array([[i.as_py() for i in ids]], pa.list_(ids[0].type)),
                pa.array([offsets.tolist()], pa.list_(pa.int64())),
                pa.array([sizes], pa.list_(pa.int64())),
                pa.array([b"".join(frames)], pa.binary()),
            ]
            names = "part block before dict_hash doc_ids offsets n_tokens frames".split()
            number += 1
            before += sum(sizes)
            out = pa.RecordBatch.from_arrays(values, names=names)
            for held in (ids, frames, sizes):
                held.clear()
            return out

        held_bytes = 0
        for batch in batches:
            names, done = batch.column("doc_id"), 0
            for texts in chunks(batch.column("t").to_pylist(), empty=""):
                for raw in _ids(texts, path, end_id):
                    frame = pack(raw)
                    ids.append(names[done])
                    frames.append(frame)
                    sizes.append(len(raw) // width)
                    done += 1
                    held_bytes += len(frame)
                    if len(ids) >= BLOCK_ROWS or held_bytes >= BLOCK_BYTES:
                        yield flush()
                        held_bytes = 0
        if ids:
            yield flush()

    kind = rows.schema["doc_id"].dataType.simpleString()
    blocks = ordered.mapInArrow(
        run,
        f"part int, block int, before long, dict_hash string, doc_ids array<{kind}>, offsets array<long>, "
        "n_tokens array<long>, frames binary",
    )
    # The ends of the ids are columns of their own: Parquet's statistics on them find a document's block.
    indexed = blocks.withColumns({"first_id": F.col("doc_ids")[0], "last_id": F.element_at("doc_ids", -1)})
    # Frames are compressed already.
    indexed.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def _dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes, int]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    if hashlib.sha256(bytes(row["bytes"])).hexdigest() != row["dict_hash"]:
        raise ValueError(f"the dictionary in {folder} is damaged")
    return row["dict_hash"], bytes(row["bytes"]), row["width"]


def _decoded(spark: SparkSession, folder: str, blocks: DataFrame, chosen: list | None, what: str) -> DataFrame:
    """Per document of the blocks its place in its part, its length, and ``what`` of its ids: crc32 or ids."""
    digest, dictionary, width = _dictionary(spark, folder)
    shared = spark.sparkContext.broadcast(dictionary)
    wanted = None if chosen is None else set(chosen)
    dtype = np.dtype("<u2" if width == 2 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor(dict_data=_shared(shared.value)).decompress
        for batch in batches:
            for block in range(batch.num_rows):
                if batch.column("dict_hash")[block].as_py() != digest:
                    raise ValueError("a block was written with another dictionary")
                frames = memoryview(batch.column("frames")[block].as_buffer())
                offsets = batch.column("offsets")[block].as_py()
                sizes = batch.column("n_tokens")[block].as_py()
                names = batch.column("doc_ids")[block].values
                starts = batch.column("before")[block].as_py() + np.concatenate([[0], np.cumsum(sizes)])
                rows = [i for i in range(len(sizes)) if wanted is None or names[i].as_py() in wanted]
                found = []
                for i in rows:
                    ids = np.frombuffer(unpack(frames[offsets[i] : offsets[i + 1]]), dtype).astype("<u4")
                    if len(ids) != sizes[i]:
                        raise ValueError("a frame has another length than the index says")
                    found.append(zlib.crc32(ids.tobytes()) if what == "crc32" else ids.tolist())
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            names.take(pa.array(rows, pa.int64())),
                            pa.array([batch.column("part")[block].as_py()] * len(rows), pa.int32()),
                            pa.array(starts[rows], pa.int64()),
                            pa.array([sizes[i] for i in rows], pa.int64()),
                            pa.array(found, pa.int64() if what == "crc32" else pa.list_(pa.int64())),
                        ],
                        names=["doc_id", "part", "within", "n_tokens", "found"],
                    )

    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    result = "long" if what == "crc32" else "array<long>"
    return blocks.mapInArrow(run, f"doc_id {kind}, part int, within long, n_tokens long, found {result}")


def read_tokens(spark: SparkSession, folder: str, what: str = "ids") -> DataFrame:
    """``doc_id, start, n_tokens`` and ``ids`` (or ``crc32`` of them) of all documents.

    ``start`` counts the ids of all documents before, over all files.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    tokens = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    totals = blocks.groupBy("part").agg(F.sum(tokens).alias("tokens"))
    # One row per file.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = totals.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("begin"))
    return (
        _decoded(spark, folder, blocks, None, what)
        .join(begins, "part")
        .select("doc_id", (F.col("begin") + F.col("within")).alias("start"), "n_tokens", F.col("found").alias(what))
    )


def read_documents(spark: SparkSession, folder: str, doc_ids: Sequence) -> DataFrame:
    """``doc_id, ids`` of a few documents: reads the blocks that may hold them and decompresses their frames only."""
    if not doc_ids:
        return read_tokens(spark, folder).select("doc_id", "ids").limit(0)
    blocks = spark.read.parquet(f"{folder}/blocks")
    near = F.lit(False)
    for one in doc_ids:
        near = near | ((F.col("first_id") <= one) & (F.col("last_id") >= one))
    near = near | F.col("last_id").isNull()  # a block that ends in NULL ids
    found = _decoded(spark, folder, blocks.filter(near), list(doc_ids), "ids")
    return found.select("doc_id", F.col("found").alias("ids"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(spark, "token-files")
    write_tokens(read_table(spark, sf_dir, "documents"), folder, public_tokenizers.path(BYTE_BPE))
    read = read_tokens(spark, folder, "crc32")
    return read.select("doc_id", "start", "n_tokens", F.col("crc32").alias("ids_crc32"))

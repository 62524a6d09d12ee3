"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import fresh_dir

#: A word: a run of characters other than the six white-space characters of ASCII.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a Python worker looks at together.
CHUNK_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows and bytes that cross between the JVM and Python together: texts are long.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def in_small_batches(spark: SparkSession) -> None:
    """Let rows cross to Python in batches that fit beside the heap of an executor, here and in what follows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_HELD: dict[str, dict] = {}


def worker_memory(owner: str) -> dict:
    """What ``owner`` remembers in this Python worker from task to task.

    Workers serve many stages: whatever another owner left is dropped.
    """
    for other in [name for name in _HELD if name != owner]:
        del _HELD[other]
    return _HELD.setdefault(owner, {})


def texts_in(batch: pa.RecordBatch, row: str, text: str) -> pa.Array:
    """The texts, as bytes, out of whole rows in a struct column: they cross once."""
    return pc.struct_field(batch.column(row), [batch.schema.field(row).type.get_field_index(text)]).cast(pa.binary())


def stage(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: later steps don't compute them again."""
    return stage_at(df, fresh_dir(df.sparkSession, label))


def stage_at(df: DataFrame, path: str) -> DataFrame:
    """As :func:`stage`, into a folder that the caller drops when nothing reads it any more."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_keys(doc_id: Column, text: Column) -> list[Column]:
    """128 bits, ``k1`` and ``k2``, that rows share only if their ids and texts are equal."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(17), doc_id, F.length(text), text).alias("k2")]


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names hold."""
    return [F.col(f"`{name.replace('`', '``')}`") for name in df.columns]


def as_row(df: DataFrame) -> Column:
    """All columns in one struct: inside it no name can clash with those of an operator."""
    return F.struct(*columns_of(df))


def from_row(row: str, df: DataFrame) -> list[Column]:
    """The columns of ``df`` out of a struct made by :func:`as_row`."""
    return [F.col(row).getField(name).alias(name) for name in df.columns]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as it takes to differ from every column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def chunks(texts: Iterable[bytes | str | None], limit: int = CHUNK_BYTES, empty: bytes | str = b"") -> Iterator[list]:
    """The texts in order, in lists of about ``limit`` bytes; a longer text is a list of its own. NULL is ``empty``."""
    found, size = [], 0
    for text in texts:
        text = text or empty
        if found and size + len(text) > limit:
            yield found
            found, size = [], 0
        found.append(text)
        size += len(text)
    if found:
        yield found

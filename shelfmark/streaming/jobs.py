"""Running a stream until its input is used up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelfmark.sources.files import is_folder

BATCH_BYTES = 4 * 1024**3
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_files(
    spark: SparkSession, folder: str, name: str, per_batch: int | None = None
) -> DataFrame:
    """Stream of the parquet files of a folder whose names match. If ``name`` is itself a folder, of the files in it.

    A micro-batch takes in about BATCH_BYTES, or ``per_batch`` files. This bounds what one key can bring
    into one task.
    """
    options = {"pathGlobFilter": name}
    if is_folder(spark, f"{folder}/{name}"):
        folder, options = f"{folder}/{name}", {}
    schema = spark.read.options(**options).parquet(folder).schema
    reader = spark.readStream.schema(schema).options(**options)
    if per_batch is None:
        reader = reader.option("maxBytesPerTrigger", BATCH_BYTES)
    else:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(folder)


def write_stream(
    stream: DataFrame, path: str, checkpoint: str, output_mode: str = "append"
) -> StreamingQuery:
    """Start a stream into a parquet folder and take in all input that is there now.

    State is kept in RocksDB, so that it need not fit into the memory of the executors.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return (
        stream.writeStream.format("parquet")
        .outputMode(output_mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def each_batch(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

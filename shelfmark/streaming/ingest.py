"""Idempotent ingestion of records that may be delivered more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelfmark.operators.records import is_valid_record
from shelfmark.plans.record_intake import records_to_append
from shelfmark.schemas import SAVED_RECORD
from shelfmark.sources import record_log
from shelfmark.sources.storage import empty
from shelfmark.streaming.jobs import each_batch


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The record log that :func:`ingest_records` writes."""
    paths = record_log.data_paths(spark, path)
    return spark.read.schema(SAVED_RECORD).parquet(*paths) if paths else empty(spark, SAVED_RECORD)


def ingest_records(stream: DataFrame, path: str, checkpoint: str, *order: str) -> StreamingQuery:
    """Append the valid records of a stream whose id is new; the first one in ``order`` wins.

    Ids are looked up beside the log, in their own buckets, so they are remembered for ever, across restarts and lost
    checkpoints, and whoever else appends. A batch that is run again after a failure appends only what is still
    missing.
    """

    def handle(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        first = records_to_append(batch, f"{checkpoint}-incoming", *order)
        record_log.append_new(
            first, path, lambda df, folder: df.write.parquet(folder), lambda old: spark.read.schema(SAVED_RECORD).parquet(*old)
        )

    return each_batch(stream, handle, checkpoint)


def distinct_records(stream: DataFrame, arrived: str | None = None, retention: str = "7 days") -> DataFrame:
    """Valid records, one per id, deduplicated in the state store.

    Of copies within one micro-batch any may be the one. With ``arrived``, a timestamp column, an id is
    forgotten after ``retention``, which bounds the state.
    """
    valid = stream.where(is_valid_record())
    if arrived is None:
        return valid.dropDuplicates(["id"])
    return valid.withWatermark(arrived, retention).dropDuplicatesWithinWatermark(["id"])

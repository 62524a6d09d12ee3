"""From cart events to the record log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.cart import (
    NESTED_LINES,
    as_records,
    build_records,
    record_lines,
    submitted_lines,
)
from shelfmark.operators.numbering import parts_for
from shelfmark.operators.records import dedupe_records, stamp, validate_records
from shelfmark.schemas import SAVED_RECORD
from shelfmark.session import fresh_dir
from shelfmark.sources import record_log
from shelfmark.sources.documents import BODY, append_records, read_records
from shelfmark.sources.files import drop
from shelfmark.sources.storage import empty

LOG = "records"
LARGE = "record_lines"
LINE = (
    "id string, person string, submitted_at timestamp_ntz, line_no bigint, barcode string, name string, qty bigint, "
    "added_at timestamp_ntz"
)


def read_log(spark: SparkSession, root: str) -> DataFrame:
    return read_records(spark, record_log.data_paths(spark, f"{root}/{LOG}"))


def read_large(spark: SparkSession, root: str) -> DataFrame:
    """The lines of the records that are too large for a document, with their places."""
    paths = record_log.data_paths(spark, f"{root}/{LARGE}")
    return spark.read.schema(LINE).parquet(*paths) if paths else empty(spark, LINE)


def records_to_append(records: DataFrame, staged: str, *order: str) -> DataFrame:
    """The valid records, first of every id in ``order``, stamped, in a folder, so that they are computed once."""
    spark = records.sparkSession
    valid, _ = validate_records(records)
    body = [BODY] if BODY in records.columns else []
    first = stamp(dedupe_records(valid, *order)).select(*SAVED_RECORD.fieldNames(), *body)
    first.write.mode("overwrite").parquet(staged)
    return spark.read.schema(first.schema).parquet(staged)


def save_records(records: DataFrame, root: str, *order: str) -> None:
    """Append the valid records that the log does not hold yet. Several writers may do so at once."""
    spark = records.sparkSession
    staged = fresh_dir(spark, "incoming-records")
    first = records_to_append(records, staged, *order)
    record_log.append_new(first, f"{root}/{LOG}", append_records, lambda path: read_records(spark, path))
    drop(spark, staged)


def submit_carts(events: DataFrame, products: DataFrame, root: str, most: int = NESTED_LINES) -> None:
    """Save a record for every submit of a cart that holds something.

    Records of up to ``most`` lines are documents of the log. Larger ones are kept as numbered lines, so no row
    grows with the record.
    """
    spark = events.sparkSession
    staged = fresh_dir(spark, "submitted-lines")
    submitted_lines(events, products).write.parquet(f"{staged}/lines")
    lines = spark.read.parquet(f"{staged}/lines")
    parts = parts_for(spark, lines.count())
    large = lines.groupBy("record_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("record_id")
    if not large.isEmpty():
        numbered = record_lines(lines.join(large, "record_id", "left_semi"))
        rows = numbered.withColumn("id", F.col("record_id").cast("string"))
        rows.select(*[field.split()[0] for field in LINE.split(", ")]).write.parquet(f"{staged}/large")
        rows = spark.read.schema(LINE).parquet(f"{staged}/large")
        record_log.append_new(rows, f"{root}/{LARGE}", lambda df, path: df.write.parquet(path))
        lines = lines.join(large, "record_id", "left_anti")
    save_records(as_records(build_records(lines, parts)), root, "submittedAt")
    drop(spark, staged)

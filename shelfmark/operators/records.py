"""Stock records: validation, first-wins deduplication, idempotent append and the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import minute_text, trimmed
from shelfmark.operators.delta import unseen
from shelfmark.operators.products import first_per_key


def is_valid_record() -> Column:
    """Whether a record has an id, a person and items. Never NULL."""
    complete = (F.col("id") != "") & (trimmed("person") != "") & (F.size("items") > 0)
    return F.coalesce(complete, F.lit(False))


def validate_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected records."""
    return records.where(is_valid_record()), records.where(~is_valid_record())


def dedupe_records(records: DataFrame, *order: str) -> DataFrame:
    """The first record of every id in the order of arrival."""
    return first_per_key(records, "id", F.struct(*order))


def append_idempotent(new: DataFrame, log: DataFrame, *order: str) -> DataFrame:
    """The new records to append: the first of every id that the log does not hold yet."""
    return unseen(dedupe_records(new, *order), log, ["id"])


def with_duplicate_flag(new: DataFrame, log: DataFrame, seq: str) -> DataFrame:
    """Every new record with ``duplicate``: whether its id was taken when it came.

    ``seq`` is unique and counts up with arrival.
    """
    firsts = new.groupBy("id").agg(F.min(seq).alias("_seq"))
    appended = unseen(firsts, log, ["id"]).select("_seq")
    joined = new.join(appended, new[seq] == appended["_seq"], "left")
    return joined.withColumn("duplicate", F.col("_seq").isNull()).drop("_seq")


def merge_pending(saved: DataFrame, pending: DataFrame, *order: str) -> DataFrame:
    """Saved records and those that waited for a retry, one per id; the saved one wins."""
    both = saved.withColumn("_source", F.lit(0)).unionByName(pending.withColumn("_source", F.lit(1)))
    return dedupe_records(both, "_source", *order).drop("_source")


def with_random_id(records: DataFrame) -> DataFrame:
    """Adds a random ``id``. Write the result before it is used twice: every run draws new ids."""
    return records.withColumn("id", F.uuid())


def stamp(records: DataFrame) -> DataFrame:
    """Adds the time of saving."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return records.withColumn("savedAt", F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))


def records_report(records: DataFrame, zone: str = "UTC") -> DataFrame:
    """Records newest first, with a minute time and the items as one text."""
    tags = F.transform(
        "items", lambda item: F.concat(item["name"], F.lit(" ×"), item["qty"].cast("string"))
    )
    return records.orderBy(F.desc("submittedAt"), "id").select(
        "id",
        "person",
        minute_text(F.col("submittedAt"), zone).alias("submitted"),
        F.size("items").alias("n_items"),
        F.array_join(tags, ", ").alias("items_text"),
    )

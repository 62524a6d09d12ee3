"""Products entered by hand: cleaned, stamped, checked and stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.products import clean_products, insert_if_absent, quality_limits
from shelfmark.session import fresh_dir
from shelfmark.sources.storage import drop, empty, exists
from shelfmark.schemas import CUSTOM_LIST

CUSTOM = "custom_products"


def custom_products(spark: SparkSession, root: str) -> DataFrame:
    """The products entered so far, in order of ``seq``."""
    path = f"{root}/{CUSTOM}"
    return spark.read.schema(CUSTOM_LIST).parquet(path) if exists(spark, path) else empty(spark, CUSTOM_LIST)


def enter_products(entered: DataFrame, catalog: DataFrame, root: str) -> dict[str, int]:
    """Append the entries whose barcode neither the catalog nor the list holds; counts by outcome.

    ``entered`` has ``name, barcode, person, millis`` and a unique ``seq`` in order of entry. Of entries with one
    barcode the first wins. Entries without a name and over-long ones are refused, as by the form.
    """
    spark = entered.sparkSession
    flagged = quality_limits(entered)
    fits = ~(F.col("name_too_long") | F.col("barcode_too_long") | F.col("person_too_long"))
    cleaned = clean_products(flagged.where(fits))
    taken = catalog.select("barcode").unionByName(custom_products(spark, root).select("barcode"))
    # Written before it is appended to the list that it was compared with.
    staged = fresh_dir(spark, "entered-products")
    insert_if_absent(cleaned, taken).write.parquet(staged)
    checked = spark.read.parquet(staged)
    counts = {row["status"]: row["count"] for row in checked.groupBy("status").count().collect()}
    new = checked.where(F.col("status") == "inserted").select(*CUSTOM_LIST.fieldNames())
    new.write.mode("append").parquet(f"{root}/{CUSTOM}")
    drop(spark, staged)
    return counts

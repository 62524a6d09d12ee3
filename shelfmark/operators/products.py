"""Catalog merge and the entry of new products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.text import blank_to_null, custom_barcode, iso_text

# Lengths that the entry forms accept.
FIELD_LIMITS = {"person": 40, "name": 120, "barcode": 60}


def first_per_key(df: DataFrame, key: str, order: Column) -> DataFrame:
    """The row with the smallest ``order`` of every key; any one of those that tie.

    Spark limits the window's groups to their first row in every input task, before the one shuffle, so a key with
    very many copies sends one row a task. Rows are sorted, which spills; no aggregate holds them whole.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.struct(order)))
    return df.withColumn("_place", place).where(F.col("_place") == 1).select(*df.columns)


def merge_catalog(catalog: DataFrame, custom: DataFrame) -> DataFrame:
    """Catalog and custom products by barcode.

    The catalog beats custom products; the last of equal catalog barcodes wins and the first of equal
    custom ones. ``origin`` and ``seq`` tell the place in the merged list: the first occurrence of the
    barcode. Both inputs bring a ``seq``.
    """
    plain = ("created_by", "created_at")
    catalog_rows = catalog.select(
        "barcode", "name", F.lit("catalog").alias("source"),
        *[F.lit(None).cast("string").alias(c) for c in plain],
        F.lit(0).alias("origin"), "seq", (-F.col("seq") - 1).alias("rank"),
    )
    custom_rows = custom.select(
        "barcode", "name", F.lit("custom").alias("source"), *plain,
        F.lit(1).alias("origin"), "seq", F.col("seq").alias("rank"),
    )
    # The place comes from another row than the name, so no window's first row will do; products are a few short texts.
    merged = (
        catalog_rows.unionByName(custom_rows)
        .groupBy("barcode")
        .agg(
            F.min_by(F.struct("name", "source", *plain), F.struct("origin", "rank")).alias("product"),
            F.min(F.struct("origin", "seq")).alias("place"),
        )
    )
    return merged.select("barcode", "product.*", "place.origin", "place.seq")


def insert_if_absent(new: DataFrame, existing: DataFrame) -> DataFrame:
    """New products with a ``status``: 'inserted', or 'duplicate' when the barcode is already taken.

    Barcodes are taken by existing products and by new ones with a smaller ``seq``.
    """
    # Joins run on one row per barcode, then on the unique seq, never on the raw barcodes.
    firsts = new.groupBy("barcode").agg(F.min("seq").alias("seq")).alias("firsts")
    taken = existing.select("barcode").distinct().alias("taken")
    inserted = firsts.join(
        taken, F.col("firsts.barcode") == F.col("taken.barcode"), "left_anti"
    ).select(F.col("seq").alias("inserted_seq"))
    status = F.when(F.col("inserted_seq").isNotNull(), "inserted").otherwise("duplicate")
    return (
        new.join(inserted, new["seq"] == inserted["inserted_seq"], "left")
        .withColumn("status", status)
        .drop("inserted_seq")
    )


def clean_products(entered: DataFrame) -> DataFrame:
    """Products as entered (``name, barcode, person, millis``) to custom products; nameless ones go.

    ``millis`` is the time of entry. A ``seq`` of the entries is kept.
    """
    at = F.to_utc_timestamp(F.timestamp_millis("millis"), F.current_timezone())
    kept = ["seq"] if "seq" in entered.columns else []
    return entered.select(
        F.coalesce(blank_to_null(F.col("barcode")), custom_barcode(F.col("millis"))).alias("barcode"),
        blank_to_null(F.col("name")).alias("name"),
        F.lit("custom").alias("source"),
        blank_to_null(F.col("person")).alias("created_by"),
        iso_text(at).alias("created_at"),
        *kept,
    ).where(F.col("name").isNotNull())


def quality_limits(df: DataFrame) -> DataFrame:
    """A ``<field>_too_long`` flag for every limited field the rows have."""
    for name, limit in FIELD_LIMITS.items():
        if name in df.columns:
            too_long = F.coalesce(F.length(name) > limit, F.lit(False))
            df = df.withColumn(f"{name}_too_long", too_long)
    return df

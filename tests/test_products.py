from conftest import rows
from pyspark.sql import functions as F

from shelfmark.operators.products import (
    clean_products,
    first_per_key,
    insert_if_absent,
    merge_catalog,
    quality_limits,
)
from shelfmark.sources.documents import read_catalog, read_custom_products


def test_merge_order_and_priority(spark):
    catalog = spark.createDataFrame([("1", "one", 0), ("2", "two", 1), ("1", "one again", 2)],
                                    "barcode string, name string, seq long")
    custom = spark.createDataFrame(
        [("1", "mine", None, None, 0), ("9", "first", "bo", "t", 1), ("9", "second", None, None, 2)],
        "barcode string, name string, created_by string, created_at string, seq long",
    )
    merged = merge_catalog(catalog, custom).orderBy("origin", "seq")
    assert [tuple(r) for r in merged.collect()] == [
        ("1", "one again", "catalog", None, None, 0, 0),
        ("2", "two", "catalog", None, None, 0, 1),
        ("9", "first", "custom", "bo", "t", 1, 1),
    ]


def test_insert_reports_every_product(spark):
    new = spark.createDataFrame([("1", "a", 0), ("7", "b", 1), ("7", "c", 2), ("8", "d", 3)],
                                "barcode string, name string, seq long")
    old = spark.createDataFrame([("1",), ("1",), ("5",)], "barcode string")
    assert rows(insert_if_absent(new, old), "name", "status") == [
        ("a", "duplicate"), ("b", "inserted"), ("c", "duplicate"), ("d", "inserted")]


def test_first_per_key_keeps_whole_rows_and_nulls(spark):
    df = spark.createDataFrame([("k", None, 2), ("k", "later", 3), ("j", "x", None), (None, "n", 1)],
                               "key string, value string, at int")
    assert rows(first_per_key(df, "key", df["at"])) == [(None, "n", 1), ("j", "x", None), ("k", None, 2)]


def test_first_per_key_takes_one_of_ties_and_tells_null_from_empty(spark):
    df = spark.createDataFrame([("k", 1), ("k", 1), ("", 2), (None, 3), (None, 3), (None, None), ("m", None), ("m", None)],
                               "key string, at int")
    assert rows(first_per_key(df, "key", df["at"])) == [(None, None), ("", 2), ("k", 1), ("m", None)]
    assert rows(first_per_key(df.limit(0), "key", df["at"])) == []


def test_winners_are_found_without_aggregating_whole_rows(spark, tmp_path):
    schema = "id string, at int, items array<struct<barcode: string, qty: long>>"
    made = [("hot", at, [("b", at)]) for at in range(200)] + [(str(at), at, [("c", at)]) for at in range(100)]
    spark.createDataFrame(made, schema).write.parquet(str(tmp_path / "records"))
    df = spark.read.schema(schema).parquet(str(tmp_path / "records"))
    first = first_per_key(df, "id", F.col("at"))
    assert first.count() == 101 and first.where("id = 'hot'").select("at", "items").first() == (0, [("b", 0)])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Exchange") == 1
    # Every input task keeps one row a key before the shuffle.
    assert "WindowGroupLimit" in plan[plan.index("Exchange"):]


def test_clean_products(spark):
    entered = spark.createDataFrame(
        [(" Bear ", " 12 ", " ", 35), ("  ", "13", "bo", 35), ("Fox", None, "bo", 1_700_000_000_000),
         (None, "1", "x", 1)],
        "name string, barcode string, person string, millis long",
    )
    assert rows(clean_products(entered)) == [
        ("12", "Bear", "custom", None, "1970-01-01T00:00:00.035Z"),
        ("custom-loyw3v28", "Fox", "custom", "bo", "2023-11-14T22:13:20.000Z")]


def test_quality_limits(spark):
    df = spark.createDataFrame([("x" * 121, "b" * 60), ("x" * 120, None)], "name string, barcode string")
    flagged = quality_limits(df).select("name_too_long", "barcode_too_long")
    assert rows(flagged) == [(False, False), (True, False)]


def test_read_catalog_keeps_the_order(spark, tmp_path):
    path = tmp_path / "products.json"
    path.write_text('[\n{"barcode": "007",\n"name": "熊"},\n{"barcode": "001", "name": "b"}]', encoding="utf-8")
    assert rows(read_catalog(spark, str(path)).select("seq", "barcode", "name")) == [
        (0, "007", "熊"), (1, "001", "b")]
    path.write_text('[{"barcode": "c-1", "name": "n", "source": "custom", "createdBy": null}]')
    custom = read_custom_products(spark, str(path))
    assert custom.first()["created_by"] is None
    missing = read_custom_products(spark, str(tmp_path / "none.json"))
    assert missing.schema == custom.schema and missing.count() == 0
    assert merge_catalog(custom.select("barcode", "name", "seq"), missing).count() == 1

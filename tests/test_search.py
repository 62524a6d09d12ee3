import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfmark.functions import text
from shelfmark.operators import readings, search
from shelfmark.plans.browse import browse, load_products
from test_classify import RULE_SET

ROWS = [("AB12", "Big Bear"), ("670", "趣味 猫"), ("671", None), ("3", "bear\nbag")]


@pytest.fixture
def products(spark):
    return spark.createDataFrame(ROWS, "barcode string, name string")


def found(df):
    return [r[0] for r in rows(df, "barcode")]


def test_terms(spark):
    assert text.split_terms("  Big\t　BEAR \n") == ["big", "bear"]
    row = spark.range(1).select(text.terms(F.lit("  Big\t　BEAR \n"))).first()
    assert row[0] == ["big", "bear"]


def test_all_terms_in_any_field(products):
    assert found(search.search_products(products, "BIG ear")) == ["AB12"]
    assert found(search.search_products(products, "67")) == ["670", "671"]
    assert found(search.search_products(products, "猫 67")) == ["670"]
    assert len(found(search.search_products(products, " \t"))) == 4


def test_barcode_is_compared_as_it_is(products):
    assert found(search.search_products(products, "ab12")) == []
    assert found(search.search_products(products, "ab12", lower_barcode=True)) == ["AB12"]


@pytest.mark.parametrize("bounds", [{}, {"HOT_TEXTS": 1, "ID_BLOCK": 1}])
def test_batch_equals_single_queries(spark, products, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(search, name, value)
    queries = [("a", "bear"), ("b", "BEAR b"), ("c", ""), ("d", "zz"), ("e", "67 猫"), ("f", "ab12"), ("g", "big bear big"),
               ("h", "ear\u3000bag"), ("i", " \t"), ("j", "6"), ("k", "bearx")]
    twice = products.unionByName(products.limit(1))
    assert search.search_batch(twice, spark.createDataFrame(queries[:1], "query_id string, query string")).count() == 3
    assert search.search_batch(products, spark.createDataFrame([], "query_id string, query string")).count() == 0
    batch = rows(search.search_batch(products, spark.createDataFrame(queries, "query_id string, query string")),
                 "query_id", "barcode")
    single = [(i, b) for i, q in queries for b in found(search.search_products(products, q))]
    assert batch == sorted(single)


@pytest.mark.parametrize("few", [0, 1000])
def test_batch_broadcasts_neither_texts_nor_queries(spark, products, tmp_path, monkeypatch, few):
    """Small files may hold very many rows: no join may take one side whole for its few bytes."""
    monkeypatch.setattr(search, "FEW_GRAMS", few)
    products.write.parquet(f"{tmp_path}/products")
    queries = [("a", "bear"), ("b", "BEAR b"), ("c", ""), ("d", "zz"), ("e", "67 猫")]
    spark.createDataFrame(queries, "query_id string, query string").write.parquet(f"{tmp_path}/queries")
    stored = spark.read.parquet(f"{tmp_path}/products")
    batch = search.search_batch(stored, spark.read.parquet(f"{tmp_path}/queries"))
    plan = batch._jdf.queryExecution().sparkPlan().toString()
    assert set(re.findall(r"Broadcast\w*Join \[?(\w*)", plan)) == {"gram"}
    single = [(i, b) for i, q in queries for b in found(search.search_products(products, q))]
    assert rows(batch, "query_id", "barcode") == sorted(single)


@pytest.mark.parametrize("few", [0, 1000])
def test_runs_get_longer_with_the_number_of_texts(spark, tmp_path, monkeypatch, few):
    """Runs of three digits would each lie in a share of all texts, however many there are."""
    monkeypatch.setattr(search, "FEW_GRAMS", few)
    monkeypatch.setattr(search, "CUT_TEXTS", 100)
    monkeypatch.setattr(search, "fresh_dir", lambda spark, label: f"{tmp_path}/{label}")
    products = spark.range(1200).select(F.col("id").cast("string").alias("barcode"), F.lit("big bear").alias("name"))
    queries = spark.range(1000, 1300).select("id", F.concat("id", F.lit(" B")).alias("query")).toDF("query_id", "query")
    batch = search.search_batch(products, queries)
    assert rows(batch, "query_id", "barcode") == sorted((i, str(i)) for i in range(1000, 1200))
    cut = spark.read.parquet(f"{tmp_path}/search-runs")
    assert cut.where("length(gram) = 4").groupBy("gram").count().agg(F.max("count")).first()[0] == 1
    asked = {"b"} | {str(i) for i in range(1000, 1200)}
    found = {r["gram"] for r in cut.select("gram").distinct().collect()}
    assert found == asked if few else asked <= found and len(found) < 1.2 * len(asked)
    assert {len(gram) for gram in found} == {1, 4}


def test_readings(spark, products):
    schema = "char string, reading string"
    with pytest.raises(ValueError, match="one character"):
        readings.load_dictionary(spark.createDataFrame([("ab", "no")], schema))
    dictionary = readings.load_dictionary(
        spark.createDataFrame([("猫", "Mao"), ("趣", "qu"), ("味", "wei"), ("味", "zz")], schema))
    assert dictionary == {"猫": "Mao", "趣": "qu", "味": "wei"}
    read = readings.add_readings(products, dictionary)
    assert rows(read.where("barcode = '670'"), "reading", "initials") == [("quwei mao", "qw m")]
    assert found(search.search_products(read, "weI")) == ["670"]
    assert found(search.search_products(read, "qw")) == ["670"]
    bare = readings.add_readings(products, None)
    assert rows(bare, "reading", "initials") == [("", "")] * 4


def test_readings_are_not_read_again(products):
    read = readings.add_readings(products.where("barcode = 'AB12'"), {"B": "ea", "e": "x"})
    assert rows(read, "reading", "initials") == [("eaig eaxar", "eig exar")]


def test_visible_products(spark):
    names = spark.createDataFrame([("1", "big bear"), ("2", "bear"), ("3", "bag"), ("4", "stone")],
                                  "barcode string, name string")

    def visible(*args, **kwargs):
        return found(search.visible_products(names, RULE_SET, *args, **kwargs))

    assert visible() == ["1", "2", "3", "4"]
    assert visible("soft") == ["1", "2"]
    assert visible("soft", "soft-big") == ["1"]
    assert visible("soft", "unknown") == ["1", "2"]
    assert visible("soft", "soft-nil") == []
    assert visible("unknown") == []
    assert visible("uncategorized") == ["4"]
    assert visible("soft", query="big") == ["1"]


def test_browse_is_in_catalog_order(spark):
    catalog = spark.createDataFrame([("9", "bear 9", 0), ("1", "bear 1", 1)],
                                    "barcode string, name string, seq long")
    custom = spark.createDataFrame([("5", "bear 5", "me", "t", 0), ("1", "x", "me", "t", 1)],
                                   "barcode string, name string, created_by string, created_at string, seq long")
    listed = browse(load_products(catalog, custom), RULE_SET, "soft")
    assert [r["barcode"] for r in listed.collect()] == ["9", "1", "5"]


def test_name_functions(spark):
    names = ["", "a", "AZ", "趣味太阳", "𠀀x", "  ★"]

    def hue(name):
        units = name.encode("utf-16-le")
        h = 0
        for i in range(0, len(units), 2):
            h = (h * 31 + int.from_bytes(units[i : i + 2], "little")) % 360
        return h

    df = spark.createDataFrame([(n,) for n in names], "name string").select(
        "name", text.name_hue(F.col("name")).alias("hue"), text.first_glyph(F.col("name")).alias("glyph"))
    assert {r["name"]: r["hue"] for r in df.collect()} == {n: hue(n) for n in names}
    assert {r["name"]: r["glyph"] for r in df.collect()} == dict(
        zip(names, ["？", "a", "A", "趣", "x", "？"]))


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_minute_text_does_not_depend_on_the_session(spark, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        row = spark.range(1).select(
            text.minute_text(F.lit("2024-01-31T23:59:30.123Z")),
            text.minute_text(F.lit("2024-01-31T23:59:30.123Z"), "Asia/Shanghai")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == ("2024-01-31 23:59", "2024-02-01 07:59")


@pytest.mark.parametrize("extra", [0, 5, 20, 40])
def test_readings_of_any_table(spark, extra):
    # Few entries, entries that hold one another's characters, stand-ins in texts, empty and many entries.
    for table in ({"a": "xy", "b": ""}, {"a": "b", "b": "ab", "c": "", "é": "E", "😀": "smile"}):
        table = table | {chr(0x4E00 + i): f"r{i}" for i in range(extra)}
        texts = ["", "abcab", "a", "c😀é😀", "".join(table), None, "zz"]
        df = spark.createDataFrame([(t,) for t in texts], "name string")
        got = [tuple(r) for r in readings.add_readings(df, table).select("name", "reading", "initials").collect()]
        first = {c: r[:1] for c, r in table.items()}
        for name, reading, initials in got:
            assert (reading, initials) == (
                (None, None) if name is None
                else tuple("".join(t.get(c, c) for c in name).lower() for t in (table, first)))

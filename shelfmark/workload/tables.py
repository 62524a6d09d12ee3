"""The test tables in the roles of sources, catalogs, carts and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.text import iso_text
from shelfmark.sources.registry import SourceSpec


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SPECS = {
    spec.name: spec
    for spec in (
        SourceSpec("customer", ("c_name", "c_mktsegment"), company="c_nationkey"),
        SourceSpec("events", ("event_type", "props"), "ts", "user_id"),
        SourceSpec("lineitem", ("l_returnflag", "l_linestatus", "l_partkey"), "l_shipdate", "l_suppkey"),
        SourceSpec("orders", ("o_orderstatus", "o_orderpriority", "o_orderkey"), "o_orderdate", "o_custkey"),
        SourceSpec(
            "part",
            ("p_name", "p_brand", "p_type"),
            company=None,
            keep={"p_name": lambda value: ~value.rlike("anvil|_") & value.rlike("g\\z")},
        ),
        SourceSpec("supplier", ("s_name",), company="s_nationkey"),
    )
}
# The same, for the SQL side.
KEEP_SQL = {"p_name": "NOT regexp_matches(p_name, 'anvil|_') AND regexp_matches(p_name, 'g$')"}

COMBINED = ("customer", "lineitem", "orders", "part", "supplier")
ORDER_DAY = "1996-06-14"
EVENT_DAY = "2024-01-03"


def triples_sql(name: str, start: str | None = None, end: str | None = None) -> str:
    """Triples of a source with one scan per value column."""
    spec = SPECS[name]
    company = "'universal'" if spec.company is None else f"CAST({spec.company} AS VARCHAR)"
    branches = []
    for column in spec.values:
        tests = [f"{column} IS NOT NULL"]
        if column in KEEP_SQL:
            tests.append(KEEP_SQL[column])
        if spec.day_column is not None and (start or end):
            tests.append(f"CAST({spec.day_column} AS DATE) <= DATE '{end or start}'")
            if start is not None:
                tests.append(f"CAST({spec.day_column} AS DATE) >= DATE '{start}'")
        branches.append(
            f"SELECT DISTINCT {company} AS company_guid, '{name}.{column}' AS column_name, "
            f"CAST({column} AS VARCHAR) AS column_value FROM {name} WHERE {' AND '.join(tests)}"
        )
    return " UNION ALL ".join(branches)


def first_seen_sql(name: str) -> str:
    """Triples of a dated source with their first day."""
    spec = SPECS[name]
    branches = [
        f"SELECT CAST({spec.company} AS VARCHAR) AS company_guid, '{name}.{column}' AS column_name, "
        f"CAST({column} AS VARCHAR) AS column_value, CAST({spec.day_column} AS DATE) AS ds "
        f"FROM {name} WHERE {column} IS NOT NULL"
        for column in spec.values
    ]
    return (
        "SELECT company_guid, column_name, column_value, min(ds) AS ds FROM ("
        + " UNION ALL ".join(branches)
        + ") GROUP BY ALL"
    )


# ---- catalog ----


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as products with unique barcodes."""
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("barcode"),
        F.col("p_name").alias("name"),
        F.col("p_partkey").alias("seq"),
    )


PARTS_SQL = "SELECT CAST(p_partkey AS VARCHAR) AS barcode, p_name AS name, p_partkey AS seq FROM part"


def priced_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as products whose barcode is the whole price: many copies of each."""
    return read(spark, sf_dir, "part").select(
        F.floor("p_retailprice").cast("string").alias("barcode"),
        F.concat_ws(" ", "p_name", "p_type").alias("name"),
        F.col("p_partkey").alias("seq"),
    )


PRICED_SQL = (
    "SELECT CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS barcode, "
    "concat_ws(' ', p_name, p_type) AS name, p_partkey AS seq FROM part"
)


def custom_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as products entered by hand, some with barcodes that are taken."""
    return read(spark, sf_dir, "orders").select(
        (F.col("o_custkey") + 500).cast("string").alias("barcode"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("created_by"),
        iso_text(F.col("o_orderdate")).alias("created_at"),
        F.col("o_orderkey").alias("seq"),
    )


CUSTOM_SQL = (
    "SELECT CAST(o_custkey + 500 AS VARCHAR) AS barcode, o_orderpriority AS name, "
    "o_orderstatus AS created_by, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ') AS created_at, "
    "o_orderkey AS seq FROM orders"
)


# ---- cart ----


def cart_events(events: DataFrame) -> DataFrame:
    """Events as cart events: neighbouring users share a cart, ``props.k`` stands for the product."""
    kind, high = F.col("event_type"), F.col("value") >= 80
    action = (
        F.when(kind == "view", "add")
        .when(kind == "click", "inc")
        .when(kind == "purchase", "dec")
        .when(kind == "error", F.when(high, "del").otherwise("add"))
        .otherwise(F.when(high, "submit").otherwise("dec"))
    )
    key = F.regexp_extract("props", "[0-9]+", 0).try_cast("bigint")
    barcode = F.floor(key / 3).cast("string")
    # Submits of small values lack a person.
    person = F.when(F.col("value") >= 90, F.concat(F.lit(" user "), F.col("user_id").cast("string")))
    return events.select(
        F.floor(F.col("user_id") / 10).cast("string").alias("cart_id"),
        F.when(action != "submit", barcode).alias("barcode"),
        "ts",
        "event_id",
        action.alias("action"),
        F.when(action == "submit", person).alias("person"),
    )


CART_EVENTS_SQL = """
SELECT CAST(user_id // 10 AS VARCHAR) AS cart_id,
       CASE WHEN action <> 'submit' THEN CAST(k // 3 AS VARCHAR) END AS barcode, ts, event_id,
       CASE WHEN action = 'submit' AND value < 90 THEN 'refused' ELSE action END AS action,
       CASE WHEN action = 'submit' AND value >= 90 THEN 'user ' || user_id END AS person
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
             CASE event_type WHEN 'view' THEN 'add' WHEN 'click' THEN 'inc' WHEN 'purchase' THEN 'dec'
                  WHEN 'error' THEN CASE WHEN value >= 80 THEN 'del' ELSE 'add' END
                  ELSE CASE WHEN value >= 80 THEN 'submit' ELSE 'dec' END END AS action
      FROM events WHERE user_id IS NOT NULL)
"""


def cart_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as the products that carts may hold; some barcodes of the events are not among them."""
    return read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("barcode"), F.col("n_name").alias("name")
    )


# ---- records ----

#: Minutes before and after the start of 2024 up to which a timestamp, 64 bits of microseconds, and SQL's interval go.
HELD_MINUTES = (-(2**63 // 60_000_000), 2**63 // 60_000_000 - 19_723 * 1440)


def talk_records(conversations: DataFrame) -> DataFrame:
    """Turns as records: all turns of a conversation carry its id, lines with 'th' are the items.

    Their times are made of the ids. An id may be any number; one beyond what a timestamp holds gives no time.
    """
    minutes = F.try_add(F.try_multiply("conv_id", F.lit(60)), "turn")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    held = F.when(minutes.between(*HELD_MINUTES), minutes)
    # Years of five digits have no sign, as in SQL.
    at = F.ltrim(iso_text(F.timestamp_add("MINUTE", held, start)), F.lit("+"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.contains("th"))

    def item(line: Column) -> Column:
        return F.struct(
            F.length(line).cast("string").alias("barcode"),
            line.alias("name"),
            F.size(F.split(line, " ")).cast("bigint").alias("qty"),
            at.alias("addedAt"),
        )

    return conversations.select(
        F.col("conv_id").cast("string").alias("id"),
        F.col("role").alias("person"),
        at.alias("submittedAt"),
        F.transform(lines, item).alias("items"),
        F.col("turn").alias("seq"),
    )


TALK_RECORDS_SQL = """
SELECT CAST(conv_id AS VARCHAR) AS id, role AS person, turn AS seq,
       strftime(TIMESTAMP '2024-01-01' + to_minutes(CAST(conv_id * 60 + turn AS BIGINT)),
                '%Y-%m-%dT%H:%M:%S.%gZ') AS submittedAt,
       list_filter(string_split(text, chr(10)), lambda line: contains(line, 'th')) AS names
FROM conversations
"""


def label_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as a record log that holds some of the conversation ids."""
    return read(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("id"), F.col("quality").cast("string").alias("person")
    )

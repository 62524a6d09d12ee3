"""Lookup queries."""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.days import define_run_day, partition_id
from shelfmark.operators import delta, extract
from shelfmark.plans import daily_lookup
from shelfmark.schemas import TRIPLE_COLUMNS
from shelfmark.session import fresh_dir
from shelfmark.sources import registry, storage
from shelfmark.streaming.jobs import read_files, write_stream
from shelfmark.streaming.lookup import continue_lookup, new_values_stream, read_new
from shelfmark.workload.tables import (
    COMBINED,
    EVENT_DAY,
    ORDER_DAY,
    SPECS,
    first_seen_sql,
    read,
    triples_sql,
)

TRIPLE_SQL = ", ".join(TRIPLE_COLUMNS)
RANGE = ("1996-01-01", "1996-03-31")
RUN_DAYS = ("1996-06-13", "1996-06-14", "1996-06-15")


def _days_before(day: str, n: int) -> str:
    return str(dt.date.fromisoformat(day) - dt.timedelta(days=n))


def _extract(spark: SparkSession, sf_dir: str, name: str, *days: str | None) -> DataFrame:
    return extract.extract_values(read(spark, sf_dir, name), SPECS[name], *days)


def extract_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extract(spark, sf_dir, "customer")


def extract_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extract(spark, sf_dir, "orders", ORDER_DAY)


def extract_by_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extract(spark, sf_dir, "events", EVENT_DAY)


def extract_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value column extracted by a SQL text that asks for the run day."""
    define_run_day(spark, ORDER_DAY)
    return spark.sql(
        """SELECT DISTINCT CAST(o_custkey AS STRING) AS company_guid,
                  'orders.o_orderpriority' AS column_name, o_orderpriority AS column_value
           FROM {orders} WHERE CAST(o_orderdate AS DATE) BETWEEN run_date() AND run_date()
                AND o_orderpriority IS NOT NULL""",
        orders=read(spark, sf_dir, "orders"),
    )


def extract_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extract(spark, sf_dir, "lineitem", *RANGE)


def extract_universal_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extract(spark, sf_dir, "part")


def _combined(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [extract.extract_day(read(spark, sf_dir, n), SPECS[n], ORDER_DAY) for n in COMBINED]


_COMBINED_SQL = " UNION ALL ".join(triples_sql(name, ORDER_DAY) for name in COMBINED)


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.union_sources(_combined(spark, sf_dir))


def incoming_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct triples of a day; sources of one name (two datasets of orders) overlap."""
    twice = extract.extract_day(read(spark, sf_dir, "orders"), SPECS["orders"], ORDER_DAY, lookback_days=1)
    return extract.incoming([*_combined(spark, sf_dir), twice])


def delta_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples of a day that no earlier day has."""
    fresh = _extract(spark, sf_dir, "events", EVENT_DAY)
    history = _extract(spark, sf_dir, "events", None, _days_before(EVENT_DAY, 1))
    return delta.new_values(fresh, history)


def delta_all_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarter's line item values that are in no other row of the whole table before."""
    fresh = _extract(spark, sf_dir, "lineitem", *RANGE)
    history = _extract(spark, sf_dir, "lineitem", None, _days_before(RANGE[0], 1))
    return delta.new_values(fresh, history)


def delta_day_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New triples per column on a second run of a day, with the run day as history and without."""
    events = read(spark, sf_dir, "events")
    days = extract.first_seen(events, SPECS["events"])
    fresh = extract.extract_day(events, SPECS["events"], EVENT_DAY)

    def counted(inclusive: bool, name: str) -> DataFrame:
        new = delta.new_values(fresh, delta.history_until(days, EVENT_DAY, inclusive))
        return new.groupBy("column_name").agg(F.count(F.lit(1)).alias(name))

    return (
        fresh.groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("n_incoming"))
        .join(counted(False, "n_new"), "column_name", "left")
        .join(counted(True, "n_new_rerun"), "column_name", "left")
        .na.fill(0)
    )


def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.first_seen(read(spark, sf_dir, "events"), SPECS["events"])


def first_seen_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every day partition after a backfill of line items."""
    seen = extract.first_seen(read(spark, sf_dir, "lineitem"), SPECS["lineitem"])
    return seen.groupBy(partition_id(F.col("ds")).alias("partition")).agg(F.count(F.lit(1)).alias("n"))


def lookup_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = extract.first_seen(read(spark, sf_dir, "events"), SPECS["events"])
    return delta.lookup_asof(days, "2024-01-10")


def publish_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup of all snapshot sources and line items, written as a version and read back."""
    root = fresh_dir(spark, "publish")
    lines = extract.first_seen(read(spark, sf_dir, "lineitem"), SPECS["lineitem"]).drop("ds")
    snapshots = [_extract(spark, sf_dir, name) for name in ("customer", "part", "supplier")]
    storage.publish_lookup(extract.incoming([lines, *snapshots]), root)
    return storage.read_lookup(spark, root)


_PUBLISHED_SQL = " UNION ALL ".join(
    triples_sql(name) for name in ("lineitem", "customer", "part", "supplier")
)


def lookup_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of a column for a company, with the universal ones, from a published version."""
    root = fresh_dir(spark, "values")
    snapshots = [_extract(spark, sf_dir, name) for name in ("customer", "part", "supplier")]
    storage.publish_lookup(extract.incoming(snapshots), root)
    lookup = storage.read_lookup(spark, root)
    own = delta.lookup_values(lookup, "7", "customer.c_name")
    everyone = delta.lookup_values(lookup, "7", "part.p_brand")
    return own.unionByName(everyone)


def daily_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of consecutive days over all order sources, the last one twice."""
    root = fresh_dir(spark, "daily")
    specs = [SPECS[name] for name in COMBINED]
    for day in (*RUN_DAYS, RUN_DAYS[-1]):
        daily_lookup.run_day(spark, root, specs, lambda name: read(spark, sf_dir, name), day)
    return storage.read_days(spark, root, storage.RAW)


def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same days in one job."""
    root = fresh_dir(spark, "backfill")
    specs = [SPECS[name] for name in COMBINED]
    daily_lookup.backfill(
        spark, root, specs, lambda name: read(spark, sf_dir, name), RUN_DAYS[0], RUN_DAYS[-1]
    )
    return storage.read_days(spark, root, storage.RAW)


def backfill_after_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of two days, a backfill of the second and the next, and one of a day far later."""
    root = fresh_dir(spark, "backfill-after")
    specs = [SPECS[name] for name in COMBINED]

    def source(name: str) -> DataFrame:
        return read(spark, sf_dir, name)

    daily_lookup.run_day(spark, root, specs, source, RUN_DAYS[0])
    daily_lookup.run_day(spark, root, specs, source, RUN_DAYS[1])
    daily_lookup.run_day(spark, root, specs, source, LATER_DAY)
    daily_lookup.backfill(spark, root, specs, source, RUN_DAYS[1], RUN_DAYS[2])
    return storage.read_days(spark, root, storage.RAW)


def sources_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources named by a settings file, read from where it says and extracted in order, and read back by name."""
    root = fresh_dir(spark, "settings")
    names = ("supplier", "part", "customer")
    for name in names:
        read(spark, sf_dir, name).write.parquet(f"{root}/sources/tables/{name}")
    document = {"target_root": f"{root}/target", "sources": dict.fromkeys(names, "tables"), "source_root": f"{root}/sources"}
    spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.text(f"{root}/settings")
    settings = registry.parse_settings(spark.read.text(f"{root}/settings", wholetext=True).first()["value"])
    specs = registry.load_registry(settings, SPECS)
    values = {s.name: extract.extract_values(registry.read_source(spark, settings, s.name), s) for s in specs}
    storage.stage_sources(values, settings.target_root, ORDER_DAY)
    staged = [
        storage.read_triples(spark, settings.target_root, s.name, ORDER_DAY).withColumn("place", F.lit(i))
        for i, s in enumerate(specs)
    ]
    return reduce(DataFrame.unionByName, staged)


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table and column of the catalog tables after whole runs of two days from settings."""
    root = fresh_dir(spark, "catalog")
    names = ("customer", "orders")
    sources = {name: "tables" for name in names}
    for name in names:
        read(spark, sf_dir, name).write.parquet(f"{root}/sources/tables/{name}")
    settings = registry.Settings(f"{root}/target", sources, f"{root}/sources")
    specs = registry.load_registry(settings, SPECS)
    days, published = (f"lookup_{root[-12:]}_{kind}" for kind in ("days", "now"))
    for day in RUN_DAYS[:2]:
        daily_lookup.run_day(
            spark, settings.target_root, specs, lambda name: registry.read_source(spark, settings, name), day, table=days
        )
        daily_lookup.publish(spark, settings.target_root, table=published, keep=1)
    both = spark.table(days).drop("ds").withColumn("source", F.lit("days")).unionByName(
        spark.table(published).withColumn("source", F.lit("published"))
    )
    return both.groupBy("source", "column_name").agg(F.count(F.lit(1)).alias("n"))


LATER_DAY = "1996-06-20"
_CATALOG_SQL = " UNION ALL ".join(
    f"SELECT '{kind}' AS source, column_name, count(*) AS n FROM (SELECT DISTINCT {TRIPLE_SQL} FROM ("
    + " UNION ALL ".join(triples_sql(name, day) for day in RUN_DAYS[:2] for name in ("customer", "orders"))
    + ")) GROUP BY column_name"
    for kind in ("days", "published")
)


_RUNS_SQL = (
    "SELECT company_guid, column_name, column_value, min(ds) AS ds FROM ("
    + " UNION ALL ".join(
        f"SELECT *, DATE '{day}' AS ds FROM ({triples_sql(name, day)})"
        for day in RUN_DAYS
        for name in COMBINED
    )
    + ") GROUP BY ALL"
)


def late_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that also looks at the two days before."""
    return extract.extract_day(read(spark, sf_dir, "events"), SPECS["events"], EVENT_DAY, lookback_days=2)


def stream_new_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_dir(spark, "stream-values")
    stream = read_files(spark, sf_dir, "events.parquet")
    new = new_values_stream(stream, SPECS["events"])
    write_stream(new, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


def stream_after_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup of the first days is published; a stream of all events then brings what it lacks."""
    root = fresh_dir(spark, "stream-after")
    seen_first = _extract(spark, sf_dir, "events", None, EVENT_DAY)
    storage.publish_lookup(seen_first, root)
    stream = read_files(spark, sf_dir, "events.parquet")
    continue_lookup(stream, SPECS["events"], storage.read_lookup(spark, root), f"{root}/stream").awaitTermination()
    return read_new(spark, f"{root}/stream")


def late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the files of the events: of each day, and a file of old days that comes after the first run."""
    root = fresh_dir(spark, "late-files")
    events = read(spark, sf_dir, "events")
    first = (F.col("ts") < LATE_FROM) & (F.col("event_id") % 5 != 0)
    for day, part in ((LATE_DAYS[0], first), (LATE_DAYS[1], ~F.coalesce(first, F.lit(False)))):
        events.where(part).write.mode("append").parquet(f"{root}/sources/events")
        daily_lookup.run_new_files(spark, f"{root}/target", [SPECS["events"]], f"{root}/sources", day)
    return storage.read_days(spark, f"{root}/target", storage.RAW)


LATE_FROM = "2024-01-10"
LATE_DAYS = ("2024-01-09", "2024-01-31")
_LATE_SQL = "SELECT company_guid, column_name, column_value, min(ds) AS ds FROM (" + " UNION ALL ".join(
    f"SELECT CAST(user_id AS VARCHAR) AS company_guid, 'events.{column}' AS column_name, {column} AS column_value, "
    f"CASE WHEN ts < TIMESTAMP '{LATE_FROM}' AND event_id % 5 <> 0 THEN DATE '{LATE_DAYS[0]}' "
    f"ELSE DATE '{LATE_DAYS[1]}' END AS ds FROM events WHERE {column} IS NOT NULL"
    for column in SPECS["events"].values
) + ") GROUP BY ALL"

QUERIES = {
    f.__name__: f
    for f in (
        extract_snapshot, extract_by_date, extract_by_timestamp, extract_in_sql, extract_range,
        extract_universal_regex, union_sources, incoming_distinct, delta_day, delta_all_orders,
        delta_day_inclusive, first_seen, first_seen_by_day, lookup_asof, publish_lookup, lookup_values,
        sources_in_order, daily_runs, backfill, backfill_after_runs, catalog_tables, late_arrivals, stream_new_values,
        stream_after_publish, late_files,
    )
}

ORACLE = {
    "extract_snapshot": triples_sql("customer"),
    "extract_by_date": triples_sql("orders", ORDER_DAY),
    "extract_by_timestamp": triples_sql("events", EVENT_DAY),
    "extract_in_sql": f"SELECT * FROM ({triples_sql('orders', ORDER_DAY)}) "
    "WHERE column_name = 'orders.o_orderpriority'",
    "extract_range": triples_sql("lineitem", *RANGE),
    "extract_universal_regex": triples_sql("part"),
    "union_sources": _COMBINED_SQL,
    "incoming_distinct": f"SELECT DISTINCT * FROM ({_COMBINED_SQL} UNION ALL "
    f"{triples_sql('orders', _days_before(ORDER_DAY, 1), ORDER_DAY)})",
    "delta_day": f"SELECT * FROM ({triples_sql('events', EVENT_DAY)}) EXCEPT "
    f"SELECT * FROM ({triples_sql('events', None, _days_before(EVENT_DAY, 1))})",
    "delta_all_orders": f"SELECT * FROM ({triples_sql('lineitem', *RANGE)}) EXCEPT "
    f"SELECT * FROM ({triples_sql('lineitem', None, _days_before(RANGE[0], 1))})",
    "delta_day_inclusive": f"""
        SELECT column_name, count(*) AS n_incoming,
               count(*) FILTER (WHERE ds = DATE '{EVENT_DAY}') AS n_new, CAST(0 AS BIGINT) AS n_new_rerun
        FROM ({triples_sql('events', EVENT_DAY)}) AS incoming JOIN ({first_seen_sql('events')}) AS seen
             USING (column_name, column_value)
        WHERE incoming.company_guid IS NOT DISTINCT FROM seen.company_guid GROUP BY column_name""",
    "first_seen": first_seen_sql("events"),
    "first_seen_by_day": f"SELECT strftime(ds, '%Y%m%d') AS \"partition\", count(*) AS n "
    f"FROM ({first_seen_sql('lineitem')}) GROUP BY 1",
    "lookup_asof": f"SELECT {TRIPLE_SQL} FROM ({first_seen_sql('events')}) WHERE ds <= DATE '2024-01-10'",
    "publish_lookup": f"SELECT DISTINCT * FROM ({_PUBLISHED_SQL})",
    "lookup_values": """
        SELECT DISTINCT c_name AS column_value FROM customer WHERE c_nationkey = 7
        UNION ALL SELECT DISTINCT p_brand FROM part""",
    "daily_runs": _RUNS_SQL,
    "sources_in_order": " UNION ALL ".join(
        f"SELECT *, {i} AS place FROM ({triples_sql(name)})" for i, name in enumerate(("customer", "part", "supplier"))
    ),
    "backfill": _RUNS_SQL,
    "backfill_after_runs": "SELECT company_guid, column_name, column_value, min(ds) AS ds FROM ("
    + " UNION ALL ".join(
        f"SELECT *, DATE '{day}' AS ds FROM ({triples_sql(name, day)})"
        for day in (*RUN_DAYS, LATER_DAY)
        for name in COMBINED
    )
    + ") GROUP BY ALL",
    "catalog_tables": _CATALOG_SQL,
    "late_arrivals": triples_sql("events", _days_before(EVENT_DAY, 2), EVENT_DAY),
    "stream_after_publish": f"SELECT DISTINCT * FROM ({triples_sql('events')}) EXCEPT "
    f"SELECT * FROM ({triples_sql('events', None, EVENT_DAY)})",
    "late_files": _LATE_SQL,
    "stream_new_values": f"SELECT DISTINCT * FROM ({triples_sql('events')})",
}

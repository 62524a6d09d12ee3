"""Day partitions and numbered versions of parquet tables."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import asdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.functions.days import Day, as_day
from shelfmark.schemas import DAY_TRIPLE, TRIPLE, TRIPLE_COLUMNS
from shelfmark.sources import ranges
from shelfmark.sources.files import claim, drop, exists, listing, read_text, write_text
from shelfmark.sources.ranges import Range

STAGED = "values"
RAW = "lookup_raw"
PUBLISHED = "lookup"


def empty(spark: SparkSession, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


# ---- day partitions ----


def day_path(root: str, name: str, ds: Day) -> str:
    return f"{root}/{name}/ds={as_day(ds)}"


def create_triple_table(spark: SparkSession, table: str, location: str) -> None:
    """Catalog entry of a day-partitioned triple table."""
    columns = ", ".join(
        f"{field.name} STRING COMMENT '{field.metadata['comment']}'" for field in TRIPLE.fields
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, ds DATE) "
        f"USING parquet PARTITIONED BY (ds) LOCATION '{location}'"
    )


def add_day(spark: SparkSession, table: str, ds: Day) -> None:
    """Tell the catalog about a day written by :func:`write_day`."""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (ds = '{as_day(ds)}')")
    spark.catalog.refreshTable(table)


def write_day(triples: DataFrame, root: str, name: str, ds: Day) -> None:
    """Replace exactly one day of a triple table, also by an empty result.

    The day's own folder is the write target, so the other days can be read in the same job.
    """
    triples.select(*TRIPLE_COLUMNS).write.mode("overwrite").parquet(day_path(root, name, ds))


def read_days(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All days of a triple table; filters on ``ds`` prune whole folders."""
    path = f"{root}/{name}"
    if not exists(spark, path):
        return empty(spark, DAY_TRIPLE)
    return spark.read.schema(DAY_TRIPLE).parquet(path)


def read_day(spark: SparkSession, root: str, name: str, ds: Day) -> DataFrame:
    """Exactly one day of a triple table. Reads that day's folder only, without listing the others."""
    path = day_path(root, name, ds)
    if not exists(spark, path):
        return empty(spark, TRIPLE)
    return spark.read.schema(TRIPLE).parquet(path).select(*TRIPLE_COLUMNS)


def stage_sources(triples: Mapping[str, DataFrame], root: str, ds: Day) -> None:
    """Write the triples of all sources of a day, each into a folder of its own, in one job.

    One job keeps the whole cluster busy with all sources at once.
    """
    tagged = [df.withColumn("source", F.lit(name)) for name, df in triples.items()]
    day = reduce(DataFrame.unionByName, tagged)
    day.write.mode("overwrite").partitionBy("source").parquet(day_path(root, STAGED, ds))


def read_triples(spark: SparkSession, root: str, source: str, ds: Day) -> DataFrame:
    """Staged triples of one source on one run day."""
    path = f"{day_path(root, STAGED, ds)}/source={source}"
    if not exists(spark, path):
        return empty(spark, TRIPLE)
    return spark.read.schema(TRIPLE).parquet(path)


# ---- numbered versions ----


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions of a table, oldest first."""
    found = (re.fullmatch(r"version=(\d+)", name) for name, _, _ in listing(spark, path))
    numbers = sorted(int(match[1]) for match in found if match)
    return [n for n in numbers if exists(spark, f"{path}/version={n}/_SUCCESS")]


def write_version(df: DataFrame, path: str) -> int:
    """Write a table as its next version. Readers keep the version before until this one is complete.

    A number is claimed by a file that only one writer can create, so two writers never share a version.
    """
    number = _next_number(df.sparkSession, path)
    df.write.mode("overwrite").parquet(f"{path}/version={number}")
    return number


_claim = claim


def _next_number(spark: SparkSession, path: str) -> int:
    number = max(versions(spark, path), default=0) + 1
    while not _claim(spark, f"{path}/_claims/{number}"):
        number += 1
    return number


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame | None:
    """The latest complete version of a table, or a given one; None before the first."""
    if number is None:
        number = max(versions(spark, path), default=None)
    return None if number is None else spark.read.parquet(f"{path}/version={number}")


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the last ``keep`` versions."""
    for number in versions(spark, path)[:-keep]:
        drop(spark, f"{path}/version={number}")


def clustered(lookup: DataFrame) -> DataFrame:
    """Triples sorted by company over all files.

    The ranges span all three columns, so a company with a large share of the rows is cut into many
    files, while every file still holds a narrow company range for the reader to skip by.
    """
    return lookup.repartitionByRange(*TRIPLE_COLUMNS).sortWithinPartitions(*TRIPLE_COLUMNS)


# ---- the published lookup ----

#: Beside a version's mark of completeness: its ranges, and the state of the days that it holds.
RANGES = "ranges.json"


def published_ranges(spark: SparkSession, root: str, number: int | None = None) -> tuple[list[Range], dict] | None:
    """Ranges of a published version, and the days it holds; None if it is missing or written otherwise."""
    path = f"{root}/{PUBLISHED}"
    number = max(versions(spark, path), default=None) if number is None else number
    if number is None or not exists(spark, f"{path}/version={number}/{RANGES}"):
        return None
    held = json.loads(read_text(spark, f"{path}/version={number}/{RANGES}"))
    return [Range(r["name"], tuple(r["start"]), r["n"]) for r in held["ranges"]], held["days"]


def publish_lookup(
    lookup: DataFrame, root: str, days: Mapping[str, str] | None = None, n: int | None = None
) -> int:
    """Publish a lookup as a whole. ``days`` tells the days it holds and their state, ``n`` how many triples these have."""
    spark, path = lookup.sparkSession, f"{root}/{PUBLISHED}"
    number = _next_number(spark, path)
    written = ranges.write_all(lookup, f"{path}/ranges", str(number), n)
    return _complete(spark, root, number, written, days or {})


def publish_added(spark: SparkSession, root: str, held: list[Range], added: DataFrame, days: Mapping[str, str]) -> int:
    """Publish the lookup after triples were added to published ranges."""
    path = f"{root}/{PUBLISHED}"
    number = _next_number(spark, path)
    merged = ranges.merge(spark, f"{path}/ranges", held, added, str(number))
    return _complete(spark, root, number, merged, days)


def _complete(spark: SparkSession, root: str, number: int, held: list[Range], days: Mapping[str, str]) -> int:
    folder = f"{root}/{PUBLISHED}/version={number}"
    write_text(spark, f"{folder}/{RANGES}", json.dumps({"ranges": [asdict(r) for r in held], "days": days}))
    write_text(spark, f"{folder}/_SUCCESS", "")
    return number


def drop_published(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete all but the last ``keep`` published versions, and the ranges that only those had."""
    path = f"{root}/{PUBLISHED}"
    names = {n: {r.name for r in (published_ranges(spark, root, n) or ([], {}))[0]} for n in versions(spark, path)}
    drop_versions(spark, path, keep)
    kept = set().union(*[names[n] for n in versions(spark, path)])
    for name in set().union(*names.values()) - kept:
        drop(spark, f"{path}/ranges/range={name}")


def day_states(spark: SparkSession, root: str, name: str = RAW) -> dict[str, str]:
    """A text for each day of a triple table that changes when the day is written anew."""
    path = f"{root}/{name}"
    days = [folder for folder, _, _ in listing(spark, path) if folder.startswith("ds=")]
    return {day.removeprefix("ds="): json.dumps(listing(spark, f"{path}/{day}")) for day in days}


def read_lookup(spark: SparkSession, root: str) -> DataFrame:
    """The lookup published last."""
    held = published_ranges(spark, root)
    if held is None:
        published = read_version(spark, f"{root}/{PUBLISHED}")
        return empty(spark, TRIPLE) if published is None else published
    paths = ranges.folders(f"{root}/{PUBLISHED}/ranges", held[0])
    return spark.read.schema(TRIPLE).parquet(*paths) if paths else empty(spark, TRIPLE)


def point_lookup_table(spark: SparkSession, table: str, root: str) -> None:
    """Let a catalog table show the version published last, creating it if need be."""
    path = f"{root}/{PUBLISHED}"
    held = published_ranges(spark, root)
    location = f"{path}/version={max(versions(spark, path))}"
    if held is not None and held[0]:
        location = f"{path}/ranges/{{{','.join(f'range={r.name}' for r in held[0])}}}"
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
    else:
        columns = ", ".join(f"{name} STRING" for name in TRIPLE_COLUMNS)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{location}'")

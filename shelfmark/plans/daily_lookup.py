"""The daily lookup run: extract every source, combine, keep what is new, publish."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.days import Day, as_day, day_between
from shelfmark.operators.delta import lookup_asof
from shelfmark.operators.extract import extract_day, extract_values, first_seen, long_values
from shelfmark.schemas import DAY_TRIPLE, TRIPLE, TRIPLE_COLUMNS
from shelfmark.session import fresh_dir
from shelfmark.sources import seen
from shelfmark.sources.ledger import NewFiles
from shelfmark.sources.registry import Settings, SourceSpec, load_registry, read_source
from shelfmark.sources.storage import (
    PUBLISHED,
    RAW,
    STAGED,
    add_day,
    create_triple_table,
    day_path,
    day_states,
    drop,
    drop_published,
    empty,
    exists,
    point_lookup_table,
    publish_added,
    publish_lookup,
    published_ranges,
    read_day,
    read_days,
    stage_sources,
    write_day,
)


def run_day(
    spark: SparkSession,
    root: str,
    specs: Sequence[SourceSpec],
    read: Callable[[str], DataFrame],
    ds: Day,
    lookback_days: int = 0,
    inclusive: bool = False,
    table: str | None = None,
    by_arrival: bool = False,
) -> None:
    """Extract and combine one day.

    The values of all sources are staged first, so that they are computed once.

    ``by_arrival`` takes all rows that are read, whatever their days: what came late belongs to the day of the run.
    ``inclusive`` counts the run day as history, so that a second run of the day empties it. ``table`` names a
    catalog table over the days, which is made if need be and learns of the day.
    """
    if by_arrival:
        values = {spec.name: long_values(read(spec.name), spec).distinct() for spec in specs}
    else:
        values = {spec.name: extract_day(read(spec.name), spec, ds, lookback_days) for spec in specs}
    stage_sources(values, root, ds)
    fresh = read_day(spark, root, STAGED, ds)
    day = as_day(ds)
    # The index, not the days, is read, so the day may be replaced while what is new is found.
    delta = seen.new_triples(fresh, root, day if inclusive else day - dt.timedelta(days=1))
    seen.forget(spark, root, [day])
    write_day(delta, root, RAW, ds)
    if table is not None:
        create_triple_table(spark, table, f"{root}/{RAW}")
        add_day(spark, table, ds)


def run_new_files(
    spark: SparkSession, root: str, specs: Sequence[SourceSpec], source_root: str, ds: Day, table: str | None = None
) -> None:
    """A day's run over the files that came since the run before, whatever the days of their rows.

    Each source is a folder below ``source_root``. Files count as read once the day is written.
    """
    new = {spec.name: NewFiles(spark, f"{source_root}/{spec.name}", f"{root}/ledger/{spec.name}") for spec in specs}

    def read(name: str) -> DataFrame:
        return new[name].read(spark.read.parquet(f"{source_root}/{name}").schema)

    run_day(spark, root, specs, read, ds, table=table, by_arrival=True)
    for files in new.values():
        files.done()


def backfill(
    spark: SparkSession,
    root: str,
    specs: Sequence[SourceSpec],
    read: Callable[[str], DataFrame],
    start: Day,
    end: Day,
    table: str | None = None,
) -> None:
    """What the runs of all days start..end leave, without a run for each.

    A run a day finds a triple new on the first day it occurs on, and the values of a snapshot on the
    first day of all. Triples of the days before ``start`` are known; those days stay as they are. All days
    start..end are replaced, also by nothing.

    Days after ``end`` are kept as if they had been run again: triples that now are first seen before go, and those
    that the replaced days held and hold no more come to the first later day that has them. What a later day has is what
    its run staged, or, where nothing is staged, what the dated sources hold for it now. Only days that change are
    written.
    """
    seen_by_source = []
    for spec in specs:
        if spec.day_column is None:
            values = extract_values(read(spec.name), spec)
            seen_by_source.append(values.withColumn("ds", F.lit(as_day(start))))
        else:
            seen_by_source.append(first_seen(read(spec.name), spec, start, end))
    first, last = as_day(start), as_day(end)
    span = {first + dt.timedelta(days=n) for n in range((last - first).days + 1)}
    days = read_days(spark, root, RAW)
    work = fresh_dir(spark, "backfill")

    def staged(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    union = reduce(DataFrame.unionByName, seen_by_source).groupBy(*TRIPLE_COLUMNS).agg(F.min("ds").alias("ds"))
    seen_once = staged(seen.hashed(union), "seen")
    before = first - dt.timedelta(days=1)
    new = staged(seen.unknown(seen_once, root, seen.refresh(spark, root), before), "new")
    later = seen.hashed(days.where(F.col("ds") > F.lit(last)))
    moved = staged(seen.among(later, new), "moved")
    lost = seen.hashed(days.where(F.col("ds").between(F.lit(first), F.lit(last))))
    lost = staged(lost.join(new, ["h", "g"], "left_anti"), "lost")
    late_days = [day for day in seen.day_folders(spark, f"{root}/{RAW}") if day > last]
    had_later = seen.among(_values_of_days(spark, root, specs, read, late_days), lost)
    again = staged(had_later.groupBy("h", "g", *TRIPLE_COLUMNS).agg(F.min("ds").alias("ds")), "again")

    touched = {row["ds"] for row in moved.select("ds").union(again.select("ds")).distinct().collect()}
    kept = later.where(F.col("ds").isin(list(touched))).join(moved, ["h", "g", "ds"], "left_anti")
    columns = [*TRIPLE_COLUMNS, "ds"]
    result = staged(reduce(DataFrame.unionByName, [df.select(*columns) for df in (new, kept, again)]), "result")
    filled = {row["ds"] for row in result.select("ds").distinct().collect()}
    seen.forget(spark, root, sorted(span | touched))
    # Ranges over all columns: a day with most of the triples is written by many tasks.
    ranged = result.repartitionByRange("ds", *TRIPLE_COLUMNS)
    writer = ranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("ds").parquet(f"{root}/{RAW}")
    for day in sorted((span | touched) - filled):
        write_day(empty(spark, TRIPLE), root, RAW, day)
    drop(spark, work)
    if table is not None:
        create_triple_table(spark, table, f"{root}/{RAW}")
        for day in sorted(span | touched):
            add_day(spark, table, day)


def _values_of_days(
    spark: SparkSession, root: str, specs: Sequence[SourceSpec], read: Callable[[str], DataFrame], days: list[dt.date]
) -> DataFrame:
    """All triples that the sources had on each of the days, with their hashes."""
    held = [day for day in days if exists(spark, day_path(root, STAGED, day))]
    parts = [read_day(spark, root, STAGED, day).withColumn("ds", F.lit(day)) for day in held]
    others = [day for day in days if day not in held]
    for spec in specs if others else ():
        if spec.day_column is not None:
            dated = read(spec.name).withColumn("ds", F.col(spec.day_column).cast("date"))
            dated = dated.where(day_between(spec.day_column, min(others), max(others)) & F.col("ds").isin(others))
            parts.append(long_values(dated, spec, "ds").select(*TRIPLE_COLUMNS, "ds"))
    return seen.hashed(reduce(DataFrame.unionByName, parts, empty(spark, DAY_TRIPLE)))


def publish(
    spark: SparkSession, root: str, as_of: Day | None = None, table: str | None = None, keep: int = 2
) -> int:
    """Publish the lookup of all days, or as it stood after the run of ``as_of``.

    If the days published last are as they were, the days since are merged into the ranges they touch; all other files
    stay. ``table`` names a catalog table that is pointed at the new version. The last ``keep`` versions stay.
    """
    days = read_days(spark, root, RAW)
    if as_of is not None:
        number = publish_lookup(lookup_asof(days, as_of), root)
    else:
        states = day_states(spark, root)
        held, known = published_ranges(spark, root) or ([], {})
        if held and known and known.items() <= states.items():
            since = sorted(states.keys() - known.keys())
            added = days.where(F.col("ds").isin([as_day(day) for day in since]))
            number = publish_added(spark, root, held, added, states)
        else:
            number = publish_lookup(days, root, states, days.count())
    if table is not None:
        point_lookup_table(spark, table, root)
    drop_published(spark, root, keep)
    return number


def daily_run(
    spark: SparkSession, settings: Settings, ds: Day, lookback_days: int = 0, database: str | None = None
) -> int:
    """One whole run for the sources of a region and stage. Returns the published version.

    With ``database`` consumers find the days as its table ``lookup_raw`` and the lookup as ``lookup``.
    """
    if database is not None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    run_day(
        spark,
        settings.target_root,
        load_registry(settings),
        lambda name: read_source(spark, settings, name),
        ds,
        lookback_days,
        table=database and f"{database}.{RAW}",
    )
    return publish(spark, settings.target_root, table=database and f"{database}.{PUBLISHED}")

"""Wide sources to distinct (company, column, value) triples."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.days import Day, as_day, day_between
from shelfmark.schemas import TRIPLE_COLUMNS
from shelfmark.sources.registry import UNIVERSAL, SourceSpec


def long_values(df: DataFrame, spec: SourceSpec, *extra: str) -> DataFrame:
    """One row per value column of every row, without NULL values; ``extra`` columns ride along."""
    company = F.lit(UNIVERSAL) if spec.company is None else F.col(spec.company).cast("string")
    values = []
    for column in spec.values:
        value = F.col(column)
        if column in spec.keep:
            value = F.when(spec.keep[column](value), value)
        values.append(value.cast("string").alias(f"{spec.name}.{column}"))
    wide = df.select(company.alias("company_guid"), *extra, *values)
    tags = [f"`{spec.name}.{column}`" for column in spec.values]
    long = wide.unpivot(["company_guid", *extra], tags, "column_name", "column_value")
    return long.where(F.col("column_value").isNotNull())


def extract_values(
    df: DataFrame, spec: SourceSpec, start: Day | None = None, end: Day | None = None
) -> DataFrame:
    """Distinct triples of a source, for a dated source those of the days start..end, or up to ``end``.

    The source is scanned once for all its value columns, and duplicates collapse before the shuffle.
    """
    if spec.day_column is not None:
        if start is None and end is None:
            raise ValueError(f"{spec.name} is dated: name the day to extract")
        df = df.where(day_between(spec.day_column, start, end))
    return long_values(df, spec).distinct()


def extract_day(df: DataFrame, spec: SourceSpec, ds: Day, lookback_days: int = 0) -> DataFrame:
    """Triples for the run of one day; ``lookback_days`` also picks up rows that arrived late."""
    first = as_day(ds) - dt.timedelta(days=lookback_days)
    return extract_values(df, spec, first, ds)


def first_seen(
    df: DataFrame, spec: SourceSpec, start: Day | None = None, end: Day | None = None
) -> DataFrame:
    """Triples of all days, or of start..end, each with the first day it occurs on."""
    if spec.day_column is None:
        raise ValueError(f"{spec.name} is a snapshot and has no days")
    if start is not None or end is not None:
        df = df.where(day_between(spec.day_column, start, end))
    # A row without a day belongs to no run.
    dated = df.withColumn("ds", F.col(spec.day_column).cast("date")).where(F.col("ds").isNotNull())
    return long_values(dated, spec, "ds").groupBy(*TRIPLE_COLUMNS).agg(F.min("ds").alias("ds"))


def union_sources(triples: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, triples)


def incoming(triples: Iterable[DataFrame]) -> DataFrame:
    """Distinct triples over all sources of a run."""
    return union_sources(triples).select(*TRIPLE_COLUMNS).distinct()

"""Day predicates and day names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

Day = dt.date | str


def as_day(day: Day) -> dt.date:
    if isinstance(day, dt.datetime):
        return day.date()
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def day_between(column: Column | str, start: Day | None, end: Day | None = None) -> Column:
    """Rows whose day lies in the closed range start..end. Without ``start`` the range has no lower bound.

    Written as a half-open range on the bare column, so that it reaches the file scan for dates and
    for timestamps alike.
    """
    if start is None and end is None:
        raise ValueError("a range needs a start or an end")
    after = as_day(start if end is None else end) + dt.timedelta(days=1)
    column = F.col(column) if isinstance(column, str) else column
    until = column < F.lit(after)
    return until if start is None else (column >= F.lit(as_day(start))) & until


def partition_id(day: Column) -> Column:
    """Day as the yyyyMMdd name of its partition."""
    return F.date_format(day, "yyyyMMdd")


def define_run_day(spark: SparkSession, ds: Day) -> None:
    """The run day for SQL texts: ``run_date()`` and ``run_timestamp()`` in this session."""
    day = as_day(ds)
    for name, kind in (("run_date", "DATE"), ("run_timestamp", "TIMESTAMP")):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}() RETURNS {kind} RETURN {kind} '{day}'")

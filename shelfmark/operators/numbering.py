"""Numbering rows without one sort of all of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.session import fresh_dir
from shelfmark.sources.files import drop

#: Rows that one task sorts, about. Only speed depends on it.
STRETCH_ROWS = 500_000


def parts_for(spark: SparkSession, count: int, rows: int = STRETCH_ROWS) -> int | None:
    """How many partitions hold ``count`` rows by about ``rows``; None if one does."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // rows)) if count > rows else None


def spread(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """Rows dealt by ``keys`` before they are grouped or sorted by them.

    Else Spark deals them into a fixed number of partitions, or merges those up to a number of compressed bytes: a task then
    holds more the more rows there are, or the better they compress.
    """
    return df if parts is None else df.repartition(parts, *keys)


def ranged(df: DataFrame, order: Sequence[str], out: str, rows: int = STRETCH_ROWS) -> DataFrame:
    """Adds ``out``: the stretch a row is in, of about ``rows`` rows, counting up along ``order``.

    The result is written once and read back: what follows reads it several times and has to see the same stretches.
    The rows themselves are read three times: counted, sampled and dealt. Write costly ones first.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))
    folder = fresh_dir(spark, "stretches")
    dealt = df.repartitionByRange(parts, *order).withColumn(out, F.spark_partition_id())
    dealt.write.parquet(folder)
    return spark.read.schema(dealt.schema).parquet(folder)


def numbered(
    df: DataFrame, order: Sequence[str], out: str, by: Sequence[str] = (), rows: int = STRETCH_ROWS
) -> DataFrame:
    """Adds ``out``: the place of a row, from 1, along ``order`` among the rows with equal ``by``.

    Two levels: rows are numbered within stretches, which each task holds one of at a time, and start after what
    the stretches before hold, of which there is one count each. So a group may hold any share of the rows.
    Equal rows lie in one stretch. The rows are computed once. Only a group that goes on from the stretch before starts
    after the first place, one a stretch at most: few enough to broadcast.
    """
    stretch = "_stretch"
    staged = fresh_dir(df.sparkSession, "to-number")
    df.write.parquet(staged)
    dealt = ranged(df.sparkSession.read.schema(df.schema).parquet(staged), [*by, *order], stretch, rows)
    drop(df.sparkSession, staged)
    dealt = spread(dealt, parts_for(df.sparkSession, dealt.count(), rows), *by, stretch)
    within = F.row_number().over(Window.partitionBy(*by, stretch).orderBy(*order))
    sizes = dealt.groupBy(*by, stretch).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*by).orderBy(stretch).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*by, stretch, F.sum("_size").over(earlier).alias("_start")).where(F.col("_start") > 0)
    left, right = dealt.withColumn("_within", within).alias("rows"), F.broadcast(starts).alias("starts")
    same = reduce(Column.__and__, [F.col(f"rows.{c}").eqNullSafe(F.col(f"starts.{c}")) for c in (*by, stretch)])
    place = (F.coalesce("_start", F.lit(0)) + F.col("_within")).alias(out)
    return left.join(right, same, "left").select(*[f"rows.{c}" for c in df.columns], place)

"""A table of triples in ranges, of which a change rewrites only those that it touches.

Every range is a folder of sorted triples. A list of the ranges, with the least triple of each, makes a version of
the table; versions share the folders of ranges that did not change between them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from shelfmark.schemas import TRIPLE, TRIPLE_COLUMNS
from shelfmark.session import fresh_dir
from shelfmark.sources.files import drop

#: Triples of a range. One that grows to twice as many is cut.
RANGE_ROWS = 4_000_000
_NAMED = StructType([*TRIPLE.fields, StructField("range", StringType())])
_PLACED = StructType([*TRIPLE.fields, StructField("old", IntegerType())])


@dataclass(frozen=True)
class Range:
    name: str
    start: tuple[str | None, str, str]
    n: int

    def order(self) -> tuple:
        """NULL first, and texts in the order of their UTF-8 bytes, as Spark has them."""
        return tuple((value is not None, value or "") for value in self.start)


def folders(path: str, ranges: Sequence[Range]) -> list[str]:
    return [f"{path}/range={r.name}" for r in ranges]


def _sorted_by_name(spark: SparkSession, path: str, names: Column) -> list[Range]:
    """The ranges written last, whose names meet a condition, from one look at their triples."""
    held = spark.read.schema(_NAMED).parquet(path).where(names)
    least = held.groupBy("range").agg(F.min(F.struct(*TRIPLE_COLUMNS)).alias("start"), F.count(F.lit(1)).alias("n"))
    return sorted((Range(r["range"], tuple(r["start"]), r["n"]) for r in least.collect()), key=Range.order)


def _write(triples: DataFrame, path: str, name: Column) -> None:
    named = triples.withColumn("range", name).select(*TRIPLE_COLUMNS, "range")
    named.write.mode("append").partitionBy("range").parquet(path)


def write_all(triples: DataFrame, path: str, label: str, n: int | None = None) -> list[Range]:
    """All triples, each once, in new ranges: as many as ``n`` triples ask for, or as adaptive execution makes.

    The ranges span all three columns, so a company with a large share of the rows is cut into many, while every range
    still holds few companies. Equal triples meet in their range: dropping them needs no shuffle besides.
    """
    parts = [] if n is None else [max(1, -(-n // RANGE_ROWS))]
    dealt = triples.select(*TRIPLE_COLUMNS).repartitionByRange(*parts, *TRIPLE_COLUMNS).distinct()
    _write(dealt.sortWithinPartitions(*TRIPLE_COLUMNS), path, F.concat(F.lit(f"{label}-"), F.spark_partition_id()))
    return _sorted_by_name(triples.sparkSession, path, F.col("range").startswith(f"{label}-"))


def range_of(ranges: Sequence[Range]) -> Column:
    """In which of the ranges, in order, a triple belongs: a search by halves in a constant of the plan."""
    starts = F.array(*[F.struct(*[F.lit(v).cast("string").alias(c) for v, c in zip(r.start, TRIPLE_COLUMNS)]) for r in ranges])
    triple = F.struct(*TRIPLE_COLUMNS)
    steps = [1 << bit for bit in reversed(range(max(1, math.ceil(math.log2(len(ranges) + 1)))))]

    def step(at: Column, size: Column) -> Column:
        reached = at + size
        return F.when((reached < len(ranges)) & (F.get(starts, reached) <= triple), reached).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def merge(spark: SparkSession, path: str, ranges: Sequence[Range], added: DataFrame, label: str) -> list[Range]:
    """The ranges after triples were added. Ranges that nothing is added to keep their folders."""
    if not ranges:
        return write_all(added, path, label)
    work = fresh_dir(spark, "added-triples")
    added.select(*TRIPLE_COLUMNS, range_of(ranges).alias("old")).write.parquet(work)
    tagged = spark.read.schema(_PLACED).parquet(work)
    touched = {r["old"]: r["count"] for r in tagged.groupBy("old").count().collect()}  # at most one row a range
    if not touched:
        return list(ranges)
    names = spark.createDataFrame([(ranges[i].name, i) for i in touched], "range string, old int")
    read = spark.read.schema(_NAMED).option("basePath", path)
    held = read.parquet(*folders(path, [ranges[i] for i in touched])).join(F.broadcast(names), "range").drop("range")
    both = held.unionByName(tagged)
    large = [i for i, n in touched.items() if ranges[i].n + n > 2 * RANGE_ROWS]
    is_large, name = F.col("old").isin(large), F.concat(F.lit(f"{label}-"), "old")
    columns = ["old", *TRIPLE_COLUMNS]
    whole = both.where(~is_large).repartition("old").dropDuplicates(columns)
    _write(whole.sortWithinPartitions(*columns), path, name)
    if large:
        parts = -(-sum(ranges[i].n + touched[i] for i in large) // RANGE_ROWS) + 1
        cut = both.where(is_large).repartitionByRange(parts, *columns).dropDuplicates(columns)
        _write(cut.sortWithinPartitions(*columns), path, F.concat(name, F.lit("-"), F.spark_partition_id()))
    drop(spark, work)
    fresh = _sorted_by_name(spark, path, F.col("range").startswith(f"{label}-"))
    return sorted([r for i, r in enumerate(ranges) if i not in touched] + fresh, key=Range.order)

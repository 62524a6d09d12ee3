"""A log of records that several writers append to, each id once.

An append is a folder of rows, a small table of their ids in buckets by hash, and a commit that names the folder and the
buckets. What no commit names is not there. A writer looks for its ids in their own buckets only, writes what is
missing, and asks for the next commit. If another writer got it first and touched a bucket of its own, the ids are
looked for again; else the commit after it will do. So two writers of one id leave one record, in whatever order
they come, and a writer that dies leaves nothing that is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.bloom import key_hash
from shelfmark.operators.delta import unseen
from shelfmark.session import fresh_dir
from shelfmark.sources import commits
from shelfmark.sources.files import drop, listing
from shelfmark.sources.storage import empty

BUCKETS = 64
#: Every so many commits one lists all appends up to it.
LIST_EVERY = 64

_IDS = "id string, bucket int, append string"
#: The name of what lay in the folder before there were commits.
BEFORE = "before"


def bucket_of(key: Column) -> Column:
    return F.pmod(key_hash(key), F.lit(BUCKETS)).cast("int")


def appends(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """The number of the last commit, and the names of all appends up to it."""
    numbers = commits.numbers(spark, f"{path}/commits")
    names: list[str] = []
    for number in reversed(numbers):
        held = commits.read(spark, f"{path}/commits", number)
        names.append(held["append"])
        if "all" in held:
            names.extend(held["all"])
            break
    return (numbers[-1] if numbers else 0), names


def data_paths(spark: SparkSession, path: str) -> list[str]:
    """The folders of all appends. Files beside them count as long as there are no commits, or the first took them in."""
    number, names = appends(spark, path)
    paths = [f"{path}/data/append-{name}" for name in names if name != BEFORE]
    return paths + (_plain_files(spark, path) if BEFORE in names or not number else [])


def _plain_files(spark: SparkSession, path: str) -> list[str]:
    names = [name for name, _, _ in listing(spark, path)]
    return [f"{path}/{n}" for n in names if not n.startswith(("_", ".")) and n not in ("data", "ids", "commits")]


def known_ids(spark: SparkSession, path: str, buckets: Iterable[int]) -> DataFrame:
    """The ids that the log holds in some buckets. Other buckets are not opened."""
    _, names = appends(spark, path)
    there = {name for name, _, _ in listing(spark, f"{path}/ids")}
    paths = [f"{path}/ids/bucket={b}" for b in buckets if f"bucket={b}" in there]
    if not paths or not names:
        return empty(spark, "id string")
    held = spark.read.schema(_IDS).option("basePath", f"{path}/ids").parquet(*paths)
    committed = spark.createDataFrame([(name,) for name in names], "append string")
    return held.join(F.broadcast(committed), "append", "left_semi").select("id")


def _buckets(rows: DataFrame) -> list[int]:
    return sorted(r[0] for r in rows.select(bucket_of(F.col("id"))).distinct().collect())  # BUCKETS at most


def _write_ids(rows: DataFrame, path: str, name: str) -> None:
    ids = rows.select("id").distinct().withColumns({"bucket": bucket_of(F.col("id")), "append": F.lit(name)})
    ids.repartition("bucket").write.mode("append").partitionBy("bucket", "append").parquet(f"{path}/ids")


def _drop_append(spark: SparkSession, path: str, name: str, buckets: Iterable[int]) -> None:
    drop(spark, f"{path}/data/append-{name}")
    for bucket in buckets:
        drop(spark, f"{path}/ids/bucket={bucket}/append={name}")


def _commit(spark: SparkSession, path: str, number: int, name: str, buckets: list[int]) -> bool:
    content: dict = {"append": name, "buckets": buckets}
    if number % LIST_EVERY == 0:
        content["all"] = appends(spark, path)[1]
    return commits.commit(spark, f"{path}/commits", number, content)


def _adopt(spark: SparkSession, path: str, read_before: Callable[[list[str]], DataFrame] | None) -> None:
    """Take in the files that lie there without a commit."""
    if read_before is None or commits.numbers(spark, f"{path}/commits"):
        return
    if before := _plain_files(spark, path):
        rows = read_before(before).select("id")
        _write_ids(rows.where(F.col("id").isNotNull()), path, BEFORE)
        commits.commit(spark, f"{path}/commits", 1, {"append": BEFORE, "buckets": list(range(BUCKETS))})


def append_new(
    rows: DataFrame,
    path: str,
    write: Callable[[DataFrame, str], None],
    read_before: Callable[[list[str]], DataFrame] | None = None,
) -> int:
    """Append the rows whose ``id`` the log does not hold; all rows of an id come together.

    ``rows`` are read several times, ``write`` puts some into a folder. ``read_before`` reads files of records
    that are no appends yet. Returns the number of the commit, 0 if nothing was new.
    """
    spark = rows.sparkSession
    _adopt(spark, path, read_before)
    asked = _buckets(rows)
    while True:
        number = max(commits.numbers(spark, f"{path}/commits"), default=0)
        staged = fresh_dir(spark, "new-records")
        unseen(rows, known_ids(spark, path, asked), ["id"]).write.parquet(staged)
        fresh = spark.read.schema(rows.schema).parquet(staged)
        touched = _buckets(fresh)
        if not touched:
            drop(spark, staged)
            return 0
        name = uuid.uuid4().hex[:16]
        write(fresh, f"{path}/data/append-{name}")
        _write_ids(fresh, path, name)
        drop(spark, staged)
        number += 1
        while not _commit(spark, path, number, name, touched):
            if set(commits.read(spark, f"{path}/commits", number)["buckets"]) & set(touched):
                _drop_append(spark, path, name, touched)
                break
            number += 1
        else:
            return number

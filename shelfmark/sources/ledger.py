"""Which files of a source were read, so that a run takes those that are new, whatever the days in them.

The ledger holds path, time of change and length of every file that a finished run has read. A file that is written anew is
new again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.session import fresh_dir
from shelfmark.sources import commits
from shelfmark.sources.files import exists
from shelfmark.sources.storage import empty

_FILE = "path string, modificationTime timestamp, length bigint"
_KEY = ["path", "modificationTime", "length"]


def files_of(spark: SparkSession, source: str, name: str = "*") -> DataFrame:
    """Path, time of change and length of all files below a path whose names match. What is in them is not read."""
    if not exists(spark, source):
        return empty(spark, _FILE)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name)
    return reader.load(source).select(*_KEY)


def known_files(spark: SparkSession, ledger: str) -> DataFrame:
    """The files that finished runs have read."""
    runs = [commits.read(spark, f"{ledger}/commits", n)["run"] for n in commits.numbers(spark, f"{ledger}/commits")]
    return spark.read.schema(_FILE).parquet(*[f"{ledger}/{run}" for run in runs]) if runs else empty(spark, _FILE)


class NewFiles:
    """The files of a source that no finished run has read. They are settled when this is made.

    Read them, and say :meth:`done` when what was made of them is safe: a run that dies before finds them new again.
    """

    def __init__(self, spark: SparkSession, source: str, ledger: str, name: str = "*.parquet") -> None:
        self.spark, self.ledger = spark, ledger
        self.run = fresh_dir(spark, "run").rsplit("/", 1)[-1]
        new = files_of(spark, source, name).join(known_files(spark, ledger), _KEY, "left_anti")
        new.write.parquet(f"{ledger}/{self.run}")
        self.files = spark.read.schema(_FILE).parquet(f"{ledger}/{self.run}")

    def read(self, schema: StructType) -> DataFrame:
        """The rows of the new files. A reader needs their names: these pass through the driver, the rows don't."""
        paths = [row["path"] for row in self.files.select("path").collect()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else empty(self.spark, schema)

    def done(self) -> None:
        number, _ = commits.latest(self.spark, f"{self.ledger}/commits")
        while not commits.commit(self.spark, f"{self.ledger}/commits", number + 1, {"run": self.run}):
            number += 1

"""Never-seen triples as a stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelfmark.operators.extract import long_values
from shelfmark.sources import seen
from shelfmark.sources.files import exists
from shelfmark.sources.storage import empty
from shelfmark.streaming.jobs import each_batch
from shelfmark.schemas import TRIPLE, TRIPLE_COLUMNS
from shelfmark.sources.registry import SourceSpec


def new_values_stream(stream: DataFrame, spec: SourceSpec) -> DataFrame:
    """Each triple once, when it is first seen. The state is keyed by the whole triple, so no company
    is a hot key; keep it in RocksDB, since it grows with the lookup."""
    return long_values(stream, spec).dropDuplicates(list(TRIPLE_COLUMNS))


def _moment(batch: int) -> dt.date:
    """The index of keys counts in days; a stream has one for each batch, and one before for what it starts from."""
    return dt.date(1970, 1, 1) + dt.timedelta(days=batch + 1)


def continue_lookup(stream: DataFrame, spec: SourceSpec, known: DataFrame, root: str) -> StreamingQuery:
    """Triples of a stream that a lookup lacks, each once, below ``root``; :func:`read_new` reads them.

    The state is an index of key hashes with Bloom filters, seeded from the lookup when the stream starts for the
    first time: from then on the lookup is not read again, and a batch reads what its keys can hit. Output and state
    carry the number of the batch, so a batch that runs again after a failure replaces what it left.
    """
    state = f"{root}/state"

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if not seen.manifest(spark, state):
            seen.add(spark, state, known.select(*TRIPLE_COLUMNS), _moment(-1))
        seen.forget(spark, state, [_moment(number)])
        fresh = seen.hashed(long_values(batch, spec).distinct())
        new = seen.unknown(fresh, state, seen.manifest(spark, state), _moment(number - 1)).select(*TRIPLE_COLUMNS)
        new.write.mode("overwrite").parquet(f"{root}/new/batch={number}")
        seen.add(spark, state, spark.read.schema(TRIPLE).parquet(f"{root}/new/batch={number}"), _moment(number))

    return each_batch(stream, handle, f"{root}/checkpoint")


def read_new(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/new"
    return spark.read.schema(TRIPLE).parquet(path).select(*TRIPLE_COLUMNS) if exists(spark, path) else empty(spark, TRIPLE)

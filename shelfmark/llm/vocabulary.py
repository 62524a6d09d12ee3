"""Counts of the distinct tokens of a corpus, and the two ways to look them up.

The commonest tokens, HEAD at most, go to every worker. All others are joined: the rows that need them are
few, since most tokens of a text are common ones.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import chunks

#: Tokens that are broadcast, at most, and their greatest length in bytes: with their counts under 50 MB.
HEAD = 1 << 19
HEAD_BYTES = 64
#: Distinct tokens that a task counts before it passes the counts on.
HELD = 1 << 20


def token_counts(texts: DataFrame, split: Callable[[bytes], Iterable[bytes]]) -> DataFrame:
    """``token, n`` over all texts of the binary column ``t``: counted in each task, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            tokens = pa.array(list(counts.keys()), pa.binary()).cast(pa.string())
            out = pa.RecordBatch.from_arrays([tokens, pa.array(list(counts.values()), pa.int64())], names=["token", "n"])
            counts.clear()
            return out

        for batch in batches:
            for part in chunks(batch.column("t").to_pylist()):
                for text in part:
                    counts.update(split(text))
                if len(counts) > HELD:
                    yield flush()
        if counts:
            yield flush()

    return texts.mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _bin(n: Column) -> Column:
    """Eight bins for each doubling of a count."""
    return F.floor(F.log2(n.cast("double")) * 8).cast("int")


def head_from(table: DataFrame, most: int = HEAD) -> int:
    """The bin from which on the tokens of a table ``token, n`` are the head: ``most`` of them or fewer."""
    short = table.filter(F.octet_length("token") <= HEAD_BYTES)
    bins = sorted(
        ((r["bin"], r["c"]) for r in short.groupBy(_bin(F.col("n")).alias("bin")).agg(F.count("*").alias("c")).collect()),
        reverse=True,
    )
    total, start = 0, 1 << 30
    for number, count in bins:
        total += count
        if total > most:
            break
        start = number
    return start


def in_head(start: int) -> Column:
    """Whether a row ``token, n`` belongs to the head."""
    return (F.octet_length("token") <= HEAD_BYTES) & (_bin(F.col("n")) >= start)

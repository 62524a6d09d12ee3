"""What is new against what was seen before."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.bloom import blocks_for, filter_of, key_hash, may_hold
from shelfmark.functions.days import Day, as_day
from shelfmark.schemas import TRIPLE_COLUMNS
from shelfmark.sources.registry import UNIVERSAL

#: Keys that come in up to which their Bloom filter is broadcast: 40 bytes for 24 keys.
FILTER_KEYS = 1 << 25


def _same(left: str, right: str, keys: Sequence[str], nullable: Sequence[str]) -> Column:
    pairs = (
        F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
        if key in nullable
        else F.col(f"{left}.{key}") == F.col(f"{right}.{key}")
        for key in keys
    )
    return reduce(Column.__and__, pairs)


def hits(history: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of the history that may be in ``fresh``: all that are, and one in a hundred of the others.

    A Bloom filter of the size that the number of fresh rows asks for is broadcast, so the history is read but not
    shuffled. With more than FILTER_KEYS fresh rows, which are counted for that, the history is left whole: keep
    such a history by hash, as :mod:`shelfmark.sources.seen` does.
    """
    n = fresh.count()
    if n > FILTER_KEYS:
        return history.select(*keys)
    hashed = fresh.select(key_hash(*keys).alias("_key"))
    held = F.broadcast(filter_of(hashed, "_key", blocks_for(n)))
    tagged = history.select(*keys, key_hash(*keys).alias("_key"))
    return may_hold(tagged, "_key", held, blocks_for(n)).drop("_key")


def unseen(
    fresh: DataFrame, history: DataFrame, keys: Sequence[str], nullable: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``fresh`` whose keys are not in ``history``.

    The history is the large side and grows for ever. It is cut to what may come in before anything is
    shuffled; the anti-join that follows sees hits only. ``fresh`` is read three times.
    """
    known = hits(history, fresh, keys).distinct()
    return fresh.alias("fresh").join(
        known.alias("known"), _same("fresh", "known", keys, nullable), "left_anti"
    )


def new_values(incoming: DataFrame, history: DataFrame) -> DataFrame:
    """Distinct incoming triples that the history lacks; a NULL company equals a NULL company.

    Incoming triples and the history's hits are grouped in one shuffle, where equal triples collapse before they
    are sent.
    """
    found = hits(history, incoming, TRIPLE_COLUMNS)
    tagged = incoming.select(*TRIPLE_COLUMNS, F.lit(False).alias("known")).unionByName(
        found.select(*TRIPLE_COLUMNS, F.lit(True).alias("known"))
    )
    grouped = tagged.groupBy(*TRIPLE_COLUMNS).agg(F.bool_or("known").alias("known"))
    return grouped.where(~F.col("known")).drop("known")


def history_until(days: DataFrame, ds: Day, inclusive: bool = False) -> DataFrame:
    """Triples of the day partitions before ``ds``.

    ``inclusive`` also counts the run day itself as history. A second run of that day then finds
    nothing new, so use it only to reproduce that behaviour.
    """
    day = F.lit(as_day(ds))
    return days.where(F.col("ds") <= day if inclusive else F.col("ds") < day).select(*TRIPLE_COLUMNS)


def lookup_asof(days: DataFrame, ds: Day) -> DataFrame:
    """The lookup as it stood after the run of a day."""
    return history_until(days, ds, inclusive=True).distinct()


def lookup_values(lookup: DataFrame, company: str, column: str) -> DataFrame:
    """Values of a column that a company may use: its own and the universal ones."""
    return (
        lookup.where(F.col("company_guid").isin(company, UNIVERSAL) & (F.col("column_name") == column))
        .select("column_value")
        .distinct()
    )

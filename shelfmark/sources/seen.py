"""Keys seen before, kept by hash, so that a day reads only what its keys can hit.

The index beside the days of a triple table holds, for every key and day, two hashes of 64 bits. It is made of a few
generations. A generation is a folder of files by hash prefix, sorted by hash, and a Bloom filter of all its hashes. The
manifest, a series of numbered commits, tells which generations there are and for which days each is to be believed.

A run tests its keys against the filters first: what none holds is new, and no key of the history is read for
it. The others are looked for in the folders of their prefixes, in rounds of a bounded number of keys, which are
broadcast: the history is neither shuffled nor read beyond these folders. Generations small enough are broadcast
themselves. When generations become many, they are merged into one.

Days that the manifest does not name, as they were written since or by other means, are taken in first.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.bloom import FILTER, blocks_for, filter_of, key_hash, may_hold
from shelfmark.schemas import TRIPLE_COLUMNS
from shelfmark.session import fresh_dir
from shelfmark.sources import commits
from shelfmark.sources.files import drop, listing
from shelfmark.sources.storage import RAW, read_days

INDEX = "seen"
#: Generations beyond which all are merged.
MOST_GENERATIONS = 8
#: Keys of a generation that is broadcast whole and needs no filter.
BROADCAST_KEYS = 1 << 18
#: Keys of a hash prefix, about, and keys that are broadcast at a time.
PREFIX_KEYS = 1 << 20
ROUND_KEYS = 1 << 22
#: Keys whose filter may be broadcast, at 40 bytes for 24 keys.
FILTER_KEYS = 1 << 25

_KEYS = "h bigint, g bigint, ds date, prefix int"


@dataclass(frozen=True)
class Generation:
    generation: str
    days: tuple[dt.date, ...]
    n: int
    prefix_bits: int


def hashed(triples: DataFrame) -> DataFrame:
    """Adds the hashes ``h`` and ``g`` of a triple."""
    return triples.withColumns({"h": key_hash(*TRIPLE_COLUMNS), "g": key_hash(*TRIPLE_COLUMNS, seed=1)})


def manifest(spark: SparkSession, root: str) -> list[Generation]:
    _, held = commits.latest(spark, f"{root}/{INDEX}/manifest")
    dates = lambda days: tuple(dt.date.fromisoformat(day) for day in days)
    return [Generation(g["generation"], dates(g["days"]), g["n"], g["prefix_bits"]) for g in held or ()]


def _publish(spark: SparkSession, root: str, generations: Sequence[Generation]) -> None:
    path = f"{root}/{INDEX}/manifest"
    number, _ = commits.latest(spark, path)
    if not commits.commit(spark, path, number + 1, [asdict(g) | {"days": [str(d) for d in g.days]} for g in generations]):
        raise RuntimeError(f"two runs write to {root} at once")


def _folder(root: str, generation: Generation) -> str:
    return f"{root}/{INDEX}/{generation.generation}"


def _keys(spark: SparkSession, root: str, generation: Generation) -> DataFrame:
    """The keys of a generation for the days it is to be believed for."""
    keys = spark.read.schema(_KEYS).parquet(f"{_folder(root, generation)}/keys")
    return keys.where(F.col("ds").isin(list(generation.days)))


def _prefix(bits: int) -> Column:
    return (F.shiftrightunsigned("h", 64 - bits).cast("int") if bits else F.lit(0)).alias("prefix")


def _write(spark: SparkSession, root: str, keys: DataFrame, days: Sequence[dt.date]) -> Generation:
    """A new generation of keys ``h, g, ds``, which are read twice."""
    n = keys.count()
    bits = min(12, max(0, (n // PREFIX_KEYS).bit_length()))
    made = Generation(f"gen-{uuid.uuid4().hex[:12]}", tuple(sorted(days)), n, bits)
    dealt = keys.select("h", "g", "ds", _prefix(bits))
    dealt = dealt.repartitionByRange("prefix", "h") if bits else dealt.coalesce(1)
    dealt.sortWithinPartitions("prefix", "h").write.partitionBy("prefix").parquet(f"{_folder(root, made)}/keys")
    if n > BROADCAST_KEYS:
        filter_of(keys, "h", blocks_for(n)).write.parquet(f"{_folder(root, made)}/filter")
    return made


def forget(spark: SparkSession, root: str, days: Sequence[dt.date]) -> None:
    """Believe no generation for these days any more. To be called before they are written anew."""
    held, gone = manifest(spark, root), set(days)
    if any(gone & set(g.days) for g in held):
        _publish(spark, root, [replace(g, days=tuple(d for d in g.days if d not in gone)) for g in held])


def refresh(spark: SparkSession, root: str, name: str = RAW) -> list[Generation]:
    """Take in the days of the triple table that no generation holds, and merge generations that are many."""
    held = manifest(spark, root)
    known = {day for g in held for day in g.days}
    missing = sorted(set(day_folders(spark, f"{root}/{name}")) - known)
    for g in held:
        if not g.days:
            drop(spark, _folder(root, g))
    if not missing:
        return held
    rows = read_days(spark, root, name).where(F.col("ds").isin(missing))
    return _added(spark, root, [g for g in held if g.days], hashed(rows), missing)


def add(spark: SparkSession, root: str, triples: DataFrame, day: dt.date) -> list[Generation]:
    """Take in the triples of a day, which are read twice, and replace what was known of it."""
    forget(spark, root, [day])
    held = [g for g in manifest(spark, root) if g.days]
    return _added(spark, root, held, hashed(triples).withColumn("ds", F.lit(day)), [day])


def _added(
    spark: SparkSession, root: str, held: list[Generation], keys: DataFrame, days: Sequence[dt.date]
) -> list[Generation]:
    """The generations and one more; all are merged if they are many then."""
    held = [*held, _write(spark, root, keys.select("h", "g", "ds"), days)]
    old = held if len(held) > MOST_GENERATIONS else []
    if old:
        keys = reduce(DataFrame.unionByName, [_keys(spark, root, g).select("h", "g", "ds") for g in held])
        held = [_write(spark, root, keys, [day for g in held for day in g.days])]
    _publish(spark, root, held)
    for g in old:
        drop(spark, _folder(root, g))
    return held


def day_folders(spark: SparkSession, path: str) -> list[dt.date]:
    """The days that a triple table has folders for."""
    names = [name for name, _, _ in listing(spark, path)]
    return [dt.date.fromisoformat(n.removeprefix("ds=")) for n in names if n.startswith("ds=")]


def suspects(fresh: DataFrame, root: str, generation: Generation) -> DataFrame:
    """The fresh keys ``h, g`` that the filter of a generation may hold."""
    held = fresh.sparkSession.read.schema(FILTER).parquet(f"{_folder(root, generation)}/filter")
    if generation.n <= FILTER_KEYS:
        held = F.broadcast(held)
    return may_hold(fresh.select("h", "g"), "h", held, blocks_for(generation.n))


def among(rows: DataFrame, some: DataFrame) -> DataFrame:
    """The hashed rows that are among some hashed keys, which are counted. Few enough are broadcast as a filter first."""
    n = some.count()
    if n <= FILTER_KEYS:
        rows = may_hold(rows, "h", F.broadcast(filter_of(some, "h", blocks_for(n))), blocks_for(n))
    return rows.join(some.select("h", "g"), ["h", "g"], "left_semi")


def _rounds(counts: dict[tuple[int, int], int], most: int) -> list[list[tuple[int, int]]]:
    """Generations and prefixes in order, in rounds of at most ``most`` keys; one with more is a round of its own."""
    rounds, size = [], 0
    for place, n in sorted(counts.items()):
        if not rounds or size + n > most:
            rounds.append([])
            size = 0
        rounds[-1].append(place)
        size += n
    return rounds


def unknown(fresh: DataFrame, root: str, generations: Sequence[Generation], last: dt.date) -> DataFrame:
    """The hashed rows whose keys no day up to ``last`` has. ``fresh`` is read once for each large generation, and once."""
    live = [g for g in generations if g.n and g.days and min(g.days) <= last]
    until = F.col("ds") <= F.lit(last)
    small = [_keys(fresh.sparkSession, root, g).where(until).select("h", "g") for g in live if g.n <= BROADCAST_KEYS]
    if small:
        # At most MOST_GENERATIONS times BROADCAST_KEYS.
        fresh = fresh.join(F.broadcast(reduce(DataFrame.unionByName, small)), ["h", "g"], "left_anti")
    large = [g for g in live if g.n > BROADCAST_KEYS]
    return fresh.join(_known(fresh, root, large, last), ["h", "g"], "left_anti") if large else fresh


def _known(fresh: DataFrame, root: str, held: Sequence[Generation], last: dt.date) -> DataFrame:
    """Which of the fresh keys ``h, g`` the generations have."""
    spark = fresh.sparkSession
    work = fresh_dir(spark, "known-keys")
    found = [
        suspects(fresh, root, g).select("h", "g", _prefix(g.prefix_bits), F.lit(i).alias("of")) for i, g in enumerate(held)
    ]
    reduce(DataFrame.unionByName, found).write.parquet(f"{work}/suspects")
    found = spark.read.schema("h bigint, g bigint, prefix int, of int").parquet(f"{work}/suspects")
    # At most one row for each prefix of a generation, and there are 4096 prefixes at most.
    counts = {(r["of"], r["prefix"]): r["count"] for r in found.groupBy("of", "prefix").count().collect()}
    for places in _rounds(counts, ROUND_KEYS):
        hits = []
        small = sum(counts[place] for place in places) <= ROUND_KEYS
        for i in sorted({of for of, _ in places}):
            here = F.col("prefix").isin([prefix for of, prefix in places if of == i])
            asked = found.where((F.col("of") == i) & here).select("prefix", "h", "g")
            keys = _keys(spark, root, held[i]).where((F.col("ds") <= F.lit(last)) & here).select("h", "g", "prefix")
            hits.append(keys.join(F.broadcast(asked) if small else asked, ["prefix", "h", "g"], "left_semi"))
        reduce(DataFrame.unionByName, hits).select("h", "g").write.mode("append").parquet(f"{work}/known")
    schema = "h bigint, g bigint"
    return spark.read.schema(schema).parquet(f"{work}/known").distinct() if counts else spark.createDataFrame([], schema)


def new_triples(fresh: DataFrame, root: str, last: dt.date, name: str = RAW) -> DataFrame:
    """Distinct fresh triples that no day up to ``last`` has."""
    generations = refresh(fresh.sparkSession, root, name)
    new = unknown(hashed(fresh.select(*TRIPLE_COLUMNS)), root, generations, last)
    return new.dropDuplicates(["h", "g"]).select(*TRIPLE_COLUMNS)

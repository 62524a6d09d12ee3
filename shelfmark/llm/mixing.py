"""Mixing sources to target weights by thresholds on a hash.

Every document has a hash of 48 bits. A source whose target is ``whole`` times its size and a rest takes each
document ``whole`` times, and those below a threshold once more. The threshold comes from sums by source and
hash bucket: the bucket in which the running sum passes the rest is the boundary; only its rows are summed
again by the next bits, until the boundary is one hash value. Nothing is sorted but sums of buckets, and
all of it is DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import WORD, as_row, columns_of, free_name, from_row, read_table, stage

HASH_BITS = 48
#: Bits of the hash that one histogram resolves.
STEP_BITS = 12
WEIGHTS = (5, 2, 1)
MAX_TIMES = 3
#: Sources up to which what is found of each is broadcast.
FEW_SOURCES = 100_000


def n_words(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(doc_id: Column, text: Column) -> Column:
    """48 bits that depend on the id, or on the text where the id is NULL."""
    key = F.coalesce(doc_id.cast("string"), text, F.lit(""))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, max_times: int = MAX_TIMES, share: float = 1.0
) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    ``sized`` has ``source`` and ``size``. Sources in order of code points, NULL last, weigh ``weights``,
    repeating. They share ``share`` of all sizes; a target stops at ``max_times`` its source's size, and what
    is over is shared by weight among the others until none is above. In order of cap to weight the capped
    sources come first, so running sums over the sources (one row each) tell which they are.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int")
    ).cast("long")
    ranked = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_times)
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    zero = F.lit(0).cast("long")
    left = F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), zero)
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero)
    flagged = ranked.withColumn("capped", left * F.col("weight") >= F.col("cap") * open_weight).withColumn(
        "all_sizes", F.sum("source_size").over(everything)
    )
    kept = F.when(F.col("capped"), 0)
    spare = F.lit(share) * F.col("all_sizes") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(
        everything
    )
    weight_left = F.sum(kept.otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        F.try_divide(spare.cast("double") * F.col("weight"), weight_left.cast("double"))
    )
    return flagged.select("source", "source_size", target.alias("target"))


def source_cuts(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """The targets with ``whole`` (how often every document is taken) and ``cut``: hashes below it once more.

    The boundary hash itself is taken if that comes nearer to the target. Rows of equal hash (repeated ids)
    are taken together. Rows meet what is found of their source, a row of it each; the rows themselves take few
    bytes in files and many in memory, and are never broadcast.
    """
    few = targets.count() <= FEW_SOURCES
    whole = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size").cast("double"))), F.lit(0))
    plan = targets.withColumn("whole", whole.cast("long")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")
    )
    state = plan.select(F.col("source").alias("s"), F.lit(0).cast("long").alias("prefix"), "rest")
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        # Only rows whose leading bits are the boundary's.
        above = F.shiftright("hash", shift + STEP_BITS)
        state = F.broadcast(state) if few else state.hint("merge")
        inside = sized.join(state, sized["source"].eqNullSafe(state["s"]) & (above == state["prefix"])).select(
            "s", "rest", F.shiftright("hash", shift).alias("prefix"), "size"
        )
        sums = inside.groupBy("s", "rest", "prefix").agg(F.sum("size").alias("mass"))
        running = Window.partitionBy("s").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
        before = F.col("upto") - F.col("mass")
        state = (
            sums.withColumn("upto", F.sum("mass").over(running))
            .filter((before <= F.col("rest")) & (F.col("upto") > F.col("rest")))
            .select("s", "prefix", (F.col("rest") - before).alias("rest"), "mass")
        )
    cut = F.col("prefix") + F.when(F.col("rest") * 2 >= F.col("mass"), 1).otherwise(0)
    cuts = state.select("s", cut.cast("long").alias("cut"))
    return plan.join(cuts, plan["source"].eqNullSafe(cuts["s"]), "left").select(
        "source", "source_size", "target", "whole", F.coalesce("cut", F.lit(0)).cast("long").alias("cut")
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_times: int = MAX_TIMES,
    share: float = 1.0,
) -> DataFrame:
    """All rows and columns of ``docs`` with ``mix``: a struct of ``size, source_size, target, times, taken``.

    ``times`` says how often the mix takes the document, ``taken`` is ``times * size``. NULL sources are one
    source; NULL and empty texts have size 0; a table of such texts has targets 0; repeated rows are taken
    alike; an empty table gives an empty one. A column that is called ``mix`` already is kept beside
    ``mix_``. The sums come from a staged table of ids, sources and sizes; texts are not shuffled.
    """
    size, code = n_words(F.col(text)), document_hash(F.col(doc_id), F.col(text))
    sized = stage(
        docs.select(F.col(source).alias("source"), size.alias("size"), code.alias("hash")), "mix-sizes"
    )
    plan = source_cuts(sized, source_targets(sized, weights, max_times, share))
    plan = stage(plan, "mix-plan").select(F.col("source").alias("__s"), *"source_size target whole cut".split())
    # All columns of the rows travel in one struct, so no name of theirs can clash.
    rows = docs.select(
        as_row(docs).alias("__row"),
        F.col(source).alias("__source"),
        size.alias("__size"),
        code.alias("__hash"),
    )
    times = F.col("whole") + F.when(F.col("__hash") < F.col("cut"), 1).otherwise(0)
    mixed = F.struct(
        F.col("__size").alias("size"),
        "source_size",
        "target",
        times.cast("int").alias("times"),
        (times * F.col("__size")).cast("long").alias("taken"),
    )
    joined = rows.join(plan, F.col("__source").eqNullSafe(F.col("__s")), "left")
    return joined.select(
        *from_row("__row", docs), mixed.alias(free_name(docs, "mix"))
    )


def take(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as the mix has them: each as often as :func:`mix` takes it."""
    mixed = mix(docs, **options)
    name = free_name(docs, "mix")
    copy = free_name(mixed, "copy")
    repeated = mixed.filter(F.col(name)["times"] > 0).withColumn(
        copy, F.explode(F.array_repeat(F.lit(0), F.col(name)["times"]))
    )
    return repeated.select(*columns_of(docs))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 12) AS BIGINT) AS hash
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
         3 * source_size AS cap FROM totals),
flagged AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) * weight
            >= cap * (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS capped
  FROM ranked
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         CASE WHEN capped THEN CAST(cap AS DOUBLE)
              ELSE CAST(sum(source_size) OVER () - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS DOUBLE)
                   * weight / CAST(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS DOUBLE) END AS target
  FROM flagged),
plans AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target / source_size) AS BIGINT) END AS whole
  FROM targets),
sums AS (SELECT source, hash, sum(size) AS mass FROM sized GROUP BY source, hash),
running AS (SELECT *, sum(mass) OVER (PARTITION BY source ORDER BY hash) AS upto FROM sums),
cuts AS (
  SELECT r.source, hash + CASE WHEN (target - whole * source_size - (upto - mass)) * 2 >= mass THEN 1 ELSE 0 END AS cut
  FROM running r JOIN plans p ON r.source IS NOT DISTINCT FROM p.source
  WHERE upto - mass <= target - whole * source_size AND upto > target - whole * source_size)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (whole + CASE WHEN hash < coalesce(cut, 0) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized d JOIN plans p ON d.source IS NOT DISTINCT FROM p.source
LEFT JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source
"""

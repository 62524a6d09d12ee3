"""Carts over a stream of events.

Each micro-batch is folded like a table of events: the lines that its carts still hold come in as events, before all
others. What is submitted goes to the output, the lines that are left to the state.

The state is kept in buckets by hash of the cart, and in each bucket by batch: a batch writes the carts it moved, whole,
and what a later batch wrote of a cart replaces what an earlier one did. So a batch opens its own buckets only. When a
bucket has many batches, the next one that comes by writes all of its carts; the older folders go once that batch is
done. All folders carry the batch's number, so a batch that runs again after a failure replaces what it left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

from shelfmark.operators.cart import LARGE_CART, all_lines
from shelfmark.sources import commits
from shelfmark.sources.files import drop, exists, listing
from shelfmark.sources.storage import empty
from shelfmark.streaming.jobs import each_batch

SENT = StructType(
    [
        StructField("record_id", LongType()),
        StructField("cart_id", StringType()),
        StructField("submitted_at", TimestampNTZType()),
        StructField("person", StringType()),
        StructField("barcode", StringType()),
        StructField("qty", LongType()),
        StructField("added_at", TimestampNTZType()),
    ]
)
LIVE = StructType([f for f in SENT if f.name in ("cart_id", "barcode", "qty", "added_at")])
_STATE = StructType([*LIVE.fields, StructField("bucket", IntegerType()), StructField("batch", LongType())])
#: Buckets of a new state, and batches in a bucket at which it is folded.
BUCKETS = 64
FOLD_AT = 8


def sent_lines(spark: SparkSession, root: str) -> DataFrame:
    """Lines of the carts that were submitted so far."""
    path = f"{root}/sent"
    return spark.read.schema(SENT).parquet(path).select(*SENT.fieldNames()) if exists(spark, path) else empty(spark, SENT)


def live_lines(spark: SparkSession, root: str, batch: int) -> DataFrame:
    """Lines in the carts after a batch, the last one or the one before; before the first there are none."""
    buckets = [name for name, _, _ in listing(spark, f"{root}/live")]
    return _state(spark, root, buckets, batch).where(F.col("barcode").isNotNull()).select(*LIVE.fieldNames())


def _folders(spark: SparkSession, root: str, bucket: str) -> list[int]:
    """The batches that a bucket has folders of."""
    names = [name for name, _, _ in listing(spark, f"{root}/live/{bucket}")]
    return sorted(int(name.removeprefix("batch=")) for name in names if name.startswith("batch="))


def _state(spark: SparkSession, root: str, buckets: list[str], batch: int) -> DataFrame:
    """What the last batch up to ``batch`` wrote of each cart of some buckets. A cart that is empty has a row without barcode."""
    paths = [f"{root}/live/{bucket}" for bucket in buckets if exists(spark, f"{root}/live/{bucket}")]
    if not paths:
        return empty(spark, _STATE)
    rows = spark.read.schema(_STATE).option("basePath", f"{root}/live").parquet(*paths).where(F.col("batch") <= batch)
    last = rows.groupBy("cart_id").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["cart_id", "batch"], "left_semi")


def _buckets(spark: SparkSession, root: str, wanted: int) -> int:
    """How many buckets the state has; settled by whoever writes to it first."""
    commits.commit(spark, f"{root}/layout", 1, wanted)
    return commits.read(spark, f"{root}/layout", 1)


def _tidy(spark: SparkSession, root: str, batch: int) -> None:
    """Drop what an earlier attempt at a batch left, and the folders that a fold before it replaces."""
    for number in commits.numbers(spark, f"{root}/folds"):
        if number < batch:
            for bucket in commits.read(spark, f"{root}/folds", number):
                for old in _folders(spark, root, bucket):
                    if old < number:
                        drop(spark, f"{root}/live/{bucket}/batch={old}")
            drop(spark, f"{root}/folds/{number:012d}.json")
    for bucket, _, _ in listing(spark, f"{root}/live"):
        drop(spark, f"{root}/live/{bucket}/batch={batch}")


def fold_stream(
    events: DataFrame, root: str, large_cart: int = LARGE_CART, buckets: int = BUCKETS, fold_at: int = FOLD_AT
) -> StreamingQuery:
    """Fold a stream of cart events, in the order of the batches and within a batch by time."""

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        _tidy(spark, root, number)
        n_buckets = _buckets(spark, root, buckets)
        bucket = F.pmod(F.xxhash64("cart_id"), F.lit(n_buckets)).cast("int")
        columns = ["cart_id", "barcode", "ts", "event_id", "action", "person"]
        work = f"{root}/folded/{number}"
        known = batch.select(
            F.col("cart_id").cast("string"), "barcode", F.col("ts").cast("timestamp_ntz"), *columns[3:]
        ).where(F.col("cart_id").isNotNull())
        known.write.mode("overwrite").parquet(f"{work}/moved")
        moved = spark.read.schema(known.schema).parquet(f"{work}/moved")
        carts = moved.select("cart_id").distinct()
        names = [f"bucket={r[0]}" for r in moved.select(bucket).distinct().collect()]  # n_buckets at most
        state = _state(spark, root, names, number - 1)
        held = state.where(F.col("barcode").isNotNull()).join(carts, "cart_id", "left_semi").select(
            "cart_id", "barcode", F.lit("0001-01-01").cast("timestamp_ntz").alias("ts"),
            F.lit(-1).cast("bigint").alias("event_id"), F.lit("hold").alias("action"),
            F.lit(None).cast("string").alias("person"), F.col("qty").alias("held_qty"), F.col("added_at").alias("held_at"),
        )
        all_lines(held.unionByName(moved, allowMissingColumns=True), large_cart).write.mode("overwrite").parquet(f"{work}/lines")
        lines = spark.read.parquet(f"{work}/lines")
        sent = lines.where(F.col("record_id").isNotNull()).select(*SENT.fieldNames())
        sent.write.mode("overwrite").parquet(f"{root}/sent/batch={number}")
        live = lines.where(F.col("record_id").isNull()).select(*LIVE.fieldNames())
        emptied = carts.join(live.select("cart_id").distinct(), "cart_id", "left_anti")
        changed = live.unionByName(emptied, allowMissingColumns=True).withColumn("bucket", bucket)
        folded = [name for name in names if len(_folders(spark, root, name)) + 1 >= fold_at]
        if folded:
            others = state.where(F.col("bucket").isin([int(name.removeprefix("bucket=")) for name in folded]))
            others = others.where(F.col("barcode").isNotNull()).join(carts, "cart_id", "left_anti")
            changed = changed.unionByName(others.select(*changed.columns))
        # Buckets are spread by cart and barcode: a cart with most of the lines is written by many tasks.
        dealt = changed.withColumn("batch", F.lit(number)).repartition("bucket", F.pmod(F.xxhash64("barcode"), F.lit(8)))
        dealt.write.mode("append").partitionBy("bucket", "batch").parquet(f"{root}/live")
        if folded:
            commits.commit(spark, f"{root}/folds", number, folded)
        drop(spark, work)

    return each_batch(events, handle, f"{root}/checkpoint")

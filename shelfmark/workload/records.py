"""Cart and record queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.text import iso_text, minute_text
from shelfmark.operators import cart
from shelfmark.operators import records as ops
from shelfmark.operators.numbering import parts_for, spread
from shelfmark.plans import record_intake
from shelfmark.schemas import RECORD
from shelfmark.session import fresh_dir
from shelfmark.sources import documents
from shelfmark.streaming import ingest
from shelfmark.streaming import cart as stream_fold
from shelfmark.streaming.jobs import read_files, write_stream
from shelfmark.workload.tables import (
    CART_EVENTS_SQL,
    TALK_RECORDS_SQL,
    cart_events,
    cart_products,
    label_log,
    read,
    talk_records,
)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cart_events(read(spark, sf_dir, "events"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return talk_records(read(spark, sf_dir, "conversations"))


# ---- cart ----


def cart_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cart.cart_state(_events(spark, sf_dir), cart_products(spark, sf_dir))


def cart_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cart.cart_totals(cart_state(spark, sf_dir))


def submitted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cart.submitted_lines(_events(spark, sf_dir), cart_products(spark, sf_dir))


def build_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submitted carts as records, with their items as one text in the order they were added."""
    path = f"{fresh_dir(spark, 'cart')}/lines"
    submitted_lines(spark, sf_dir).write.parquet(path)
    lines = spark.read.parquet(path)
    records = cart.as_records(cart.build_records(lines, parts_for(spark, lines.count())))
    tags = F.transform(
        "items", lambda i: F.concat(i["name"], F.lit(" ×"), i["qty"].cast("string"), F.lit(" "), i["addedAt"])
    )
    return records.select("id", "person", "submittedAt", F.array_join(tags, ", ").alias("items_text"))


def cart_record_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all submitted carts in a log, after the same events were taken in twice."""
    root = fresh_dir(spark, "intake")
    for _ in range(2):
        record_intake.submit_carts(_events(spark, sf_dir), cart_products(spark, sf_dir), root)
    log = record_intake.read_log(spark, root)
    return log.select("id", "person", F.size("items").alias("n_items"))


def large_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carts that hold a third of all line items, and all others, each submitted once: one record each, of any size."""
    lines = read(spark, sf_dir, "lineitem")
    cart_id = F.when(F.col("l_orderkey") % 3 == 0, "0").otherwise(F.concat(F.lit("s"), "l_suppkey"))
    barcode = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    parts = parts_for(spark, lines.count())
    adds = spread(lines.select(
        cart_id.alias("cart_id"), barcode.alias("barcode"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"),
        F.lit(0).cast("bigint").alias("event_id"), F.lit("add").alias("action"), F.lit(None).cast("string").alias("person"),
    ), parts, "barcode").distinct()
    root = fresh_dir(spark, "large")
    adds.write.parquet(f"{root}/adds")
    adds = spark.read.schema(adds.schema).parquet(f"{root}/adds")
    submits = adds.select("cart_id").distinct().select(
        "cart_id", F.lit(None).cast("string").alias("barcode"), F.lit("2024-01-02").cast("timestamp_ntz").alias("ts"),
        F.abs(F.xxhash64("cart_id")).alias("event_id"), F.lit("submit").alias("action"), F.lit("bo").alias("person"),
    )
    # A line item may lie in several carts.
    products = spread(adds.select("barcode", F.upper("barcode").alias("name")), parts, "barcode").distinct()
    sent = cart.submitted_lines(adds.unionByName(submits), products)
    numbered = cart.record_lines(sent)
    numbered.write.parquet(f"{root}/lines")
    stored = spark.read.schema(numbered.schema).parquet(f"{root}/lines")
    ends = stored.groupBy("record_id", "cart_id", "person", "submitted_at").agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.max("line_no").cast("int").alias("last_line"),
        F.min_by("barcode", "line_no").alias("first"), F.max_by("barcode", "line_no").alias("last"),
    )
    # Only records of few lines become documents; the others are read from their lines.
    nested = cart.as_records(cart.build_records(cart.lines_to_nest(stored).drop("line_no"), parts)).select(
        "id", F.size("items").alias("n_items"), F.col("items")[0]["barcode"].alias("first_item"),
        F.element_at("items", -1)["barcode"].alias("last_item"),
    )
    both = ends.join(nested, F.col("record_id").cast("string") == F.col("id"), "left")
    return both.select(
        "cart_id", "person", iso_text(F.col("submitted_at")).alias("submittedAt"),
        F.coalesce("n_items", "n").alias("n_items"), "last_line",
        F.coalesce("first_item", "first").alias("first_barcode"), F.coalesce("last_item", "last").alias("last_barcode"),
    )


_LARGE_SQL = """
WITH adds AS (
    SELECT DISTINCT CASE WHEN l_orderkey % 3 = 0 THEN '0' ELSE 's' || l_suppkey END AS cart_id,
           l_orderkey || '-' || l_linenumber || '-' || l_partkey AS barcode FROM lineitem)
SELECT cart_id, 'bo' AS person, '2024-01-02T00:00:00.000Z' AS submittedAt, CAST(count(*) AS INTEGER) AS n_items,
       CAST(count(*) AS INTEGER) AS last_line, min(barcode) AS first_barcode, max(barcode) AS last_barcode
FROM adds GROUP BY cart_id
"""


# The fold as it is defined: event by event over the list of a line's events.
_LINES_SQL = f"""
WITH cart_events AS ({CART_EVENTS_SQL}),
rounds AS (SELECT *, count(*) FILTER (WHERE action = 'submit') OVER (
        PARTITION BY cart_id ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS round FROM cart_events),
submits AS (SELECT cart_id, round, event_id AS record_id, ts AS submitted_at, person
            FROM rounds WHERE action = 'submit'),
folded AS (
    SELECT cart_id, round, barcode, list_reduce(
        list(struct_pack(action := action, ts := ts, qty := CAST(0 AS BIGINT),
                         added_at := CAST(NULL AS TIMESTAMP)) ORDER BY ts, event_id),
        lambda line, event: CASE
            WHEN event.action = 'add' AND line.qty = 0
                THEN struct_pack(action := '', ts := event.ts, qty := CAST(1 AS BIGINT), added_at := event.ts)
            WHEN event.action = 'del' OR line.qty = 0 OR (event.action = 'dec' AND line.qty = 1)
                THEN struct_pack(action := '', ts := event.ts, qty := CAST(0 AS BIGINT),
                                 added_at := CAST(NULL AS TIMESTAMP))
            ELSE struct_pack(action := '', ts := event.ts, added_at := line.added_at,
                             qty := CAST(line.qty + CASE event.action WHEN 'dec' THEN -1 ELSE 1 END AS BIGINT))
                 END,
        struct_pack(action := '', ts := CAST(NULL AS TIMESTAMP), qty := CAST(0 AS BIGINT),
                    added_at := CAST(NULL AS TIMESTAMP))) AS line
    FROM rounds WHERE action IN ('add', 'inc', 'dec', 'del') GROUP BY cart_id, round, barcode),
lines AS (
    SELECT record_id, cart_id, submitted_at, submits.person AS person, barcode, n_name AS name, line.qty AS qty,
           line.added_at AS added_at
    FROM folded JOIN nation ON barcode = CAST(n_nationkey AS VARCHAR)
    LEFT JOIN submits USING (cart_id, round) WHERE line.qty > 0)
"""
_LIVE_SQL = f"{_LINES_SQL} SELECT cart_id, barcode, name, qty, added_at FROM lines WHERE record_id IS NULL"
_SENT_SQL = f"{_LINES_SQL} SELECT * FROM lines WHERE record_id IS NOT NULL"


def stream_cart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submitted lines out of a stream of the events."""
    root = fresh_dir(spark, "stream-cart")
    stream = read_files(spark, sf_dir, "events.parquet")
    stream_fold.fold_stream(cart_events(stream), root).awaitTermination()
    return stream_fold.sent_lines(spark, root).join(cart_products(spark, sf_dir), "barcode")


# ---- records ----


def validate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid and rejected records by person."""
    records = _records(spark, sf_dir)
    # Persons of white space of many kinds, which count as none.
    blank = F.when(F.col("seq") % 5 == 3, "\u3000").when(F.col("seq") % 5 == 4, "\t\n\xa0")
    valid, rejected = ops.validate_records(records.withColumn("person", F.coalesce(blank, "person")))
    both = valid.withColumn("is_valid", F.lit(True)).unionByName(
        rejected.withColumn("is_valid", F.lit(False))
    )
    return both.groupBy("person", "is_valid").agg(F.count(F.lit(1)).alias("n"))


def _flat(records: DataFrame) -> DataFrame:
    names = F.transform("items", lambda item: item["name"])
    return records.select("id", "person", "submittedAt", "seq", F.array_join(names, "\n").alias("names"))


_FLAT = "id, person, submittedAt, seq, array_to_string(names, chr(10)) AS names"


def dedupe_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(ops.dedupe_records(_records(spark, sf_dir), "seq"))


def append_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First valid records of conversations whose id is in no label."""
    valid, _ = ops.validate_records(_records(spark, sf_dir))
    return _flat(ops.append_idempotent(valid, label_log(spark, sf_dir), "seq"))


def duplicate_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn with the answer its append gets."""
    turns = _records(spark, sf_dir).withColumn("at", F.struct("submittedAt", "id"))
    flagged = ops.with_duplicate_flag(turns, label_log(spark, sf_dir), "at")
    return flagged.select("id", "seq", "duplicate")


def merge_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns as the saved records, all others as those that waited."""
    records = _records(spark, sf_dir)
    saves = F.coalesce(F.col("person") == "assistant", F.lit(False))
    saved, pending = records.where(saves), records.where(~saves)
    return _flat(ops.merge_pending(saved, pending, "seq"))


def records_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records; the times of some are no times."""
    unclear = F.when(F.col("seq") % 7 == 2, "yesterday").when(F.col("seq") % 7 == 5, "")
    records = _records(spark, sf_dir)
    return ops.records_report(records.withColumn("submittedAt", F.coalesce(unclear, "submittedAt")))


def shanghai_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per hour of day and person, on the clock of another zone."""
    local = minute_text(F.col("submittedAt"), "Asia/Shanghai")
    hour = F.substring(local, 12, 2).alias("hour")
    return _records(spark, sf_dir).groupBy(hour, "person").agg(F.count(F.lit(1)).alias("n"))


def parse_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that parse and that do not: records, other JSON, and texts."""
    turns = read(spark, sf_dir, "conversations")
    lines = (
        talk_records(turns).select(F.lit("record").alias("kind"),
                                   F.to_json(F.struct(*RECORD.fieldNames())).alias("line"))
        .unionByName(read(spark, sf_dir, "events").select(F.lit("event").alias("kind"),
                                                          F.col("props").alias("line")))
        .unionByName(turns.select(F.lit("text").alias("kind"), F.col("text").alias("line")))
    )
    parsed = documents.parse_records(lines, "line")
    return parsed.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_malformed").alias("n_malformed"),
        F.sum(F.coalesce(F.size("record.items"), F.lit(0))).alias("n_items"),
    )


def mixed_record_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of many shapes, read, saved again and read back; and how many rows each way of reading gives."""
    root = fresh_dir(spark, "shapes")
    key = F.concat_ws("-", "conv_id", "turn")
    shape = F.col("turn") % 6
    start = F.concat(F.lit('{"id":"'), key, F.lit('","person":"'), F.col("role"), F.lit('"'))
    free = '[{"name":"n","note":{"a":[1,null]},"qty":0.5}]'
    line = (
        F.when(shape == 0, F.concat(start, F.lit(',"items":[{"barcode":"b","name":"n","qty":2}]}')))
        .when(shape == 1, F.concat(start, F.lit(',"items":5}')))
        .when(shape == 2, F.concat(start, F.lit(',"items":[3,null]}')))
        .when(shape == 3, F.concat(start, F.lit(f',"items":{free}}}')))
        .when(shape == 4, F.concat(start, F.lit(',"items":[')))
        .otherwise(F.concat(F.lit("\t"), start, F.lit("} ")))
    )
    read(spark, sf_dir, "conversations").select(line.alias("value")).write.text(f"{root}/first")
    first = documents.read_records(spark, f"{root}/first")
    documents.append_records(first, f"{root}/second")
    second = documents.read_records(spark, f"{root}/second")
    counts = [
        first.select("id").agg(F.count(F.lit(1))).scalar().alias("n_ids"),
        first.agg(F.count(F.lit(1))).scalar().alias("n_rows"),
        F.lit(first.count()).alias("n_counted"),
    ]
    return second.select(
        "id", "person", F.size("items").alias("n_items"), F.col("items")[0]["qty"].alias("qty"), "body", *counts
    )


_SHAPES_SQL = """
WITH lines AS (SELECT conv_id || '-' || turn AS id, role AS person, turn % 6 AS shape FROM conversations
               WHERE turn % 6 <> 4 AND conv_id IS NOT NULL AND turn IS NOT NULL AND role IS NOT NULL)
SELECT id, person, CAST(CASE shape WHEN 0 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 1 END AS INTEGER) AS n_items,
       CAST(CASE shape WHEN 0 THEN 2 END AS BIGINT) AS qty,
       CASE shape WHEN 0 THEN '[{"barcode":"b","name":"n","qty":2}]' WHEN 1 THEN '5' WHEN 2 THEN '[3,null]'
                  WHEN 3 THEN '[{"name":"n","note":{"a":[1,null]},"qty":0.5}]' END AS body,
       (SELECT count(*) FROM lines) AS n_ids, (SELECT count(*) FROM lines) AS n_rows,
       (SELECT count(*) FROM lines) AS n_counted
FROM lines
"""


def malformed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad lines of a log of texts, some of which are JSON."""
    path = f"{fresh_dir(spark, 'lines')}/log"
    texts = read(spark, sf_dir, "conversations").select(F.replace("text", F.lit("\n"), F.lit(" ")).alias("value"))
    props = read(spark, sf_dir, "events").select(F.col("props").alias("value"))
    texts.unionByName(props).write.text(path)
    return documents.malformed_records(spark, path)


def stamped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by whether the time of saving lies between the query's start and its end, in UTC."""
    before = dt.datetime.now(dt.timezone.utc)
    path = f"{fresh_dir(spark, 'stamped')}/records"
    ops.stamp(_records(spark, sf_dir)).write.parquet(path)
    after = dt.datetime.now(dt.timezone.utc) + dt.timedelta(seconds=1)
    saved = F.col("savedAt").cast("timestamp")
    in_time = (saved >= F.lit(before)) & (saved <= F.lit(after)) & F.col("savedAt").endswith("+00:00")
    return spark.read.parquet(path).groupBy(in_time.alias("in_time"), "person").agg(F.count(F.lit(1)).alias("n"))


def random_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records there are, and how many ids they get."""
    records = ops.with_random_id(_records(spark, sf_dir).drop("id"))
    return records.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"))


def record_log_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records appended as JSON lines in two portions and read back."""
    path = f"{fresh_dir(spark, 'records')}/log"
    valid, rejected = ops.validate_records(_records(spark, sf_dir))
    for portion in (valid, rejected):
        documents.append_records(ops.stamp(portion).drop("seq"), path)
    log = documents.read_records(spark, path)
    names = F.transform("items", lambda item: item["name"])
    return log.select("id", "person", "submittedAt", F.array_join(names, "\n").alias("names"))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid records of two streams with the same content, taken in one after the other."""
    root = fresh_dir(spark, "stream-ingest")
    for delivery in ("first", "second"):
        stream = talk_records(read_files(spark, sf_dir, "conversations.parquet"))
        ingest.ingest_records(
            stream, f"{root}/log", f"{root}/checkpoint-{delivery}", "seq"
        ).awaitTermination()
    names = F.transform("items", lambda item: item["name"])
    log = ingest.read_log(spark, f"{root}/log")
    return log.select("id", "person", "submittedAt", F.array_join(names, "\n").alias("names"))


def stream_distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the valid records of a stream, deduplicated in the state store."""
    root = fresh_dir(spark, "stream-distinct")
    stream = talk_records(read_files(spark, sf_dir, "conversations.parquet"))
    records = ingest.distinct_records(stream).select("id")
    write_stream(records, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


_TALK = f"talk AS ({TALK_RECORDS_SQL})"
_FIRST = "row_number() OVER (PARTITION BY id ORDER BY seq) = 1"

QUERIES = {
    f.__name__: f
    for f in (
        cart_state, cart_totals, submitted_lines, build_records, cart_record_log, stream_cart,
        large_records, random_ids, stamped_records, mixed_record_shapes, malformed_records, validate_records,
        dedupe_records, append_idempotent, duplicate_flags, merge_pending, records_report,
        shanghai_report, parse_records, record_log_round_trip, stream_ingest,
        stream_distinct_ids,
    )
}

ORACLE = {
    "cart_state": _LIVE_SQL,
    "cart_totals": f"""{_LINES_SQL} SELECT cart_id, CAST(sum(qty) AS BIGINT) AS total_qty, count(*) AS n_lines
        FROM lines WHERE record_id IS NULL GROUP BY 1""",
    "submitted_lines": _SENT_SQL,
    "build_records": f"""{_LINES_SQL} SELECT CAST(record_id AS VARCHAR) AS id, person,
        strftime(any_value(submitted_at), '%Y-%m-%dT%H:%M:%S.%gZ') AS submittedAt,
        string_agg(name || ' ×' || qty || ' ' || strftime(added_at, '%Y-%m-%dT%H:%M:%S.%gZ'), ', '
                   ORDER BY added_at, barcode) AS items_text
        FROM lines WHERE record_id IS NOT NULL GROUP BY record_id, person""",
    "cart_record_log": f"""{_LINES_SQL} SELECT CAST(record_id AS VARCHAR) AS id, person,
        CAST(count(*) AS INTEGER) AS n_items FROM lines WHERE record_id IS NOT NULL GROUP BY record_id, person""",
    "stream_cart": _SENT_SQL,
    "large_records": _LARGE_SQL,
    "mixed_record_shapes": _SHAPES_SQL,
    "stamped_records": "SELECT TRUE AS in_time, role AS person, count(*) AS n FROM conversations GROUP BY role",
    "random_ids": "SELECT count(*) AS n, count(*) AS n_ids FROM conversations",
    "malformed_records": """
        SELECT replace(text, chr(10), ' ') AS line FROM conversations WHERE NOT json_valid(text)""",
    "validate_records": f"""WITH {_TALK}
        SELECT CASE seq % 5 WHEN 3 THEN chr(12288) WHEN 4 THEN chr(9) || chr(10) || chr(160) ELSE person END AS person,
               coalesce(len(names) > 0 AND seq % 5 < 3, FALSE) AS is_valid, count(*) AS n FROM talk GROUP BY ALL""",
    "dedupe_records": f"WITH {_TALK} SELECT {_FLAT} FROM talk QUALIFY {_FIRST}",
    "append_idempotent": f"""WITH {_TALK} SELECT {_FLAT} FROM talk
        WHERE len(names) > 0 AND id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels) QUALIFY {_FIRST}""",
    "duplicate_flags": f"""WITH {_TALK} SELECT id, seq,
        NOT {_FIRST} OR id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels) AS duplicate FROM talk""",
    "merge_pending": f"""WITH {_TALK} SELECT {_FLAT} FROM talk
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY person IS NOT DISTINCT FROM 'assistant' DESC, seq) = 1""",
    "records_report": f"""WITH {_TALK}, named AS (
            SELECT *, list_transform(names, lambda n: n || ' ×' || len(string_split(n, ' '))) AS tags FROM talk)
        SELECT id, person, CASE seq % 7 WHEN 2 THEN 'yesterday' WHEN 5 THEN '' ELSE replace(left(submittedAt, 16), 'T', ' ') END AS submitted,
               CAST(len(names) AS INTEGER) AS n_items, array_to_string(tags, ', ') AS items_text FROM named""",
    "shanghai_report": f"""WITH {_TALK}
        SELECT strftime(CAST(left(submittedAt, 16) AS TIMESTAMP) + INTERVAL 8 HOUR, '%H') AS hour, person,
               count(*) AS n FROM talk GROUP BY ALL""",
    "parse_records": f"""WITH {_TALK}
        SELECT 'record' AS kind, count(*) AS n, CAST(0 AS BIGINT) AS n_malformed,
               CAST(sum(len(names)) AS BIGINT) AS n_items FROM talk
        UNION ALL SELECT 'event', count(*), count(*) FILTER (WHERE NOT json_valid(props)), 0
                  FROM events WHERE props IS NOT NULL
        UNION ALL SELECT 'text', count(*), count(*) FILTER (WHERE NOT json_valid(text)), 0
                  FROM conversations WHERE trim(text) <> ''""",
    "record_log_round_trip": f"""WITH {_TALK}
        SELECT id, person, submittedAt, array_to_string(names, chr(10)) AS names FROM talk""",
    "stream_ingest": f"""WITH {_TALK}
        SELECT id, person, submittedAt, array_to_string(names, chr(10)) AS names
        FROM talk WHERE len(names) > 0 QUALIFY {_FIRST}""",
    "stream_distinct_ids": f"WITH {_TALK} SELECT DISTINCT id FROM talk WHERE len(names) > 0",
}

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfmark.operators import cart, extract
from shelfmark.schemas import TRIPLE
from shelfmark.sources import seen
from shelfmark.streaming import ingest
from shelfmark.streaming.cart import fold_stream, live_lines, sent_lines
from shelfmark.streaming.jobs import read_files, write_stream
from shelfmark.streaming.lookup import continue_lookup, new_values_stream, read_new
from shelfmark.workload.tables import SPECS
from test_cart import EVENT, random_events
from test_records import ITEM, make


def run(stream, root):
    write_stream(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()


def test_ingest_over_batches_and_restarts(spark, tmp_path):
    source, log = str(tmp_path / "in"), str(tmp_path / "log")

    def deliver(*data):
        make(spark, *data).coalesce(1).write.mode("append").parquet(source)

    def take_in(checkpoint):
        stream = read_files(spark, source, "*.parquet", per_batch=1)
        ingest.ingest_records(stream, log, str(tmp_path / checkpoint), "seq").awaitTermination()

    deliver(("1", "first", [ITEM], 0), ("1", "again", [ITEM], 1), ("2", "two", [], 2))
    take_in("c1")
    deliver(("1", "third time", [ITEM], 3), ("2", "two", [ITEM], 4))
    take_in("c1")
    expected = [("1", "first"), ("2", "two")]
    assert rows(ingest.read_log(spark, log), "id", "person") == expected
    # A lost checkpoint delivers everything again.
    take_in("c2")
    assert rows(ingest.read_log(spark, log), "id", "person") == expected


def test_table_that_is_a_folder(spark, tmp_path):
    """A table may be one file or a folder of files; nothing else that lies beside it is read."""
    folder = f"{tmp_path}/in"
    for seq in range(2):
        make(spark, (str(seq), "a", [ITEM], seq)).coalesce(1).write.mode("append").parquet(f"{folder}/talk.parquet")
    make(spark, ("9", "a", [ITEM], 9)).coalesce(1).write.parquet(f"{folder}/other.parquet")
    run(ingest.distinct_records(read_files(spark, folder, "talk.parquet")), str(tmp_path / "distinct"))
    assert rows(spark.read.parquet(f"{tmp_path}/distinct/out"), "id") == [("0",), ("1",)]
    log = str(tmp_path / "log")
    ingest.ingest_records(read_files(spark, folder, "talk.parquet"), log, str(tmp_path / "c"), "seq").awaitTermination()
    assert rows(ingest.read_log(spark, log), "id") == [("0",), ("1",)]


def test_distinct_records(spark, tmp_path):
    source = str(tmp_path / "in")
    for seq in range(2):
        make(spark, ("1", "a", [ITEM], seq), (str(seq), "b", [ITEM], seq), ("9", "", [ITEM], seq)).withColumn(
            "arrived", F.timestamp_seconds(F.lit(1_700_000_000 + seq))
        ).coalesce(1).write.mode("append").parquet(source)
    for arrived in (None, "arrived"):
        root = str(tmp_path / str(arrived))
        run(ingest.distinct_records(read_files(spark, source, "*.parquet", 1), arrived), root)
        assert rows(spark.read.parquet(f"{root}/out"), "id") == [("0",), ("1",)]


def test_new_values_come_once(spark, tmp_path):
    source, spec = str(tmp_path / "in"), SPECS["events"]
    for part in range(3):
        spark.range(50).select(
            F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"),
            F.when(F.col("id") > 5, F.col("id") % (part + 2)).alias("user_id"),
            F.lit("view").alias("event_type"),
            F.concat(F.lit("p"), F.col("id") % 4).alias("props"),
        ).coalesce(1).write.mode("append").parquet(source)
    run(new_values_stream(read_files(spark, source, "*.parquet", 1), spec), str(tmp_path))
    batch = extract.extract_values(spark.read.parquet(source), spec, "2024-01-01")
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(batch)


@pytest.mark.parametrize("per_batch", [1, 10])
def test_cart_stream_equals_the_batch(spark, tmp_path, per_batch):
    source = str(tmp_path / "in")
    events = sorted(random_events(11, 300, [5, 4, 6, 1, 0.5, 0.1]), key=lambda e: e[3])
    for start in range(0, 300, 100):
        spark.createDataFrame(events[start : start + 100], EVENT).coalesce(1).write.mode("append").parquet(source)
    root = str(tmp_path / "carts")
    fold_stream(read_files(spark, source, "*.parquet", per_batch), root).awaitTermination()
    known = spark.createDataFrame([(b, b) for b in ("x", "y", "z", "unknown")], "barcode string, name string")
    columns = ("record_id", "cart_id", "person", "barcode", "qty", "added_at", "submitted_at")
    batch = cart.submitted_lines(spark.read.parquet(source), known)
    found = sent_lines(spark, root).where("barcode in ('x', 'y', 'z', 'unknown')")
    assert rows(found, *columns) == rows(batch, *columns)
    live = rows(cart.cart_state(spark.read.parquet(source), known), "cart_id", "barcode", "qty", "added_at")
    last = {1: 2, 10: 0}[per_batch]
    assert rows(live_lines(spark, root, last), "cart_id", "barcode", "qty", "added_at") == live
    # Nothing new, nothing changed.
    fold_stream(read_files(spark, source, "*.parquet", per_batch), root).awaitTermination()
    assert rows(sent_lines(spark, root), *columns) == rows(batch, *columns)


def test_a_batch_opens_its_own_buckets(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "carts")
    start = dt.datetime(2024, 1, 1)
    number = 0

    def deliver(*events):
        nonlocal number
        data = []
        for cart_id, barcode, action, person in events:
            number += 1
            data.append((cart_id, barcode, start + dt.timedelta(seconds=number), number, action, person))
        spark.createDataFrame(data, EVENT).coalesce(1).write.mode("append").parquet(source)
        fold_stream(read_files(spark, source, "*.parquet", 1), root, buckets=5, fold_at=3).awaitTermination()

    def files():
        return {str(p.relative_to(root)) for p in (tmp_path / "carts" / "live").rglob("*.parquet")}

    deliver(*[(f"c{i}", "x", "add", None) for i in range(20)])
    first = files()
    assert len({f.split("/")[1] for f in first}) == 5
    for batch in range(1, 6):
        before = files()
        deliver(("c0", "y", "inc" if batch % 2 else "add", None), ("c0", "x", "inc", None))
        # Files of the four other buckets are the same; those of its own are few.
        own = {f.split("/")[1] for f in files() - before}
        assert len(own) == 1 and first - files() <= {f for f in first if f.split("/")[1] in own}
        assert len({f.split("/")[2] for f in files() if f.split("/")[1] in own}) <= 4
    deliver(("c0", None, "submit", "bo"), ("c1", "x", "del", None), (None, "x", "add", None))
    live = {(r["cart_id"], r["barcode"]): r["qty"] for r in live_lines(spark, root, 6).collect()}
    assert live == {(f"c{i}", "x"): 1 for i in range(2, 20)}
    sent = {(r["cart_id"], r["barcode"]): r["qty"] for r in sent_lines(spark, root).collect()}
    assert sent == {("c0", "x"): 6, ("c0", "y"): 4}


def test_a_batch_that_runs_again_leaves_the_same(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "carts")
    events = sorted(random_events(5, 200, [5, 4, 6, 1, 0.5, 0.1]), key=lambda e: e[3])
    known = spark.createDataFrame([(b, b) for b in ("x", "y", "z", "unknown")], "barcode string, name string")
    for batch, at in enumerate(range(0, 200, 50)):
        spark.createDataFrame(events[at : at + 50], EVENT).coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):
            fold_stream(read_files(spark, source, "*.parquet", 1), root, buckets=2, fold_at=2).awaitTermination()
            # The mark that the batch is done gets lost: it runs once more.
            done = tmp_path / "carts" / "checkpoint" / "commits"
            for name in (str(batch), f".{batch}.crc"):
                (done / name).unlink(missing_ok=True)
        fold_stream(read_files(spark, source, "*.parquet", 1), root, buckets=2, fold_at=2).awaitTermination()
        state = cart.cart_state(spark.read.parquet(source), known)
        assert rows(live_lines(spark, root, batch), "cart_id", "barcode", "qty", "added_at") == rows(
            state, "cart_id", "barcode", "qty", "added_at")


def test_a_stream_goes_on_from_a_lookup(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(seen, "MOST_GENERATIONS", 3)
    monkeypatch.setattr(seen, "BROADCAST_KEYS", 4)
    source, spec, root = str(tmp_path / "in"), SPECS["events"], str(tmp_path / "out")
    known = spark.createDataFrame([("1", "events.props", "p0"), (None, "events.event_type", "view")], TRIPLE)
    for part in range(5):
        spark.range(10 * part, 10 * part + 30).select(
            F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"),
            F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("user_id"), F.lit("view").alias("event_type"),
            F.concat(F.lit("p"), F.col("id") % 9).alias("props"),
        ).coalesce(1).write.mode("append").parquet(source)
        continue_lookup(read_files(spark, source, "*.parquet", 1), spec, known, root).awaitTermination()
        if part == 2:
            # The mark that the batch is done gets lost: it runs once more.
            for name in ("2", ".2.crc"):
                (tmp_path / "out" / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    batch = extract.extract_values(spark.read.parquet(source), spec, "2024-01-01")
    want = sorted(set(rows(batch)) - set(rows(known)), key=str)
    assert sorted(rows(read_new(spark, root)), key=str) == want
    assert len(seen.manifest(spark, f"{root}/state")) <= 3

"""Appends by several writers, ids in buckets, records of any size."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import rows
from test_cart import EVENT
from test_records import ITEM, make

from shelfmark.operators import cart
from shelfmark.plans import record_intake
from shelfmark.sources import commits, record_log
from shelfmark.sources.documents import append_records, parse_records, read_records
from shelfmark.streaming import ingest


def save(spark, root, *data):
    record_intake.save_records(make(spark, *data), root, "seq")


def saved(spark, root):
    return rows(record_intake.read_log(spark, root), "id", "person")


@pytest.mark.parametrize("same_buckets", [True, False])
def test_two_writers_of_one_id_leave_one_row(spark, tmp_path, monkeypatch, same_buckets):
    root = str(tmp_path)
    save(spark, root, ("0", "before", [ITEM], 0))
    other = "1" if same_buckets else "2"
    attempts, original = [], commits.commit

    def interleaved(spark_, path, number, content):
        # Another writer comes between this writer's look at the log and its commit.
        if path.endswith("records/commits") and not attempts:
            attempts.append(number)
            save(spark, root, (other, "second", [ITEM], 0), ("0", "again", [ITEM], 0))
        attempts.append(number)
        return original(spark_, path, number, content)

    monkeypatch.setattr(commits, "commit", interleaved)
    save(spark, root, ("1", "first", [ITEM], 0), ("3", "three", [ITEM], 0))
    monkeypatch.undo()
    want = {"0": "before", "1": "second" if same_buckets else "first", "3": "three"} | ({} if same_buckets else {"2": "second"})
    assert dict(saved(spark, root)) == want and len(saved(spark, root)) == len(want)
    save(spark, root, *[(i, "late", [ITEM], 0) for i in "0123"])
    assert len(saved(spark, root)) == 4
    assert len(commits.numbers(spark, f"{root}/records/commits")) == (3 if same_buckets else 3) + (1 if same_buckets else 0)


def test_what_is_not_committed_is_not_there(spark, tmp_path, monkeypatch):
    root = str(tmp_path)

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(commits, "commit", dies)
    with pytest.raises(KeyboardInterrupt):
        save(spark, root, ("1", "lost", [ITEM], 0))
    monkeypatch.undo()
    assert saved(spark, root) == []
    save(spark, root, ("1", "kept", [ITEM], 0))
    assert saved(spark, root) == [("1", "kept")]


def test_only_the_buckets_asked_for_are_opened(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(record_log, "LIST_EVERY", 2)
    root = str(tmp_path)
    for start in range(0, 50, 10):
        save(spark, root, *[(str(i), "bo", [ITEM], 0) for i in range(start, start + 10)])
    path = f"{root}/records"
    asked = record_log._buckets(make(spark, ("7", "x", [ITEM], 0)))
    held = record_log.known_ids(spark, path, asked)
    assert ("7",) in rows(held) and all(f"bucket={asked[0]}/" in f for f in held.inputFiles())
    every = record_log.known_ids(spark, path, range(record_log.BUCKETS))
    assert sorted(int(r["id"]) for r in every.collect()) == list(range(50))
    assert len(record_log.appends(spark, path)[1]) == 5 and record_log.append_new(
        make(spark, ("7", "x", [ITEM], 0)), path, append_records) == 0


def test_a_log_without_commits_is_taken_in(spark, tmp_path):
    root = str(tmp_path)
    append_records(make(spark, ("1", "old", [ITEM], 0)).drop("seq"), f"{root}/records")
    assert saved(spark, root) == [("1", "old")]
    save(spark, root, ("1", "new", [ITEM], 0), ("2", "two", [ITEM], 0))
    assert saved(spark, root) == [("1", "old"), ("2", "two")]
    make(spark, ("1", "old", [ITEM], 0)).write.parquet(f"{root}/log")
    assert rows(ingest.read_log(spark, f"{root}/log"), "id") == [("1",)]


def test_large_records_are_kept_as_lines(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    events = [("a", f"b{i:02}", start + dt.timedelta(seconds=i), i, "add", None) for i in range(30)]
    events += [("c", "b00", start, 100, "add", None)]
    events += [(c, None, start + dt.timedelta(days=1), n, "submit", "bo") for c, n in (("a", 200), ("c", 300))]
    events = spark.createDataFrame(events, EVENT)
    products = events.selectExpr("barcode", "upper(barcode) AS name").where("barcode IS NOT NULL")
    for _ in range(2):
        record_intake.submit_carts(events, products, str(tmp_path), most=20)
    assert rows(record_intake.read_log(spark, str(tmp_path)), "id") == [("300",)]
    large = record_intake.read_large(spark, str(tmp_path))
    assert [(r["id"], r["line_no"], r["name"]) for r in large.orderBy("line_no").collect()] == [
        ("200", i + 1, f"B{i:02}") for i in range(30)]
    assert cart.lines_to_nest(cart.record_lines(cart.submitted_lines(events, products)), 20).count() == 1


def test_a_repeated_key_is_no_reason_to_lose_a_line(spark, tmp_path):
    line = '{"id":"1","person":"a","person":"b","items":[{"name":"x","name":"y","qty":1}],"id":"2"}'
    (tmp_path / "log.json").write_text(f'{line}\n{{"id": \n')
    found = read_records(spark, str(tmp_path / "log.json")).collect()
    assert [(r["id"], r["person"], r["items"][0]["name"]) for r in found] == [("2", "b", "y")]
    parsed = parse_records(spark.createDataFrame([(line,), ("{x",)], "line string"), "line")
    assert rows(parsed, "is_malformed") == [(False,), (True,)]


def test_a_writer_that_died_does_not_hold_up_others(spark, tmp_path):
    path = str(tmp_path / "commits")
    (tmp_path / "commits" / ".by-dead").mkdir(parents=True)
    (tmp_path / "commits" / ".by-dead" / "commit.json").write_text('{"wri')
    assert commits.latest(spark, path) == (0, None)
    assert commits.commit(spark, path, 1, "a") and commits.latest(spark, path) == (1, "a")


def test_of_many_writers_one_gets_the_number(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "commits")
    # All find the number free before the first of them moves.
    monkeypatch.setattr(commits, "exists", lambda spark, folder: False)
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: commits.commit(spark, path, 1, i), range(24)))
    assert sum(won) == 1 and commits.read(spark, path, 1) == won.index(True)
    assert commits.numbers(spark, path) == [1]
    assert [p.name for p in (tmp_path / "commits" / f"{1:012d}").iterdir() if not p.name.endswith(".crc")] == ["commit.json"]

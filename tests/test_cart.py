import datetime as dt
import random
import re
from collections import Counter

import pytest
from conftest import rows

from shelfmark.operators import cart
from shelfmark.operators.numbering import numbered
from shelfmark.plans import record_intake

EVENT = "cart_id string, barcode string, ts timestamp_ntz, event_id long, action string, person string"


def walk(events, known):
    """The cart as it is defined: one event after the other."""
    carts, sent = {}, []
    for cart_id, barcode, ts, event_id, action, person in sorted(events, key=lambda e: (e[2], e[3])):
        lines = carts.setdefault(cart_id, {})
        if action == "submit" and person and person.strip():
            sent += [(event_id, cart_id, b, q, at) for b, (q, at) in lines.items() if b in known]
            lines.clear()
        elif action == "del":
            lines.pop(barcode, None)
        elif action == "add":
            qty, at = lines.get(barcode, (0, ts))
            lines[barcode] = (qty + 1, at)
        elif action in ("inc", "dec") and barcode in lines:
            qty, at = lines[barcode]
            qty += 1 if action == "inc" else -1
            lines[barcode] = (qty, at)
            if qty <= 0:
                del lines[barcode]
    live = [(c, b, q, at) for c, lines in carts.items() for b, (q, at) in lines.items() if b in known]
    return sorted(live), sorted(sent)


def random_events(seed, n, weights):
    draw = random.Random(seed)
    ts, events = dt.datetime(2024, 1, 1), []
    for event_id in range(n):
        ts += dt.timedelta(seconds=draw.choice([0, 1, 45, 900]))
        action = draw.choices(["add", "inc", "dec", "del", "submit", "other"], weights)[0]
        barcode = None if action == "submit" else draw.choice(["x", "x", "y", "z", "unknown"])
        # Half of all events are of one cart, a third of these of one line.
        person = draw.choice(["bo", " li ", "bo", " ", None]) if action == "submit" else None
        events.append((draw.choice(["a", "a", "b", "c"]), barcode, ts, event_id, action, person))
    draw.shuffle(events)
    return events


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([("x", "X"), ("y", "Y"), ("z", "Z")], "barcode string, name string")


@pytest.mark.parametrize("seed, weights", [
    (1, [5, 4, 7, 1, 0.3, 0.2]), (2, [1, 6, 5, 0.1, 0, 0]), (3, [3, 1, 5, 2, 1, 0]), (4, [5, 5, 5, 0, 0.05, 0])])
def test_fold_equals_the_walk(spark, products, seed, weights):
    events = random_events(seed, 1200, weights)
    live, sent = walk(events, {"x", "y", "z"})
    df = spark.createDataFrame(events, EVENT)
    for large_cart in (60, 300, 10**6):
        found = rows(cart.cart_state(df, products, large_cart), "cart_id", "barcode", "qty", "added_at")
        assert sorted(found) == live
        lines = cart.submitted_lines(df, products, large_cart)
        assert sorted(rows(lines, "record_id", "cart_id", "barcode", "qty", "added_at")) == sent


def test_zoned_timestamps(spark, products):
    events = random_events(7, 400, [5, 4, 6, 1, 0.3, 0])
    df = spark.createDataFrame(events, EVENT.replace("timestamp_ntz", "timestamp"))
    found = rows(cart.cart_state(df, products, 50), "cart_id", "barcode", "qty", "added_at")
    assert sorted(found) == walk(events, {"x", "y", "z"})[0]


def test_stray_dates_and_bursts_do_not_fill_a_stretch(spark):
    start, large = dt.datetime(2024, 1, 1), 1000
    steady = [("a", "x", start + dt.timedelta(seconds=i), i, "add", None) for i in range(8000)]
    stray = [("a", "x", dt.datetime(1970, 1, 1), 8000, "add", None)]
    burst = [("a", "x", start, 10_000 + i, "add", None) for i in range(8000)]
    events = spark.createDataFrame([*steady, *stray, *burst], EVENT)
    cut = cart.with_stretch(events, large)
    sizes = [r["count"] for r in cut.groupBy("stretch").count().collect()]
    assert sum(sizes) == 16_001 and max(sizes) <= 2 * large
    # Stretches follow the order of the events.
    ends = cut.groupBy("stretch").agg({"ts": "min"}).orderBy("stretch").collect()
    assert [r[1] for r in ends] == sorted(r[1] for r in ends)


def test_edge_cases(spark, products):
    t = [dt.datetime(2024, 1, 1, 0, i) for i in range(10)]
    script = [("a", "x", "inc"), ("a", "x", "add"), ("a", "x", "dec"), ("a", "x", "add"), ("a", "y", "dec"),
              ("a", "unknown", "add"), ("a", None, "submit"), ("a", None, "submit"), ("a", "x", "inc"),
              ("a", "z", "add")]
    events = [(c, b, t[i], i, action, " bo " if action == "submit" else None)
              for i, (c, b, action) in enumerate(script)]
    events += [(None, "x", t[0], 10, "add", None), ("a", None, t[5], 11, "submit", "  ")]
    df = spark.createDataFrame(events, EVENT)
    assert rows(cart.submitted_lines(df, products), "record_id", "person", "barcode", "qty", "added_at") == [
        (6, "bo", "x", 1, t[3])]
    state = cart.cart_state(df, products)
    assert rows(state, "barcode", "qty", "added_at") == [("z", 1, t[9])]
    assert rows(cart.cart_totals(state)) == [("a", 1, 1)]


def test_carts_become_records_once(spark, products, tmp_path):
    events = random_events(5, 300, [5, 4, 4, 1, 1, 0])
    df = spark.createDataFrame(events, EVENT)
    for upto in (150, 300, 300):
        record_intake.submit_carts(df.where(df["event_id"] < upto), products, str(tmp_path))
    log = record_intake.read_log(spark, str(tmp_path))
    sent = walk(events, {"x", "y", "z"})[1]
    found = [(int(r["id"]), len(r["items"])) for r in log.collect()]
    assert sorted(found) == sorted(Counter(e[0] for e in sent).items())
    assert {r["person"] for r in log.collect()} == {"bo", "li"}


def test_records_nest_in_order_under_one_id(spark):
    t = [dt.datetime(2024, 1, 1, 0, i) for i in range(50)]
    lines = spark.createDataFrame(
        [(1, "a", t[49], "bo", f"b{i}", "n", 1, t[48 - i]) for i in range(40)]
        + [(2, "a", t[49], "li", "x", "X", 3, t[0])],
        "record_id long, cart_id string, submitted_at timestamp_ntz, person string, barcode string, "
        "name string, qty long, added_at timestamp_ntz")
    whole = {r["record_id"]: r for r in cart.build_records(lines).collect()}
    assert [i["barcode"] for i in whole[1]["items"]] == [f"b{i}" for i in reversed(range(40))]
    assert len(whole) == 2 and len(whole[2]["items"]) == 1
    numbered = cart.record_lines(lines).where("record_id = 1").orderBy("line_no").collect()
    assert [(r["line_no"], r["barcode"]) for r in numbered] == [(i + 1, f"b{39 - i}") for i in range(40)]
    documents = cart.as_records(cart.build_records(lines)).collect()
    assert sorted(d["id"] for d in documents) == ["1", "2"]
    assert min(d["submittedAt"] for d in documents) == "2024-01-01T00:49:00.000Z"


def test_ties_fill_many_stretches(spark):
    events = spark.range(15_000).selectExpr(
        "'a' AS cart_id", "CAST(id AS STRING) AS barcode", "TIMESTAMP_NTZ '2024-01-01' AS ts", "0L AS event_id",
        "'add' AS action", "CAST(NULL AS STRING) AS person")
    stretches = cart.with_stretch(events, 1_000).groupBy("stretch").count()
    assert stretches.agg({"count": "max"}).first()[0] <= 1_000
    submit = spark.createDataFrame([("a", None, dt.datetime(2024, 1, 2), 1, "submit", "bo")], EVENT)
    products = events.selectExpr("barcode", "barcode AS name")
    # Two names for a barcode, and one twice, are one product.
    products = products.unionByName(products).unionByName(events.selectExpr("barcode", "'~' AS name"))
    lines = cart.submitted_lines(events.unionByName(submit), products, 1_000)
    numbered = cart.record_lines(lines, rows=500).cache()
    assert [r["line_no"] for r in numbered.orderBy("line_no").collect()] == list(range(1, 15_001))
    assert [r["barcode"] for r in numbered.orderBy("line_no").collect()] == sorted(str(i) for i in range(15_000))


@pytest.mark.parametrize("rows_each", [1, 7, 10**6])
def test_numbers_along_an_order(spark, rows_each):
    draw = random.Random(rows_each)
    data = [(draw.choice(["a", "a", "a", "b", None]), i, draw.choice("xyz")) for i in range(300)]
    df = spark.createDataFrame(data, "g string, i int, t string").repartition(5)
    found = numbered(df, ["t", "i"], "n", by=["g"], rows=rows_each)
    want = []
    for g in ("a", "b", None):
        want += [(*row, n) for n, row in enumerate(sorted((r for r in data if r[0] == g), key=lambda r: (r[2], r[1])), 1)]
    assert rows(found) == rows(spark.createDataFrame(want, "g string, i int, t string, n long"))
    assert sorted(r["n"] for r in numbered(df, ["t", "i"], "n", rows=rows_each).collect()) == list(range(1, 301))
    assert numbered(df.where("false"), ["t"], "n").count() == 0


def test_partitions_follow_the_rows(spark, products, monkeypatch):
    """Whatever holds all events or lines is dealt into partitions by their number, not by the session's setting."""
    monkeypatch.setattr(cart, "parts_for", lambda *_: 37, raising=False)
    events = spark.createDataFrame(random_events(5, 300, [5, 4, 7, 1, 0.3, 0.2]), EVENT)
    plan = cart.submitted_lines(events, products)._jdf.queryExecution().sparkPlan().toString()
    plan += cart.submitted_lines(events, products)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\((.*?), (\d+)\)", plan)
    assert dealt and {n for keys, n in dealt if "stretch" in keys or "barcode" in keys} == {"37"}
    # One place in 300 can be the start of another stretch; only those are joined, and nothing is shuffled for it.
    lines = spark.range(300).selectExpr("id % 3 AS g", "id AS t")
    placed = numbered(lines, ["t"], "n", by=["g"], rows=10)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and re.search(r"hashpartitioning\(g#\d+L, _stretch#\d+, 30\)", plan)
    assert sorted(r["n"] for r in placed.where("g = 1").collect()) == list(range(1, 101))

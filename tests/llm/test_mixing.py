"""The mix against SQL, brute force and its promises."""

import re

import duckdb
import pytest
from conftest_llm import SCHEMA, document, in_order, prose, sorted_rows

from shelfmark.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Excess reshared by weight among those below their cap until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    targets = {s: 0.0 for s in names}
    open_, budget = set(names), float(sum(sizes.values()))
    while open_ and budget > 1e-9:
        total = sum(weight[s] for s in open_)
        share = {s: budget * weight[s] / total for s in open_}
        over = {s for s in open_ if targets[s] + share[s] >= most * sizes[s]}
        if not over:
            for s in open_:
                targets[s] += share[s]
            break
        for s in over:
            budget -= most * sizes[s] - targets[s]
            targets[s] = float(most * sizes[s])
        open_ -= over
    return targets


def columns(df):
    name = "mix_" if "mix" in df.columns and "mix_" in df.columns else "mix"
    return df.select("doc_id", "source", f"{name}.size", f"{name}.source_size", f"{name}.target", f"{name}.taken")


def check(docs, near=0.05):
    rows = columns(mixing.mix(docs)).collect()
    texts = docs.collect()
    assert len(rows) == len(texts)
    sizes = {}
    for row in texts:
        sizes[row["source"]] = sizes.get(row["source"], 0) + len(WORD.findall(row["text"] or ""))
    targets, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
    for row in rows:
        assert row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(targets[row["source"]], abs=1e-6)
        assert row["taken"] in [row["size"] * k for k in range(4)]
        taken[row["source"]] += row["taken"]
    for source, target in targets.items():
        largest = max(len(WORD.findall(r["text"] or "")) for r in texts if r["source"] == source)
        assert abs(taken[source] - target) <= max(near * target, largest)
    again = columns(mixing.mix(docs.repartition(7)))
    assert sorted_rows(again, "doc_id", "taken") == sorted_rows(columns(mixing.mix(docs)), "doc_id", "taken")


def test_unusual_documents(unusual):
    check(unusual)
    mixed = mixing.mix(unusual)
    assert mixed.columns == [*unusual.columns, "mix_"]


def test_many_sources_and_caps(spark):
    docs = [
        document(i, prose(i, 1 + i % 40), source=["a", "b", "c", "d", None, "é", "Z"][min(i % 50, 6)]) for i in range(900)
    ]
    check(spark.createDataFrame(docs, SCHEMA), near=0.02)


def test_one_source_is_taken_once(spark):
    docs = spark.createDataFrame([document(i, prose(i, 20)) for i in range(30)], SCHEMA)
    assert {r["taken"] for r in columns(mixing.mix(docs)).collect()} == {20}


def test_sql_gives_the_same(spark, sample):
    found = mixing.op9_mixing(spark, "/root/testdata/sf0.001")
    duck = duckdb.connect()
    duck.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    result = duck.execute(mixing.ORACLE)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted_rows(found, *names) == in_order(result.fetchall())


def test_rows_are_repeated_as_the_mix_says(unusual):
    times = {}
    for row in mixing.mix(unusual).collect():
        key = (row["doc_id"], row["text"])
        times[key] = times.get(key, 0) + row["mix_"]["times"]
    taken = mixing.take(unusual)
    assert taken.columns == unusual.columns
    counted = {}
    for row in taken.collect():
        counted[row["doc_id"], row["text"]] = counted.get((row["doc_id"], row["text"]), 0) + 1
    assert counted == {k: n for k, n in times.items() if n}


def test_nothing_and_no_words(spark, nothing):
    assert mixing.mix(nothing).count() == 0
    empty = spark.createDataFrame([document(1, ""), document(2, None, source=None)], SCHEMA)
    assert [(r["size"], r["target"], r["taken"]) for r in columns(mixing.mix(empty)).collect()] == [(0, 0.0, 0)] * 2


def test_the_plan_has_no_python(sample):
    plan = mixing.mix(sample)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("few", [0, 1000])
def test_rows_of_documents_are_not_broadcast(spark, tmp_path, monkeypatch, few):
    """Their few bytes in files are many rows: the one row a source is broadcast, or nothing."""
    monkeypatch.setattr(mixing, "FEW_SOURCES", few)
    rows = [("web" if i % 3 else None, i % 90, (i * 2654435761) % (1 << 48)) for i in range(300)]
    spark.createDataFrame(rows, "source string, size long, hash long").write.parquet(f"{tmp_path}/sized")
    sized = spark.read.parquet(f"{tmp_path}/sized")
    cuts = mixing.source_cuts(sized, mixing.source_targets(sized))
    joins = re.findall(r"(\w+Join) (.*)", cuts._jdf.queryExecution().sparkPlan().toString())
    inner = [(kind, "BuildRight" in rest) for kind, rest in joins if "Inner" in rest]
    assert inner == [("BroadcastHashJoin", True) if few else ("SortMergeJoin", False)] * 4
    plain = mixing.source_cuts(spark.createDataFrame(rows, sized.schema), mixing.source_targets(sized))
    assert sorted_rows(cuts, *cuts.columns) == sorted_rows(plain, *cuts.columns) and len(joins) == 5

"""Every registered query against its SQL, on the test tables and on a skewed copy of them with NULLs."""

import json
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from shelfmark.operators import cart
from shelfmark.workload import catalog, lookup, records

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.is_dir(), reason="no test tables")

# A third of the rows of each table goes to one key; here and there a value is missing.
SKEWED = {
    "events": """SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 7 WHEN event_id % 50 <> 1 THEN user_id END
        AS user_id, event_type, value, CASE WHEN event_id % 40 = 3 THEN NULL WHEN event_id % 3 = 0
        THEN '{"k": 20}' ELSE props END AS props FROM events""",
    "conversations": """SELECT CASE WHEN rn % 3 = 0 THEN 0 ELSE conv_id END AS conv_id,
        CASE WHEN rn % 3 = 0 THEN 1000 + rn ELSE turn END AS turn, role,
        CASE WHEN rn % 17 <> 5 THEN text END AS text
        FROM (SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS rn FROM conversations)""",
    "documents": """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN (SELECT text FROM documents WHERE doc_id = 5)
        WHEN doc_id % 29 <> 1 THEN text END AS text, lang, source, n_chars FROM documents""",
    "orders": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 10 ELSE o_custkey END AS o_custkey,
        o_orderstatus, o_totalprice, CASE WHEN o_orderkey % 31 <> 2 THEN o_orderdate END AS o_orderdate,
        o_orderpriority FROM orders""",
    "part": """SELECT p_partkey, CASE WHEN p_partkey % 37 <> 1 THEN p_name END AS p_name, p_brand, p_type, p_size,
        CASE WHEN p_partkey % 3 = 0 THEN 900.5 ELSE p_retailprice END AS p_retailprice FROM part""",
    "customer": """SELECT c_custkey, CASE WHEN c_custkey % 41 <> 1 THEN c_name END AS c_name,
        CASE WHEN c_custkey % 3 = 0 THEN 3 WHEN c_custkey % 19 <> 1 THEN c_nationkey END AS c_nationkey,
        c_acctbal, c_mktsegment FROM customer""",
}


def views(folder):
    connection = duckdb.connect()
    for path in folder.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="module", params=["plain", "skewed"])
def tables(request, tmp_path_factory):
    if request.param == "plain":
        return SF_DIR, views(SF_DIR)
    folder = tmp_path_factory.mktemp("skewed")
    plain = views(SF_DIR)
    for path in SF_DIR.glob("*.parquet"):
        sql = SKEWED.get(path.stem, f"SELECT * FROM {path.stem}")
        plain.execute(f"COPY ({sql}) TO '{folder / path.name}' (FORMAT parquet)")
    return folder, views(folder)


def normal(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return round(v, 9) if isinstance(v, float) and math.isfinite(v) else v

    return sorted((tuple(value(row[i]) for i in order) for row in found), key=repr)


PARTS = (lookup, catalog, records)
QUERIES = {name: query for part in PARTS for name, query in part.QUERIES.items()}


def test_every_query_is_registered_with_its_sql():
    assert set(QUERIES) == {name for part in PARTS for name in part.ORACLE}
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, tables, name):
    folder, duck = tables
    df = entry.queries()[name](spark, str(folder))
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def equals_sql(spark, name):
    df = entry.queries()[name](spark, str(SF_DIR))
    result = views(SF_DIR).execute(entry.oracle_sql()[name])
    found = [tuple(r) for r in df.collect()]
    assert normal(df.columns, found) == normal([d[0] for d in result.description], result.fetchall())


def test_documents_hold_bounded_stretches(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(catalog, "DOCUMENT_ROWS", 7)
    monkeypatch.setattr(catalog, "fresh_dir", lambda spark, label: str(tmp_path / label))
    equals_sql(spark, "documents_round_trip")
    for kind in ("catalog", "custom", "rules"):
        written = [json.loads(p.read_text()) for p in (tmp_path / "documents" / kind).rglob("part-*")]
        assert len(written) > 10 and max(map(len, written)) <= 7


def test_large_records_are_not_nested(spark, monkeypatch):
    nested = []

    def few(numbered, whole=cart.lines_to_nest):
        nested.append(whole(numbered, 1000))
        return nested[-1]

    monkeypatch.setattr(cart, "lines_to_nest", few)
    equals_sql(spark, "large_records")
    assert 0 < nested[0].groupBy("record_id").count().agg({"count": "max"}).first()[0] <= 1000


@pytest.mark.parametrize("name", ["stream_ingest", "stream_distinct_ids", "dedupe_records"])
def test_ids_of_any_size(spark, tmp_path, name):
    """Times made of ids lie in late years; ids that give none leave the rows as they are."""
    talk = """SELECT CAST(c AS BIGINT) AS conv_id, CAST(t AS BIGINT) AS turn, 'a' AS role, x AS text FROM (VALUES
        (1, 0, 'the'), (1, 2147483648, 'th'), (35791395, 0, 'th'), (69942000, 0, 'no'), (69942000, 1, 'the one'),
        (1000000000, 0, 'no'), (2000000000, 3, 'other'), (-40000000, 0, 'th')) AS v(c, t, x)"""
    duck = duckdb.connect()
    duck.execute(f"COPY ({talk}) TO '{tmp_path}/conversations.parquet' (FORMAT parquet)")
    result = views(tmp_path).execute(entry.oracle_sql()[name])
    df = entry.queries()[name](spark, str(tmp_path))
    expected = normal([d[0] for d in result.description], result.fetchall())
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == expected
    # Beyond what SQL reckons with.
    beyond = "SELECT 4611686018427387904 AS conv_id, 0 AS turn, 'a' AS role, 'no' AS text"
    duck.execute(f"COPY ({talk} UNION ALL {beyond}) TO '{tmp_path}/conversations.parquet' (FORMAT parquet)")
    df = entry.queries()[name](spark, str(tmp_path))
    found = [tuple(r) for r in df.collect() if r["id"] != "4611686018427387904"]
    assert normal(df.columns, found) == expected

from conftest import rows
from pyspark.sql import functions as F

from shelfmark.operators import records as ops
from shelfmark.schemas import RECORD
from shelfmark.sources import documents

ITEM = ("b", "熊", 2, "2024-01-01T00:00:00.000Z")


def make(spark, *data):
    """Records from (id, person, items, seq)."""
    built = [(i, p, f"2024-01-0{seq + 1}T00:00:00.000Z", items, seq) for i, p, items, seq in data]
    schema = RECORD.jsonValue()
    schema["fields"].append({"name": "seq", "type": "long", "nullable": True, "metadata": {}})
    return spark.createDataFrame(built, type(RECORD).fromJson(schema))


def test_validation_splits_without_loss(spark):
    df = make(spark, ("1", "bo", [ITEM], 0), ("", "bo", [ITEM], 1), (None, "bo", [ITEM], 2),
              ("4", "  ", [ITEM], 3), ("5", "bo", [], 4), ("6", "bo", None, 5), ("7", None, [ITEM], 6))
    valid, rejected = ops.validate_records(df)
    assert rows(valid, "id") == [("1",)] and rejected.count() == 6


def test_first_record_of_an_id_wins(spark):
    df = make(spark, ("1", "late", [], 3), ("1", "early", None, 1), ("2", "x", [ITEM], 2)).repartition(4)
    assert rows(ops.dedupe_records(df, "seq"), "id", "person") == [("1", "early"), ("2", "x")]


def test_append_is_idempotent(spark):
    log = make(spark, ("1", "old", [ITEM], 0))
    new = make(spark, ("1", "new", [ITEM], 1), ("2", "a", [ITEM], 2), ("2", "b", [ITEM], 3))
    fresh = ops.append_idempotent(new, log, "seq")
    assert rows(fresh, "id", "person") == [("2", "a")]
    assert ops.append_idempotent(new, log.unionByName(fresh), "seq").count() == 0
    flagged = ops.with_duplicate_flag(new, log, "seq")
    assert rows(flagged, "seq", "duplicate") == [(1, True), (2, False), (3, True)]


def test_saved_records_beat_pending_ones(spark):
    saved = make(spark, ("1", "saved", [ITEM], 5))
    pending = make(spark, ("1", "pending", [ITEM], 0), ("2", "q2", [ITEM], 2), ("2", "q1", [ITEM], 1))
    assert rows(ops.merge_pending(saved, pending, "seq"), "id", "person") == [("1", "saved"), ("2", "q1")]


def test_report_is_newest_first(spark):
    df = make(spark, ("1", "a", [ITEM, ITEM], 0), ("2", "b", [ITEM], 1))
    report = ops.records_report(df).collect()
    assert [r["id"] for r in report] == ["2", "1"]
    assert report[1]["items_text"] == "熊 ×2, 熊 ×2" and report[1]["submitted"] == "2024-01-01 00:00"


def test_log_round_trip_skips_bad_lines(spark, tmp_path):
    path = tmp_path / "log"
    assert documents.read_records(spark, str(path)).count() == 0
    df = make(spark, ("1", "熊", [ITEM], 0))
    for _ in range(2):
        documents.append_records(ops.stamp(df.drop("seq")), str(path))
    assert any("熊" in f.read_text(encoding="utf-8") for f in path.glob("*.json"))
    (path / "extra.json").write_text('\n   \nnot json\n{"id": "9", "person": "x"}\n{"id": \n')
    log = documents.read_records(spark, str(path))
    assert rows(log, "id") == [("1",), ("1",), ("9",)]
    assert rows(documents.malformed_records(spark, str(path))) == [("not json",), ('{"id": ',)]
    assert log.where("id = '1'").first()["items"][0]["qty"] == 2
    assert log.where("id = '1'").first()["savedAt"].endswith("+00:00")


def test_parse_lines(spark):
    lines = spark.createDataFrame([('{"id": "1"}',), ("nope",), ("  ",), ("",), ('{"id": ',), ("{}",)], "line string")
    parsed = documents.parse_records(lines, "line")
    assert parsed.count() == 4
    assert rows(parsed.where("is_malformed"), "line") == [("nope",), ('{"id": ',)]
    assert rows(parsed.where("not is_malformed").select(F.col("record.id"))) == [(None,), ("1",)]


def test_odd_quantities_do_not_lose_a_record(spark, tmp_path):
    odd = """{"id": "1", "items": [{"name": "a", "qty": "2"}, {"name": "b", "qty": 3}, {"name": "c", "qty": 0.5}]}"""
    (tmp_path / "log.json").write_text(f"{odd}\n{{'id': '2'}}\n")
    log = documents.read_records(spark, str(tmp_path / "log.json"))
    parsed = documents.parse_records(spark.createDataFrame([(odd,), ("{'id': '2'}",)], "line string"), "line")
    assert log.schema["items"].dataType == RECORD["items"].dataType
    for items in (log.first()["items"], parsed.where("not is_malformed").first()["record"]["items"]):
        assert [i["qty"] for i in items] == [2, 3, None]
    assert log.count() == 1 and parsed.where("is_malformed").count() == 1


def test_rows_do_not_depend_on_the_columns(spark, tmp_path):
    lines = ['{"id":"1","items":[{"name":"a"}]}', '{"id":"2","items":5}', '{"id":"3","items":[1]}', "no json", "7"]
    (tmp_path / "log.json").write_text("\n".join(lines))
    log = documents.read_records(spark, str(tmp_path / "log.json"))
    assert log.count() == len(log.collect()) == log.select("id").count() == 4
    assert rows(log, "id") == [(None,), ("1",), ("2",), ("3",)]
    assert rows(documents.malformed_records(spark, str(tmp_path / "log.json"))) == [("no json",)]


def test_free_fields_survive_being_saved_again(spark, tmp_path):
    body = '[{"name":"a","note":{"x":[1,null,"é"]},"qty":0.5}]'
    (tmp_path / "log.json").write_text(f'{{"id":"1","person":"bo","items":{body}}}')
    for source, target in (("log.json", "again"), ("again", "third")):
        read = documents.read_records(spark, str(tmp_path / source))
        documents.append_records(ops.stamp(read), str(tmp_path / target))
    found = documents.read_records(spark, str(tmp_path / "third")).first()
    assert found["body"] == body and found["id"] == "1" and found["savedAt"].endswith("+00:00")


def test_white_space_is_no_person_and_odd_times_are_shown(spark):
    df = make(spark, ("1", "\u3000", [ITEM], 0), ("2", "\t\n", [ITEM], 1), ("3", "\u3000bo\t", [ITEM], 2))
    valid, _ = ops.validate_records(df)
    assert rows(valid, "id") == [("3",)]
    report = ops.records_report(df.withColumn("submittedAt", F.lit("yesterday")))
    assert {r["submitted"] for r in report.collect()} == {"yesterday"}


def test_a_line_is_parsed_once_and_only_asked_fields_are_taken(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"id": "1", "person": "bo", "items": []}\n\n{x\n[1]\n')
    log = documents.read_records(spark, str(tmp_path / "log.jsonl"))
    assert rows(log, "id", "person") == [(None, None), ("1", "bo")]
    plan = log.select("id", "person")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1 and "$.items" not in plan

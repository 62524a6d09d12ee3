import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfmark.functions.days import define_run_day, partition_id
from shelfmark.operators.extract import extract_day, extract_values, first_seen, incoming
from shelfmark.sources.registry import (
    FLEET_SPECS,
    Settings,
    SourceSpec,
    load_registry,
    load_settings,
    read_source,
    settings_name,
)

NTZ = "CompanyGuid string, DeviceId string, IssueType string, Year int, at timestamp_ntz"
SPEC = SourceSpec("Issues", ("DeviceId", "IssueType", "Year"), "at")


@pytest.fixture
def issues(spark):
    day = dt.datetime(2024, 1, 2)
    second = dt.timedelta(microseconds=1)
    return spark.createDataFrame(
        [
            ("a", "d1", None, 2020, day),
            ("a", "d1", "", 2020, day + dt.timedelta(hours=23, minutes=59)),
            (None, "d2", "late", None, day + dt.timedelta(days=1) - second),
            ("a", "d3", "next day", 1, day + dt.timedelta(days=1)),
            ("a", "d4", "day before", 1, day - second),
            ("a", "d5", "no day", 1, None),
        ],
        NTZ,
    )


def test_long_form_of_one_day(issues):
    assert rows(extract_values(issues, SPEC, "2024-01-02")) == rows_of(
        (None, "Issues.DeviceId", "d2"),
        (None, "Issues.IssueType", "late"),
        ("a", "Issues.DeviceId", "d1"),
        ("a", "Issues.IssueType", ""),
        ("a", "Issues.Year", "2020"),
    )


def rows_of(*expected):
    return sorted(expected, key=lambda row: [(v is not None, str(v)) for v in row])


def test_one_scan_equals_a_union_of_scans(issues):
    by_column = [
        extract_values(issues, SourceSpec("Issues", (column,), "at"), "2024-01-01", "2024-01-03")
        for column in SPEC.values
    ]
    assert rows(extract_values(issues, SPEC, "2024-01-01", "2024-01-03")) == rows(incoming(by_column))


def test_dated_source_needs_a_day(issues):
    with pytest.raises(ValueError):
        extract_values(issues, SPEC)


def test_lookback_picks_up_late_rows(issues):
    values = {row[2] for row in rows(extract_day(issues, SPEC, "2024-01-02", lookback_days=1))}
    assert "day before" in values and "next day" not in values


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_day_filter_reaches_the_scan(spark, issues, tmp_path, kind):
    path = str(tmp_path / "t")
    issues.withColumn("at", F.col("at").cast(kind)).write.parquet(path)
    stored = extract_values(spark.read.parquet(path), SPEC, "2024-01-02")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(at" in pushed and "LessThan(at" in pushed
    assert plan.count("FileScan") == 1 and plan.count("Exchange hash") == 1
    assert len(stored.collect()) == 5


def test_universal_values_and_id_pattern(spark):
    df = spark.createDataFrame(
        [("EngineSpeedId", "Engine speed"), ("Engine-SpeedId", None), ("Engine_SpeedId", "x"),
         ("EngineSpeed", "x"), ("SpeedId\n", "y"), (None, "z")],
        "DiagnosticId string, DiagnosticName string",
    )
    found = rows(extract_values(df, FLEET_SPECS["Diagnostic"]))
    assert found == rows_of(
        ("universal", "Diagnostic.DiagnosticId", "EngineSpeedId"),
        *[("universal", "Diagnostic.DiagnosticName", v) for v in ("Engine speed", "x", "y", "z")],
    )


def test_tags_keep_their_spelling():
    assert "VIN" in FLEET_SPECS["EVCharges"].values and "Vin" in FLEET_SPECS["EVTrips"].values
    assert len(FLEET_SPECS) == 18
    assert sum(len(spec.values) for spec in FLEET_SPECS.values()) == 54
    snapshots = {name for name, spec in FLEET_SPECS.items() if spec.day_column is None}
    assert snapshots == {"DeviceGroups", "Diagnostic", "LatestVehicleMetadata", "Zones"}


def test_first_seen_is_the_first_day_of_each_triple(issues):
    found = {(row[1], row[2]): row[3] for row in rows(first_seen(issues, SPEC))}
    assert found["Issues.Year", "1"] == dt.date(2024, 1, 1)
    assert found["Issues.DeviceId", "d3"] == dt.date(2024, 1, 3)
    assert ("Issues.DeviceId", "d5") not in found


def test_run_day_in_sql(spark):
    define_run_day(spark, "2024-02-29")
    row = spark.sql("SELECT run_date() AS d, run_timestamp() AS t").first()
    assert row["d"] == dt.date(2024, 2, 29) and row["t"] == dt.datetime(2024, 2, 29)
    assert spark.range(1).select(partition_id(F.lit(row["d"]))).first()[0] == "20240229"


def test_settings_and_registry(spark, tmp_path):
    assert settings_name("us", "staging", "fedramp") == "region_us_fedramp_staging.json"
    assert settings_name("northamerica-northeast1", "production") == "region_ca_production.json"
    assert settings_name("eu", "production", "fedramp") == "region_eu_production.json"
    source_root = tmp_path / "sources"
    text = {"target_root": str(tmp_path / "out"), "source_root": str(source_root),
            "sources": {"Zones": "fleet", "Rule": "core"}}
    (tmp_path / "region_eu_staging.json").write_text(json.dumps(text))
    settings = load_settings(str(tmp_path), "eu", "staging")
    assert [spec.name for spec in load_registry(settings)] == ["Rule", "Zones"]
    spark.range(3).write.parquet(str(source_root / "fleet" / "Zones"))
    assert read_source(spark, settings, "Zones").count() == 3
    with pytest.raises(ValueError, match="GpsLogs"):
        load_registry(Settings("x", {"GpsLogs": "core", "Rule": "core"}))

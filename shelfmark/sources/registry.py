"""Which columns of which source go into the lookup, and where each source lies."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession

# Fixed value: the company given to values that belong to no company.
UNIVERSAL = "universal"


@dataclass(frozen=True)
class SourceSpec:
    """One source: its value columns, its company column and its day column.

    ``company=None`` tags every value as universal. ``day_column=None`` marks a snapshot that has no
    day of its own. ``keep`` holds a predicate for single value columns.
    """

    name: str
    values: tuple[str, ...]
    day_column: str | None = None
    company: str | None = "CompanyGuid"
    keep: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)


def is_plain_id(value: Column) -> Column:
    """Ids that end in 'Id' and have neither dash nor underscore."""
    return ~value.rlike("-|_") & value.rlike("Id\\z")


# The sources, their value columns as spelled there, and their day columns.
FLEET_SPECS = {
    spec.name: spec
    for spec in (
        SourceSpec("DailyEVSA", ("VehicleType", "Vin"), "LocalDate"),
        SourceSpec("DeviceGroups", ("DeviceId", "GroupId", "GroupName", "SerialNo")),
        SourceSpec(
            "Diagnostic",
            ("DiagnosticId", "DiagnosticName"),
            company=None,
            keep={"DiagnosticId": is_plain_id},
        ),
        SourceSpec("EVChargeWindows", ("VIN",), "ChargeStartTime"),
        SourceSpec("EVCharges", ("Powertrain", "VIN"), "ChargeStartTime"),
        SourceSpec("EVIdentification", ("Powertrain", "SerialNo", "VIN"), "PartitionDate"),
        SourceSpec("EVTrips", ("Powertrain", "Vin"), "PipelineExecutionDate"),
        SourceSpec(
            "Exceptions", ("ExceptionId", "DeviceId", "RuleName", "RuleId", "Diagnostic"), "ActiveFrom"
        ),
        SourceSpec("FaultData", ("DeviceId", "DiagnosticId"), "StreamDateTime"),
        SourceSpec("FleetSafety_Daily", ("ClusterDescription",), "UTC_Date"),
        SourceSpec(
            "LatestVehicleMetadata",
            (
                "DeviceId", "DeviceName", "Device_Health", "FuelType", "Manufacturer", "Model",
                "SerialNo", "VehicleType", "Vin", "VocationName", "Year",
            ),
        ),
        SourceSpec("MaintenanceIssues_Daily", ("DeviceId", "IssueType"), "UTC_Date"),
        SourceSpec("Rule", ("RuleId", "RuleName"), "StreamDateTime"),
        SourceSpec("StatusData", ("DeviceId", "DiagnosticId"), "DateTime"),
        SourceSpec("VehicleKPI_Daily", ("DeviceId", "Device_Health", "SerialNo", "Vin"), "UTC_Date"),
        SourceSpec("VehicleKPI_Hourly", ("DeviceId", "Device_Health", "SerialNo", "Vin"), "UTC_Hour"),
        SourceSpec("VehicleSafety_Daily", ("DeviceId", "Vin"), "UTC_Date"),
        SourceSpec("Zones", ("ZoneId", "ZoneName", "ZoneTypes")),
    )
}


@dataclass(frozen=True)
class Settings:
    """Where one region and stage keeps its sources and its lookup.

    ``sources`` maps a source name to its dataset. With ``source_root`` set a source is the parquet
    folder ``source_root/dataset/name``; without it, the catalog table ``dataset.name``.
    """

    target_root: str
    sources: Mapping[str, str]
    source_root: str | None = None


def settings_name(region: str, stage: str, regulation: str = "commercial") -> str:
    """File name of the settings of a region and stage; a regulated US stage has a file of its own."""
    # Fixed value: the cloud region that the Canadian settings serve.
    region = "ca" if region.lower() == "northamerica-northeast1" else region
    middle = "_fedramp" if regulation == "fedramp" and region == "us" else ""
    return f"region_{region}{middle}_{stage}.json"


def parse_settings(text: str) -> Settings:
    return Settings(**json.loads(text))


def load_settings(folder: str, region: str, stage: str, regulation: str = "commercial") -> Settings:
    return parse_settings(Path(folder, settings_name(region, stage, regulation)).read_text(encoding="utf-8"))


def load_registry(
    settings: Settings, specs: Mapping[str, SourceSpec] | None = None
) -> list[SourceSpec]:
    """Specs of the configured sources in name order. A source without a spec is an error."""
    specs = FLEET_SPECS if specs is None else specs
    unknown = sorted(set(settings.sources) - set(specs))
    if unknown:
        raise ValueError(f"sources without value columns: {', '.join(unknown)}")
    return [specs[name] for name in sorted(settings.sources)]


def read_source(spark: SparkSession, settings: Settings, name: str) -> DataFrame:
    dataset = settings.sources[name]
    if settings.source_root:
        return spark.read.parquet(f"{settings.source_root}/{dataset}/{name}")
    return spark.table(f"{dataset}.{name}")

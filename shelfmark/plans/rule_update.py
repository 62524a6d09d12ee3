"""Publication of a new rule set after its evaluation."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from shelfmark.operators.classify import evaluate_rules
from shelfmark.operators.rules import RuleSet, current_rules, next_version, publish_rules
from shelfmark.schemas import RULES
from shelfmark.sources.storage import read_version


def load_rules(spark: SparkSession, path: str) -> RuleSet | None:
    """The rule set published last."""
    published = read_version(spark, path)
    row = None if published is None else current_rules(published).first()
    return None if row is None else RuleSet.of_row(row)


def update_rules(
    spark: SparkSession,
    products: DataFrame,
    candidate: Mapping[str, Any] | str,
    path: str,
    attempt: int = 1,
    attempts: int = 3,
) -> tuple[str, RuleSet | None]:
    """Evaluate a candidate and, if accepted, publish it with the next version number."""
    verdict = evaluate_rules(products, candidate if isinstance(candidate, str) else dict(candidate), attempt, attempts)
    status = verdict.first()["status"]
    if status != "accepted":
        return status, None
    published = read_version(spark, path)
    version = 1 if published is None else next_version(published).first()["next_version"]
    parsed = json.loads(candidate) if isinstance(candidate, str) else candidate
    document = {**parsed, "version": version}
    rules = spark.createDataFrame([json.loads(json.dumps(document))], RULES)
    publish_rules(rules.coalesce(1), path)
    return status, RuleSet.of(document)

"""Rule sets: the document, its flat form and its versions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from shelfmark.schemas import RULES
from shelfmark.sources.storage import write_version


@dataclass(frozen=True)
class Category:
    id: str
    name: str
    keywords: tuple[str, ...] = ()
    children: tuple["Category", ...] = ()

    @staticmethod
    def of(doc: Mapping[str, Any]) -> "Category":
        return Category(
            doc["id"],
            doc["name"],
            tuple(word for word in doc.get("keywords") or () if word is not None),
            tuple(Category.of(child) for child in doc.get("children") or ()),
        )


@dataclass(frozen=True)
class RuleSet:
    """One rule-set document. It is written by a person and small, so it lives on the driver."""

    categories: tuple[Category, ...]
    version: int = 0
    name: str | None = None
    uncategorized_label: str = "未分类"  # Fixed value

    @staticmethod
    def of(doc: Mapping[str, Any]) -> "RuleSet":
        return RuleSet(
            tuple(Category.of(category) for category in doc["categories"]),
            doc.get("version") or 0,
            doc.get("name"),
            doc.get("uncategorizedLabel") or RuleSet.uncategorized_label,
        )

    @staticmethod
    def of_row(row: Row) -> "RuleSet":
        return RuleSet.of(row.asDict(recursive=True))

    def category(self, category_id: str) -> Category | None:
        return next((c for c in self.categories if c.id == category_id), None)


def flatten_rules(rules: DataFrame) -> DataFrame:
    """One row per keyword of every category and child; a level without entries leaves NULLs.

    ``child_id`` is NULL on the rows of the category's own keywords.
    """
    categories = rules.select("version", F.posexplode_outer("categories").alias("position", "category"))
    own = F.struct(
        F.lit(None).cast("string").alias("id"),
        F.lit(None).cast("string").alias("name"),
        F.col("category.keywords").alias("keywords"),
    )
    children = F.coalesce(F.col("category.children"), F.array().cast(RULES["categories"].dataType
                          .elementType["children"].dataType))
    nodes = categories.withColumn("node", F.explode(F.concat(F.array(own), children)))
    return nodes.select(
        "version",
        "position",
        F.col("category.id").alias("category_id"),
        F.col("category.name").alias("category_name"),
        F.col("node.id").alias("child_id"),
        F.col("node.name").alias("child_name"),
        F.explode_outer("node.keywords").alias("keyword"),
    )


def validate_rules(rules: DataFrame) -> DataFrame:
    """Rule-set documents with ``is_valid``: whether they have categories at all."""
    return rules.withColumn("is_valid", F.col("categories").isNotNull())


def next_version(rules: DataFrame) -> DataFrame:
    return rules.agg((F.coalesce(F.max("version"), F.lit(0)) + 1).alias("next_version"))


def current_rules(rules: DataFrame) -> DataFrame:
    """The document with the highest version."""
    columns = [c for c in rules.columns if c != "version"]
    latest = rules.agg(
        F.max("version").alias("version"), F.max_by(F.struct(*columns), "version").alias("document")
    )
    return latest.where(F.col("document").isNotNull()).select("version", "document.*")


def publish_rules(rules: DataFrame, path: str) -> int:
    """Publish a rule set as the next version of its table."""
    return write_version(rules, path)

"""The product list: merged, transliterated and filtered."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from shelfmark.operators.products import merge_catalog
from shelfmark.operators.readings import add_readings
from shelfmark.operators.rules import RuleSet
from shelfmark.operators.search import ALL, visible_products


def load_products(
    catalog: DataFrame, custom: DataFrame, dictionary: Mapping[str, str] | None = None
) -> DataFrame:
    return add_readings(merge_catalog(catalog, custom), dictionary)


def browse(
    products: DataFrame,
    rules: RuleSet,
    category: str = ALL,
    subcategory: str | None = None,
    query: str = "",
) -> DataFrame:
    """What a user sees, in catalog order."""
    return visible_products(products, rules, category, subcategory, query).orderBy("origin", "seq")

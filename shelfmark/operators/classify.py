"""Keyword classification of named rows into several categories at once."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.keywords import any_of, explode_hits, where_once, with_hits
from shelfmark.operators.rules import Category, RuleSet

# The largest share of rows that may stay without a category, the names that a report shows.
MAX_UNCATEGORIZED = 0.20
REPORT_SAMPLE = 10
# The words of the report.
PIECES, REST, REST_NAMES = " 件", "未分类：", "未分类商品："
NAME_GAP, PART_GAP, NAMES_AND, MORE = "：", "　", "、", "…"

HITS = "_hits"


def in_category(df: DataFrame, category: Category, name: str = "name") -> DataFrame:
    """Rows that are in a category."""
    lowered = df.withColumn("_low", F.lower(name))
    words = [word.lower() for word in category.keywords]
    return where_once(lowered, any_of(F.col("_low"), words)).drop("_low")


def category_hits(df: DataFrame, rules: RuleSet, name: str = "name") -> DataFrame:
    """Adds the positions of all categories a row is in."""
    return with_hits(df, F.col(name), [c.keywords for c in rules.categories], HITS)


def _names(categories: list[tuple[str, ...]], fields: tuple[str, ...]) -> Column:
    rows = [F.struct(*[F.lit(v).alias(f) for f, v in zip(fields, row)]) for row in categories]
    return F.array(*rows)


def label_products(df: DataFrame, rules: RuleSet, name: str = "name") -> DataFrame:
    """One row per row and category it is in. Needs no shuffle."""
    if not rules.categories:
        empty = F.lit(None).cast("string")
        return df.withColumn("category_id", empty).withColumn("category_name", empty).where(F.lit(False))
    labels = _names([(c.id, c.name) for c in rules.categories], ("category_id", "category_name"))
    exploded = explode_hits(category_hits(df, rules, name), HITS, "_hit")
    return exploded.withColumn("_label", F.get(labels, F.col("_hit"))).select(*df.columns, "_label.*")


def _subcategories(rules: RuleSet) -> list[tuple[int, Category, Category]]:
    return [(i, c, child) for i, c in enumerate(rules.categories) for child in c.children]


def _subcategory_rows(df: DataFrame, rules: RuleSet, name: str) -> DataFrame:
    """One row per row and subcategory position, where the parent matches as well as the child."""
    nodes = _subcategories(rules)
    first_child = len(rules.categories)
    groups = [c.keywords for c in rules.categories] + [child.keywords for _, _, child in nodes]
    parents = F.array(*[F.lit(parent) for parent, _, _ in nodes])
    return (
        explode_hits(with_hits(df, F.col(name), groups, HITS), HITS, "_hit")
        .withColumn("_node", F.col("_hit") - first_child)
        .where((F.col("_node") >= 0) & F.array_contains(HITS, F.get(parents, F.col("_node"))))
    )


def label_subcategories(df: DataFrame, rules: RuleSet, name: str = "name") -> DataFrame:
    """One row per row and subcategory it is in; the parent category must match as well."""
    nodes = _subcategories(rules)
    if not nodes:
        empty = F.lit(None).cast("string")
        return df.withColumn("category_id", empty).withColumn("child_id", empty).where(F.lit(False))
    labels = _names([(parent.id, child.id) for _, parent, child in nodes], ("category_id", "child_id"))
    rows = _subcategory_rows(df, rules, name)
    return rows.withColumn("_label", F.get(labels, F.col("_node"))).select(*df.columns, "_label.*")


def uncategorized(df: DataFrame, rules: RuleSet, name: str = "name") -> DataFrame:
    """Rows that are in no category."""
    return where_once(category_hits(df, rules, name), F.size(HITS) == 0).drop(HITS)


def _label_rows(spark: SparkSession, rows: list[tuple], fields: tuple[str, ...]) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(F.inline(_names(rows, fields)))


def _position_counts(
    df: DataFrame, rules: RuleSet, name: str, *measures: Column
) -> DataFrame:
    """Rows per category position; -1 counts all rows, the position after the last the uncategorized."""
    total, rest = F.array(F.lit(-1)), F.array(F.lit(len(rules.categories)))
    positions = F.concat(total, F.when(F.size(HITS) == 0, rest).otherwise(F.col(HITS)))
    hits = explode_hits(category_hits(df, rules, name), positions, "position")
    return hits.groupBy("position").agg(F.count(F.lit(1)).alias("n"), *measures)


def category_counts(df: DataFrame, rules: RuleSet, name: str = "name") -> DataFrame:
    """Rows per category id, also of empty categories, with the totals 'all' and 'uncategorized'."""
    last = len(rules.categories)
    rows = [(-1, "all", "全部")]  # Fixed value
    rows += [(i, c.id, c.name) for i, c in enumerate(rules.categories)]
    rows.append((last, "uncategorized", rules.uncategorized_label))
    chips = _label_rows(df.sparkSession, rows, ("position", "category_id", "label"))
    counts = _position_counts(df, rules, name)
    return chips.join(counts, "position", "left").select(
        "position", "category_id", "label", F.coalesce("n", F.lit(0)).alias("n")
    )


def subcategory_counts(df: DataFrame, rules: RuleSet, name: str = "name") -> DataFrame:
    """Rows per subcategory, also of empty ones."""
    nodes = _subcategories(rules)
    fields = ("position", "category_id", "child_id", "label")
    if not nodes:
        schema = "position int, category_id string, child_id string, label string, n bigint"
        return df.sparkSession.createDataFrame([], schema)
    rows = [(i, parent.id, child.id, child.name) for i, (_, parent, child) in enumerate(nodes)]
    counts = (
        _subcategory_rows(df, rules, name)
        .groupBy(F.col("_node").alias("position"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    chips = _label_rows(df.sparkSession, rows, fields)
    return chips.join(counts, "position", "left").select(*fields, F.coalesce("n", F.lit(0)).alias("n"))


def _category_name(rules: RuleSet) -> Column:
    """Name of the category at ``position``; NULL for the two totals."""
    names = F.array(*[F.lit(c.name) for c in rules.categories]).cast("array<string>")
    position = F.col("position")
    return F.when((position >= 0) & (position < len(rules.categories)), F.get(names, position))


def rule_stats(df: DataFrame, rules: RuleSet, name: str = "name") -> DataFrame:
    """Rows per category name, hit categories only; categories of one name add up."""
    named = _position_counts(df, rules, name).withColumn("category_name", _category_name(rules))
    hit = named.where(F.col("category_name").isNotNull())
    return hit.groupBy("category_name").agg(F.sum("n").alias("n"))


def coverage(df: DataFrame, rules: RuleSet, name: str = "name") -> DataFrame:
    """One row: ``total, uncategorized, ratio``."""
    return (
        category_hits(df, rules, name)
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(F.size(HITS) == 0).alias("uncategorized"))
        .withColumn("ratio", F.col("uncategorized") / F.greatest("total", F.lit(1)))
    )


def coverage_gate(
    df: DataFrame, rules: RuleSet, max_ratio: float = MAX_UNCATEGORIZED, name: str = "name"
) -> DataFrame:
    return coverage(df, rules, name).withColumn("passes", ~(F.col("ratio") > max_ratio))


def uncategorized_names(
    df: DataFrame, rules: RuleSet, name: str = "name", seq: str = "seq"
) -> DataFrame:
    """All names without a category, with their place in the catalog."""
    return uncategorized(df, rules, name).select(seq, name)


def uncategorized_sample(
    df: DataFrame, rules: RuleSet, n: int = REPORT_SAMPLE, name: str = "name", seq: str = "seq"
) -> DataFrame:
    """The first ``n`` names without a category, in catalog order. A report; the whole list is
    :func:`uncategorized_names`."""
    return uncategorized_names(df, rules, name, seq).orderBy(seq).limit(n)


def stats_summary(
    df: DataFrame, rules: RuleSet, n: int = REPORT_SAMPLE, name: str = "name", seq: str = "seq"
) -> DataFrame:
    """One row of rule-set statistics.

    ``per_category`` maps the names of hit categories to their counts, in the order in which the catalog
    first hits them. ``first_uncategorized`` holds the ``n`` names that a report shows; the whole list are the
    rows of :func:`uncategorized_names`.
    """
    position, last = F.col("position"), len(rules.categories)
    counts = _position_counts(df, rules, name, F.min(seq).alias("first"))
    named = counts.groupBy(_category_name(rules).alias("category_name")).agg(
        F.min(F.struct("first", "position")).alias("place"),
        F.sum("n").alias("n"),
        F.sum(F.when(position == -1, F.col("n"))).alias("total"),
        F.sum(F.when(position == last, F.col("n"))).alias("uncategorized"),
    )
    # One row per category name: a handful.
    entry = F.when(F.col("category_name").isNotNull(), F.struct("place", "category_name", "n"))
    entries = F.transform(
        F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["category_name"], e["n"])
    )
    sample = uncategorized_sample(df, rules, n, name, seq).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(seq, name))), lambda row: row[name])
    )
    return named.agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"),
        F.map_from_entries(entries).alias("per_category"),
        F.coalesce(F.sum("uncategorized"), F.lit(0)).alias("uncategorized"),
    ).withColumn("first_uncategorized", sample.scalar())


def stats_text(summary: DataFrame, n: int = REPORT_SAMPLE, keep: tuple[str, ...] = ()) -> DataFrame:
    """The statistics as the two lines of the report; columns to ``keep`` come first."""
    entries = F.transform(
        F.map_entries("per_category"),
        lambda entry: F.concat(entry["key"], F.lit(NAME_GAP), entry["value"].cast("string"), F.lit(PIECES)),
    )
    counts = F.concat(
        F.array_join(entries, PART_GAP), F.lit(PART_GAP + REST), F.col("uncategorized").cast("string"), F.lit(PIECES)
    )
    names = F.concat(
        F.lit(REST_NAMES),
        F.array_join(F.slice("first_uncategorized", 1, n), NAMES_AND),
        F.when(F.col("uncategorized") > n, MORE).otherwise(""),
    )
    return summary.select(
        *keep, counts.alias("counts_line"), F.when(F.col("uncategorized") > 0, names).alias("names_line")
    )


def evaluate_rules(
    df: DataFrame,
    candidate: dict | str,
    attempt: int = 1,
    attempts: int = 3,
    max_ratio: float = MAX_UNCATEGORIZED,
    name: str = "name",
    seq: str = "seq",
) -> DataFrame:
    """Verdict on a candidate rule set, a document or its text: one row.

    ``status`` and ``reason``, the statistics ``total, uncategorized, ratio``, and the two lines of the report.
    The names behind them are the rows of :func:`uncategorized_names`. A text that is no JSON object and a
    document without categories are sent back, and refused on the last attempt. A candidate that leaves too
    many rows uncategorized is sent back too, but accepted on the last attempt.
    """
    last = attempt >= attempts
    document, reason = _document(candidate)
    if document is None:
        return df.sparkSession.range(0, 1, 1, 1).select(
            F.lit("rejected" if last else "retry").alias("status"),
            F.lit(reason).alias("reason"),
            F.lit(None).cast("bigint").alias("total"),
            F.lit(None).cast("bigint").alias("uncategorized"),
            F.lit(None).cast("double").alias("ratio"),
            F.lit(None).cast("string").alias("counts_line"),
            F.lit(None).cast("string").alias("names_line"),
        )
    summary = stats_summary(df, RuleSet.of(document), name=name, seq=seq)
    ratio = F.col("uncategorized") / F.greatest("total", F.lit(1))
    over = ratio > max_ratio
    lines = stats_text(summary, keep=("total", "uncategorized"))
    return lines.select(
        F.when(over & F.lit(not last), "retry").otherwise("accepted").alias("status"),
        F.when(over, "too many uncategorized").alias("reason"),
        "total",
        "uncategorized",
        ratio.alias("ratio"),
        "counts_line",
        "names_line",
    )


def _document(candidate: dict | str) -> tuple[dict | None, str | None]:
    if isinstance(candidate, str):
        try:
            candidate = json.loads(candidate)
        except json.JSONDecodeError:
            return None, "not JSON"
    if not isinstance(candidate, dict) or candidate.get("categories") is None:
        return None, "no categories"
    return candidate, None

"""Catalog, classification and search queries."""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import text
from shelfmark.operators import classify, products, readings, rules, search
from shelfmark.operators.numbering import numbered
from shelfmark.operators.rules import Category, RuleSet
from shelfmark.plans import browse, product_entry, rule_update
from shelfmark.schemas import RULES
from shelfmark.session import fresh_dir
from shelfmark.sources import documents
from shelfmark.sources.storage import read_version
from shelfmark.workload.tables import (
    CUSTOM_SQL,
    PARTS_SQL,
    PRICED_SQL,
    custom_products,
    parts,
    priced_catalog,
    read,
)

PART_RULES_DOC = {
    "version": 3,
    "name": "parts",
    "categories": [
        {
            "id": "tools",
            "name": "Tools",
            "keywords": ["anvil", "Gear", "rod"],
            "children": [
                {"id": "tools-warm", "name": "Warm tools", "keywords": ["HOT", "red"]},
                {"id": "tools-zinc", "name": "Zinc tools", "keywords": ["zinc"]},
            ],
        },
        {"id": "metal", "name": "Fasteners", "keywords": ["bolt", "ring", "RED"], "children": []},
        {"id": "temper", "name": "Tools", "keywords": ["cold", "hot"]},
        {"id": "rare", "name": "Rare", "keywords": ["zzz"]},
        {"id": "bare", "name": "Bare"},
    ],
}
PART_RULES = RuleSet.of(PART_RULES_DOC)
WIDE_RULES_DOC = {
    "categories": [*PART_RULES_DOC["categories"], {"id": "rest", "name": "Rest", "keywords": ["g"]}]
}

TEXT_RULES = RuleSet.of(
    {
        "categories": [
            {"id": "en", "name": "English", "keywords": [" the ", "ing "], "children": [
                {"id": "en-q", "name": "English, asked", "keywords": ["?", "wh"]}]},
            {"id": "fr", "name": "French", "keywords": [" ou ", "eaux", "é"]},
            {"id": "de", "name": "German", "keywords": ["sch", "ß", "ö"]},
            {"id": "es", "name": "Spanish", "keywords": ["ción", "ó"]},
            {"id": "key", "name": "Secrets", "keywords": ["TOKEN =", "password", "api_key"]},
        ]
    }
)
# More keywords than are tested one by one: all pairs of a consonant and a vowel, three pairs long.
SYLLABLES = RuleSet(
    tuple(
        Category(vowel, f"Syllables in {vowel}", tuple(
            f"{first}{vowel}{second}" for first in "bcdfghlmnprst" for second in "dlmnrst"
        ))
        for vowel in "aeiou"
    )
)

QUERIES_LIST = [("q1", "ring  RED"), ("q2", "12"), ("q3", "old a 7"), ("q4", "zinc"), ("q5", " \t ")]
# Readings of the digits.
DIGITS = dict(zip("0123456789", "ling yi er san si wu liu qi ba jiu".split()))
# A reading for every letter and digit of Latin-1.
LETTERS = {c: f"{chr(97 + i % 26)}{c}o" for i, c in enumerate(map(chr, range(256))) if c.isalnum()}
ACCENTS = {"é": "e", "è": "e", "ê": "e", "à": "a", "ç": "ss", "ó": "o", "ö": "oe", "ß": "ss", "ü": "ue"}


# ---- SQL of a rule set ----


def _quoted(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else "'" + value.replace("'", "''") + "'"


def match_sql(name: str, words: Iterable[str]) -> str:
    tests = [f"contains(lower({name}), lower({_quoted(word)}))" for word in words]
    return "coalesce(" + " OR ".join(tests) + ", FALSE)" if tests else "FALSE"


def labels_sql(table: str, rule_set: RuleSet, name: str = "name") -> str:
    return " UNION ALL ".join(
        f"SELECT *, {i} AS position, {_quoted(c.id)} AS category_id, {_quoted(c.name)} AS category_name "
        f"FROM ({table}) WHERE {match_sql(name, c.keywords)}"
        for i, c in enumerate(rule_set.categories)
    )


def children_sql(table: str, rule_set: RuleSet, name: str = "name") -> str:
    return " UNION ALL ".join(
        f"SELECT *, {_quoted(c.id)} AS category_id, {_quoted(child.id)} AS child_id FROM ({table}) "
        f"WHERE {match_sql(name, c.keywords)} AND {match_sql(name, child.keywords)}"
        for c in rule_set.categories
        for child in c.children
    )


def uncategorized_sql(table: str, rule_set: RuleSet, name: str = "name") -> str:
    tests = " OR ".join(match_sql(name, c.keywords) for c in rule_set.categories)
    return f"SELECT * FROM ({table}) WHERE NOT ({tests})"


def counts_sql(table: str, rule_set: RuleSet, name: str = "name") -> str:
    rows = [(-1, "all", "全部", f"SELECT * FROM ({table})")]
    rows += [
        (i, c.id, c.name, f"SELECT * FROM ({table}) WHERE {match_sql(name, c.keywords)}")
        for i, c in enumerate(rule_set.categories)
    ]
    rows.append((len(rule_set.categories), "uncategorized", rule_set.uncategorized_label,
                 uncategorized_sql(table, rule_set, name)))
    return " UNION ALL ".join(
        f"SELECT {i} AS position, {_quoted(cid)} AS category_id, {_quoted(label)} AS label, "
        f"(SELECT count(*) FROM ({sql})) AS n"
        for i, cid, label, sql in rows
    )


def coverage_sql(table: str, rule_set: RuleSet, name: str = "name") -> str:
    return f"""SELECT total, uncategorized, uncategorized / greatest(total, 1) AS ratio FROM (
        SELECT (SELECT count(*) FROM ({table})) AS total,
               (SELECT count(*) FROM ({uncategorized_sql(table, rule_set, name)})) AS uncategorized)"""


# ---- catalog ----


def merge_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.merge_catalog(priced_catalog(spark, sf_dir), custom_products(spark, sf_dir))


_MERGED_SQL = f"""
WITH catalog AS ({PRICED_SQL}), custom AS ({CUSTOM_SQL}), ranked AS (
    SELECT barcode, name, 'catalog' AS source, CAST(NULL AS VARCHAR) AS created_by,
           CAST(NULL AS VARCHAR) AS created_at, 0 AS origin, seq,
           row_number() OVER (PARTITION BY barcode ORDER BY seq DESC) AS pick FROM catalog
    UNION ALL
    SELECT barcode, name, 'custom', created_by, created_at, 1, seq,
           row_number() OVER (PARTITION BY barcode ORDER BY seq) FROM custom)
SELECT barcode, name, source, created_by, created_at, origin,
       (SELECT min(seq) FROM ranked r2 WHERE r2.barcode = r1.barcode AND r2.origin = r1.origin) AS seq
FROM ranked r1
WHERE pick = 1 AND (origin = 0 OR barcode NOT IN (SELECT barcode FROM catalog))
"""


def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.insert_if_absent(custom_products(spark, sf_dir), parts(spark, sf_dir))


_INSERT_SQL = f"""
WITH new AS ({CUSTOM_SQL}), old AS ({PARTS_SQL})
SELECT new.*, CASE WHEN barcode NOT IN (SELECT barcode FROM old)
                    AND row_number() OVER (PARTITION BY barcode ORDER BY seq) = 1
               THEN 'inserted' ELSE 'duplicate' END AS status FROM new
"""


def clean_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as form entries: names padded with white space of many kinds, and blank fields."""
    return products.clean_products(_entered(spark, sf_dir)).drop("seq")


def _entered(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent, odd = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderkey") % 2 == 1
    padded = F.concat(F.lit("\u3000 "), "o_orderpriority", F.lit("\t\xa0"))
    plain = F.concat(F.lit(" "), "o_orderpriority", F.lit("  "))
    return read(spark, sf_dir, "orders").select(
        F.when(urgent, F.when(odd, "\u3000").otherwise("  ")).otherwise(F.when(odd, padded).otherwise(plain))
        .alias("name"),
        F.when(F.col("o_orderstatus") == "O", F.when(odd, "\t").otherwise(" "))
        .otherwise(F.col("o_custkey").cast("string")).alias("barcode"),
        F.when(F.col("o_orderstatus") == "P", F.when(odd, "\n\r").otherwise("")).otherwise(F.col("o_orderstatus"))
        .alias("person"),
        (F.col("o_orderkey") * 86_400_000 + 1_700_000_000_000).alias("millis"),
        F.col("o_orderkey").alias("seq"),
    )


def enter_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of products entered by hand after the same entries were made twice, and then read back."""
    root = fresh_dir(spark, "entries")
    for _ in range(2):
        product_entry.enter_products(_entered(spark, sf_dir), parts(spark, sf_dir), root)
    return product_entry.custom_products(spark, root).drop("seq")


_CLEAN_SQL = """
SELECT CASE WHEN o_orderstatus = 'O'
            THEN 'custom-' || lower(to_base(o_orderkey * 86400000 + 1700000000000, 36))
            ELSE CAST(o_custkey AS VARCHAR) END AS barcode,
       o_orderpriority AS name, 'custom' AS source,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS created_by,
       strftime(make_timestamp((o_orderkey * 86400000 + 1700000000000) * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS created_at
FROM orders WHERE o_orderpriority <> '1-URGENT'
"""
_ENTER_SQL = f"""
SELECT * EXCLUDE (seq) FROM (SELECT c.*, o_orderkey AS seq FROM orders JOIN LATERAL (
    SELECT CASE WHEN o_orderstatus = 'O'
                THEN 'custom-' || lower(to_base(o_orderkey * 86400000 + 1700000000000, 36))
                ELSE CAST(o_custkey AS VARCHAR) END AS barcode,
           o_orderpriority AS name, 'custom' AS source,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS created_by,
           strftime(make_timestamp((o_orderkey * 86400000 + 1700000000000) * 1000), '%Y-%m-%dT%H:%M:%S.%gZ')
               AS created_at) AS c ON TRUE
    WHERE o_orderpriority <> '1-URGENT')
WHERE barcode IS NOT NULL AND barcode NOT IN (SELECT barcode FROM ({PARTS_SQL}))
QUALIFY row_number() OVER (PARTITION BY barcode ORDER BY seq) = 1
"""


def quality_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries over the form's limits, counted over documents."""
    entries = read(spark, sf_dir, "documents").select(
        F.col("text").alias("name"),
        F.concat_ws("/", "lang", "source", F.repeat("lang", F.col("n_chars").cast("int"))).alias("barcode"),
        F.concat("source", "lang").alias("person"),
    )
    flags = [f"{name}_too_long" for name in ("person", "name", "barcode")]
    return products.quality_limits(entries).groupBy(*flags).agg(F.count(F.lit(1)).alias("n"))


_LIMITS_SQL = """
SELECT coalesce(length(source || lang) > 40, FALSE) AS person_too_long,
       coalesce(length(text) > 120, FALSE) AS name_too_long,
       length(lang || '/' || source || '/' || repeat(lang, n_chars)) > 60 AS barcode_too_long,
       count(*) AS n FROM documents GROUP BY ALL
"""


# ---- rules ----


def _brand_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a rule-set document of its own."""
    word = F.split("p_name", " ")
    child = F.struct(
        F.col("p_brand").alias("id"), F.col("p_brand").alias("name"), F.array(F.col("p_type")).alias("keywords")
    )
    category = F.struct(
        F.col("p_type").alias("id"), F.lower("p_type").alias("name"), word.alias("keywords"),
        F.when(F.col("p_size") > 10, F.array(child)).alias("children"),
    )
    documents = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("version"),
        F.col("p_name").alias("name"),
        F.lit("none").alias("uncategorizedLabel"),
        F.when(F.col("p_size") < 45, F.array(category)).alias("categories"),
    )
    return documents.select(*[F.col(f.name).cast(f.dataType) for f in RULES])


def flatten_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.flatten_rules(_brand_rules(spark, sf_dir))


_FLAT_SQL = """
SELECT p_partkey AS version, 0 AS position, p_type AS category_id, lower(p_type) AS category_name,
       CAST(NULL AS VARCHAR) AS child_id, CAST(NULL AS VARCHAR) AS child_name,
       unnest(coalesce(string_split(p_name, ' '), [NULL])) AS keyword
FROM part WHERE p_size < 45
UNION ALL
SELECT p_partkey, 0, p_type, lower(p_type), p_brand, p_brand, p_type
FROM part WHERE p_size < 45 AND p_size > 10
UNION ALL
SELECT p_partkey, NULL, NULL, NULL, NULL, NULL, NULL FROM part WHERE coalesce(p_size >= 45, TRUE)
"""


def validate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.validate_rules(_brand_rules(spark, sf_dir)).select("version", "is_valid")


def next_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.next_version(_brand_rules(spark, sf_dir))


def current_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.current_rules(_brand_rules(spark, sf_dir)).select(
        "version", "name", F.col("categories")[0]["id"].alias("category_id"),
        F.array_join(F.col("categories")[0]["keywords"], " ").alias("words"),
    )


def evaluate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on candidates, as documents and as texts, in first and last attempts."""
    names = parts(spark, sf_dir)
    runs = [("narrow", PART_RULES_DOC, 1), ("narrow", json.dumps(PART_RULES_DOC), 3), ("wide", WIDE_RULES_DOC, 1),
            ("broken", {"version": 1}, 2), ("broken", "{}", 3), ("cut off", json.dumps(WIDE_RULES_DOC)[:-1], 1)]
    verdicts = [
        classify.evaluate_rules(names, doc, attempt)
        .withColumn("candidate", F.lit(label))
        .withColumn("attempt", F.lit(attempt))
        for label, doc, attempt in runs
    ]
    result = verdicts[0]
    for verdict in verdicts[1:]:
        result = result.unionByName(verdict)
    return result


def _verdict_sql(label: str, rule_set: RuleSet, attempt: int) -> str:
    return f"""SELECT '{label}' AS candidate, {attempt} AS attempt,
        CASE WHEN ratio > 0.2 AND {attempt} < 3 THEN 'retry' ELSE 'accepted' END AS status,
        CASE WHEN ratio > 0.2 THEN 'too many uncategorized' END AS reason, total, uncategorized, ratio, {_lines_sql(rule_set)}
        FROM ({coverage_sql(PARTS_SQL, rule_set)})"""


def _lines_sql(rule_set: RuleSet) -> str:
    rest = uncategorized_sql(PARTS_SQL, rule_set)
    return f"""(SELECT string_agg(category_name || '：' || n || ' 件', '　' ORDER BY place, position)
            FROM (SELECT category_name, count(*) AS n, min(seq) AS place, min(position) AS position
                  FROM ({labels_sql(PARTS_SQL, rule_set)}) GROUP BY 1))
           || '　未分类：' || (SELECT count(*) FROM ({rest})) || ' 件' AS counts_line,
       (SELECT '未分类商品：' || string_agg(name, '、' ORDER BY seq)
               || CASE WHEN (SELECT count(*) FROM ({rest})) > 10 THEN '…' ELSE '' END
        FROM (SELECT * FROM ({rest}) ORDER BY seq LIMIT 10)) AS names_line"""


def _broken_sql(attempt: int, status: str, candidate: str = "broken", reason: str = "no categories") -> str:
    return f"""SELECT '{candidate}' AS candidate, {attempt} AS attempt, '{status}' AS status,
        '{reason}' AS reason, CAST(NULL AS BIGINT) AS total, CAST(NULL AS BIGINT) AS uncategorized,
        CAST(NULL AS DOUBLE) AS ratio, CAST(NULL AS VARCHAR) AS counts_line, CAST(NULL AS VARCHAR) AS names_line"""


_EVALUATE_SQL = " UNION ALL ".join(
    [
        _verdict_sql("narrow", PART_RULES, 1),
        _verdict_sql("narrow", PART_RULES, 3),
        _verdict_sql("wide", RuleSet.of(WIDE_RULES_DOC), 1),
        _broken_sql(2, "retry"),
        _broken_sql(3, "rejected"),
        _broken_sql(1, "retry", "cut off", "not JSON"),
    ]
)


# ---- classification ----


#: Rows of a JSON document, by their numbers.
DOCUMENT_ROWS = 10_000


def _write_documents(rows: DataFrame, number: str, columns: list[str], path: str) -> None:
    """JSON arrays of rows in order of ``number``, each of a bounded stretch of numbers, in a folder ``doc=`` of its own."""
    fields = F.struct(*columns)
    ordered = F.array_sort(F.collect_list(F.struct(F.col(number).alias("at"), fields.alias("row"))))
    doc = F.coalesce(F.expr(f"{number} div {DOCUMENT_ROWS}"), F.lit(2**63 - 1))
    listed = rows.groupBy(doc.alias("doc")).agg(ordered.alias("rows"))
    written = listed.select("doc", F.to_json(F.transform("rows", lambda r: r["row"])).alias("value"))
    written.write.partitionBy("doc").text(path)


def _numbered(products: DataFrame) -> DataFrame:
    """Products of many documents with ``number``, their place among all."""
    return numbered(products, ["doc", "seq"], "number")


def documents_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog, a list of custom products and rule sets, written as JSON documents of bounded size and read back."""
    root = fresh_dir(spark, "documents")
    _write_documents(parts(spark, sf_dir), "seq", ["barcode", "name"], f"{root}/catalog")
    custom = parts(spark, sf_dir).where("seq % 7 = 0").select(
        "seq", "barcode", F.lit(None).cast("string").alias("name"), F.lit("custom").alias("source"),
        F.col("name").alias("createdBy"),
    )
    _write_documents(custom, "seq", custom.columns[1:], f"{root}/custom")
    rules = _brand_rules(spark, sf_dir)
    _write_documents(rules, "version", rules.columns, f"{root}/rules")
    read_back = _numbered(documents.read_catalog(spark, f"{root}/catalog"))
    entered = documents.read_custom_products(spark, f"{root}/custom")
    rule_sets = documents.read_rules(spark, f"{root}/rules")
    return (
        read_back.select(F.lit("catalog").alias("kind"), "number", "barcode", F.col("name").alias("text"))
        .unionByName(entered.select(F.lit("custom").alias("kind"), F.lit(0).cast("bigint").alias("number"), "barcode",
                                    F.col("created_by").alias("text")))
        .unionByName(rule_sets.select(F.lit("rules").alias("kind"), F.col("version").alias("number"),
                                      F.lit(None).cast("string").alias("barcode"), F.col("name").alias("text")))
    )


def publish_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule set in force after a refused, a first and a second candidate."""
    path = f"{fresh_dir(spark, 'rules')}/rules"
    names = parts(spark, sf_dir)
    for document, attempt in (("{}", 1), (WIDE_RULES_DOC, 3), (PART_RULES_DOC, 3)):
        rule_update.update_rules(spark, names, document, path, attempt)
    published = read_version(spark, path)
    return rules.flatten_rules(rules.current_rules(published)).select("version", "category_id", "child_id", "keyword")


_PUBLISHED_RULES_SQL = " UNION ALL ".join(
    f"SELECT 2 AS version, {_quoted(c.id)} AS category_id, {_quoted(child_id)} AS child_id, {_quoted(word)} AS keyword"
    for c in PART_RULES.categories
    for child_id, words in [(None, c.keywords), *((child.id, child.keywords) for child in c.children)]
    for word in (words or [None])
)


def stats_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one row of rule-set statistics."""
    summary = classify.stats_summary(parts(spark, sf_dir), PART_RULES)
    return summary.select(
        "total", "uncategorized", F.size("per_category").alias("n_categories"),
        F.array_join("first_uncategorized", "|").alias("first_names"),
    )


def visible_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many products each view shows."""
    views = [("all", {}), ("tools", {"category": "tools"}), ("rest", {"category": search.UNCATEGORIZED, "query": "wid"}),
             ("none", {"category": "no such"}), ("red", {"query": "red 1"})]
    counted = [
        search.visible_products(parts(spark, sf_dir), PART_RULES, **view).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("view"), "n")
        for name, view in views
    ]
    return reduce(DataFrame.unionByName, counted)


def label_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.label_products(parts(spark, sf_dir), PART_RULES)


def label_subcategories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.label_subcategories(parts(spark, sf_dir), PART_RULES)


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.category_counts(parts(spark, sf_dir), PART_RULES)


def subcategory_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.subcategory_counts(parts(spark, sf_dir), PART_RULES)


def rule_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.rule_stats(parts(spark, sf_dir), PART_RULES)


def stats_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.stats_text(classify.stats_summary(parts(spark, sf_dir), PART_RULES))


_REST_SQL = uncategorized_sql(PARTS_SQL, PART_RULES)
_REPORT_SQL = f"SELECT {_lines_sql(PART_RULES)}"


def uncategorized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.uncategorized(parts(spark, sf_dir), PART_RULES)


def uncategorized_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.uncategorized_names(parts(spark, sf_dir), PART_RULES)


def uncategorized_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.uncategorized_sample(parts(spark, sf_dir), PART_RULES)


def coverage_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.coverage_gate(parts(spark, sf_dir), PART_RULES)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", "text")


_DOCUMENTS_SQL = "SELECT doc_id, text FROM documents"


def label_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = classify.label_products(_documents(spark, sf_dir), TEXT_RULES, "text")
    return labels.select("doc_id", "category_id")


def label_document_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = classify.label_subcategories(_documents(spark, sf_dir), TEXT_RULES, "text")
    return labels.select("doc_id", "category_id", "child_id")


def label_documents_many_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = classify.label_products(_documents(spark, sf_dir), SYLLABLES, "text")
    return labels.select("doc_id", "category_id")


def document_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.category_counts(_documents(spark, sf_dir), TEXT_RULES, "text")


# ---- search ----


def visible_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.visible_products(parts(spark, sf_dir), PART_RULES, "tools", "tools-warm", "1 GEAR")


def visible_uncategorized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.visible_products(parts(spark, sf_dir), PART_RULES, search.UNCATEGORIZED, query="wid")


def search_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_products(parts(spark, sf_dir), "ring  RED 1")


def search_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries made of the customers' keys and a vowel, of the nations' first letters and a digit, and a few of other kinds.

    Every customer is a query, and a key lies in a barcode once, so that the result grows with the parts.
    """
    vowel = F.substring(F.lit("AEIOU"), (F.col("c_nationkey") % 5 + 1).cast("int"), F.lit(1))
    keys = read(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), "c_custkey").alias("query_id"), F.concat_ws("  ", "c_custkey", vowel).alias("query")
    )
    made = read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("query_id"),
        F.concat(F.lower(F.substring("n_name", 1, 1)), F.lit("\u3000"), (F.col("n_nationkey") % 10).cast("string"))
        .alias("query"),
    )
    fixed = spark.createDataFrame(QUERIES_LIST, "query_id string, query string")
    return search.search_batch(parts(spark, sf_dir), made.unionByName(fixed).unionByName(keys))


def _found_sql(query: str) -> str:
    tests = [f"contains(lower(name), '{t}') OR contains(barcode, '{t}')" for t in text.split_terms(query)]
    return " AND ".join(f"({test})" for test in tests) or "TRUE"


def own_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that hold all words, or any word, of their own address."""
    words = text.terms(F.translate("url", "/.:-?=", "      "))
    pages = read(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        F.size(words).alias("n_words"),
        text.contains_all(F.lower("html"), words).alias("holds_all"),
        text.contains_any(F.col("html"), words).alias("holds_any"),
    )


_OWN_WORDS_SQL = """
SELECT page_id, CAST(len(words) AS INTEGER) AS n_words,
       len(list_filter(words, lambda w: contains(lower(html), w))) = len(words) AS holds_all,
       len(list_filter(words, lambda w: contains(lower(html), w))) > 0 AS holds_any
FROM (SELECT *, list_filter(regexp_split_to_array(lower(regexp_replace(url, '[/.:=?-]', ' ', 'g')), '\\s+'),
                            lambda w: w <> '') AS words FROM pages)
"""


def add_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations read out by a dictionary of all letters and digits of Latin-1, some with two readings."""
    texts = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("name"))
    entries = [(char, reading) for char, reading in LETTERS.items()] + [("a", "zz")]
    dictionary = readings.load_dictionary(spark.createDataFrame(entries, "char string, reading string"))
    return readings.add_readings(texts, dictionary)


def _replaced(column: str, table: dict[str, str]) -> str:
    for char, reading in table.items():
        column = f"replace({column}, '{char}', '{reading}')"
    return f"lower({column})"


def search_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents found by letters without accents."""
    documents = read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("barcode"), F.col("text").alias("name")
    )
    return search.search_products(readings.add_readings(documents, ACCENTS), "ETION euxss").select("barcode")


_ACCENT_SQL = _replaced("text", ACCENTS)
_FIRST_ACCENT_SQL = _replaced("text", {char: reading[0] for char, reading in ACCENTS.items()})


def browse_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged list with readings of digits, one category, found by a reading."""
    merged = browse.load_products(
        priced_catalog(spark, sf_dir), custom_products(spark, sf_dir), DIGITS
    )
    found = browse.browse(merged, PART_RULES, "metal", query="ring econ")
    return found.select("barcode", "name", "source")


_BROWSE_SQL = f"""
SELECT barcode, name, source FROM ({_MERGED_SQL})
WHERE {match_sql('name', PART_RULES.categories[1].keywords)}
  AND contains(lower(name), 'ring') AND contains(lower(name), 'econ')
"""


# ---- names ----


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"part": "p_name", "customer": "c_name", "supplier": "s_name", "nation": "n_name"}
    names = [read(spark, sf_dir, t).select(F.col(c).alias("name")) for t, c in columns.items()]
    texts = read(spark, sf_dir, "conversations").select(F.col("text").alias("name"))
    for other in names:
        texts = texts.unionByName(other)
    return texts


_NAMES_SQL = (
    "SELECT text AS name FROM conversations UNION ALL SELECT p_name FROM part UNION ALL "
    "SELECT c_name FROM customer UNION ALL SELECT s_name FROM supplier UNION ALL SELECT n_name FROM nation"
)


def name_hash_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    hues = _names(spark, sf_dir).withColumn("hue", text.name_hue(F.col("name")))
    return hues.groupBy("hue", text.second_hue(F.col("hue")).alias("second_hue")).agg(
        F.count(F.lit(1)).alias("n")
    )


_HUE_SQL = f"""
SELECT hue, (hue + 40) % 360 AS second_hue, count(*) AS n FROM (
    SELECT list_reduce(list_transform(string_split(name, ''), lambda c: CAST(unicode(c) AS BIGINT)),
                       lambda h, code: (h * 31 + code) % 360, CAST(0 AS BIGINT)) AS hue FROM ({_NAMES_SQL}))
GROUP BY ALL
"""


def first_glyph_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    glyph = text.first_glyph(F.col("text")).alias("glyph")
    return read(spark, sf_dir, "documents").groupBy(glyph).agg(F.count(F.lit(1)).alias("n"))


_GLYPH_SQL = """
SELECT coalesce(nullif(regexp_extract(text, '[一-龥A-Za-z0-9]', 0), ''), '？') AS glyph, count(*) AS n
FROM documents GROUP BY 1
"""

QUERIES = {
    f.__name__: f
    for f in (
        merge_catalog, insert_if_absent, clean_products, enter_products, quality_limits, flatten_rules, validate_rules,
        next_version, current_rules, evaluate_rules, label_products, label_subcategories, category_counts,
        subcategory_counts, rule_stats, stats_report, uncategorized, uncategorized_names, uncategorized_sample, coverage_gate,
        label_documents, label_document_children, label_documents_many_keywords, document_category_counts,
        documents_round_trip, publish_rules, stats_totals, visible_count,
        visible_products, visible_uncategorized, search_products, search_batch, own_words, add_readings,
        search_readings, browse_products, name_hash_buckets, first_glyph_index,
    )
}

ORACLE = {
    "merge_catalog": _MERGED_SQL,
    "insert_if_absent": _INSERT_SQL,
    "clean_products": _CLEAN_SQL,
    "enter_products": _ENTER_SQL,
    "quality_limits": _LIMITS_SQL,
    "flatten_rules": _FLAT_SQL,
    "validate_rules": "SELECT p_partkey AS version, p_size < 45 AS is_valid FROM part",
    "next_version": "SELECT coalesce(max(p_partkey), 0) + 1 AS next_version FROM part",
    "current_rules": """
        SELECT p_partkey AS version, p_name AS name, CASE WHEN p_size < 45 THEN p_type END AS category_id,
               CASE WHEN p_size < 45 THEN p_name END AS words
        FROM part ORDER BY p_partkey DESC LIMIT 1""",
    "evaluate_rules": _EVALUATE_SQL,
    "documents_round_trip": f"""
        SELECT 'catalog' AS kind, row_number() OVER (ORDER BY seq) AS number, barcode, name AS text FROM ({PARTS_SQL})
        UNION ALL SELECT 'custom', 0, barcode, name FROM ({PARTS_SQL}) WHERE seq % 7 = 0
        UNION ALL SELECT 'rules', p_partkey, NULL, p_name FROM part""",
    "publish_rules": _PUBLISHED_RULES_SQL,
    "stats_totals": f"""SELECT (SELECT count(*) FROM ({PARTS_SQL})) AS total, (SELECT count(*) FROM ({_REST_SQL})) AS uncategorized,
        (SELECT CAST(count(DISTINCT category_name) AS INTEGER) FROM ({labels_sql(PARTS_SQL, PART_RULES)})) AS n_categories,
        (SELECT string_agg(name, '|' ORDER BY seq) FROM (SELECT * FROM ({_REST_SQL}) ORDER BY seq LIMIT 10)) AS first_names""",
    "visible_count": " UNION ALL ".join(
        f"SELECT '{view}' AS view, (SELECT count(*) FROM ({sql})) AS n"
        for view, sql in (
            ("all", PARTS_SQL),
            ("tools", f"SELECT * FROM ({PARTS_SQL}) WHERE {match_sql('name', PART_RULES.categories[0].keywords)}"),
            ("rest", f"SELECT * FROM ({_REST_SQL}) WHERE {_found_sql('wid')}"),
            ("none", f"SELECT * FROM ({PARTS_SQL}) WHERE FALSE"),
            ("red", f"SELECT * FROM ({PARTS_SQL}) WHERE {_found_sql('red 1')}"),
        )
    ),
    "label_products": f"SELECT * EXCLUDE (position) FROM ({labels_sql(PARTS_SQL, PART_RULES)})",
    "label_subcategories": children_sql(PARTS_SQL, PART_RULES),
    "category_counts": counts_sql(PARTS_SQL, PART_RULES),
    "subcategory_counts": " UNION ALL ".join(
        f"SELECT {i} AS position, {_quoted(c.id)} AS category_id, {_quoted(child.id)} AS child_id, "
        f"{_quoted(child.name)} AS label, (SELECT count(*) FROM ({PARTS_SQL}) WHERE "
        f"{match_sql('name', c.keywords)} AND {match_sql('name', child.keywords)}) AS n"
        for i, (c, child) in enumerate((c, x) for c in PART_RULES.categories for x in c.children)
    ),
    "rule_stats": f"SELECT category_name, count(*) AS n FROM ({labels_sql(PARTS_SQL, PART_RULES)}) GROUP BY 1",
    "stats_report": _REPORT_SQL,
    "uncategorized": _REST_SQL,
    "uncategorized_names": f"SELECT seq, name FROM ({_REST_SQL})",
    "uncategorized_sample": f"SELECT seq, name FROM ({_REST_SQL}) ORDER BY seq LIMIT 10",
    "coverage_gate": f"SELECT *, NOT (ratio > 0.2) AS passes FROM ({coverage_sql(PARTS_SQL, PART_RULES)})",
    "label_documents": f"SELECT doc_id, category_id FROM ({labels_sql(_DOCUMENTS_SQL, TEXT_RULES, 'text')})",
    "label_document_children": "SELECT doc_id, category_id, child_id FROM "
    f"({children_sql(_DOCUMENTS_SQL, TEXT_RULES, 'text')})",
    "label_documents_many_keywords": "SELECT doc_id, category_id FROM "
    f"({labels_sql(_DOCUMENTS_SQL, SYLLABLES, 'text')})",
    "document_category_counts": counts_sql(_DOCUMENTS_SQL, TEXT_RULES, "text"),
    "visible_products": f"""
        SELECT * FROM ({PARTS_SQL}) WHERE {match_sql('name', PART_RULES.categories[0].keywords)}
        AND {match_sql('name', PART_RULES.categories[0].children[0].keywords)} AND {_found_sql('1 gear')}""",
    "visible_uncategorized": f"SELECT * FROM ({_REST_SQL}) WHERE {_found_sql('wid')}",
    "search_products": f"SELECT * FROM ({PARTS_SQL}) WHERE {_found_sql('ring red 1')}",
    "search_batch": " UNION ALL ".join(
        f"SELECT '{query_id}' AS query_id, * FROM ({PARTS_SQL}) WHERE {_found_sql(query)}"
        for query_id, query in QUERIES_LIST
    )
    + f""" UNION ALL SELECT CAST(n_nationkey AS VARCHAR), p.* FROM nation, ({PARTS_SQL}) AS p
        WHERE (contains(lower(name), lower(left(n_name, 1))) OR contains(barcode, lower(left(n_name, 1))))
          AND (contains(lower(name), CAST(n_nationkey % 10 AS VARCHAR))
               OR contains(barcode, CAST(n_nationkey % 10 AS VARCHAR)))
        UNION ALL SELECT 'c' || c_custkey, p.* FROM customer, ({PARTS_SQL}) AS p
        WHERE (contains(barcode, CAST(c_custkey AS VARCHAR)) OR contains(lower(name), CAST(c_custkey AS VARCHAR)))
          AND (c_nationkey IS NULL OR contains(lower(name), lower(substr('AEIOU', c_nationkey % 5 + 1, 1)))
               OR contains(barcode, lower(substr('AEIOU', c_nationkey % 5 + 1, 1))))""",
    "own_words": _OWN_WORDS_SQL,
    "add_readings": f"""
        WITH dictionary AS (SELECT MAP {{{', '.join(f"'{c}': '{r}'" for c, r in LETTERS.items())}}} AS entries)
        SELECT conv_id, turn, text AS name,
               lower(array_to_string(list_transform(string_split(text, ''), lambda c: coalesce(entries[c], c)), ''))
                   AS reading,
               lower(array_to_string(list_transform(string_split(text, ''), lambda c: coalesce(left(entries[c], 1), c)), ''))
                   AS initials
        FROM conversations, dictionary""",
    "search_readings": f"""
        SELECT CAST(doc_id AS VARCHAR) AS barcode FROM documents WHERE """
    + " AND ".join(
        f"(contains(lower(text), '{t}') OR contains(CAST(doc_id AS VARCHAR), '{t}') "
        f"OR contains({_ACCENT_SQL}, '{t}') OR contains({_FIRST_ACCENT_SQL}, '{t}'))"
        for t in ("etion", "euxss")
    ),
    "browse_products": _BROWSE_SQL,
    "name_hash_buckets": _HUE_SQL,
    "first_glyph_index": _GLYPH_SQL,
}

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfmark.functions import keywords
from shelfmark.operators import classify, rules
from shelfmark.operators.rules import RuleSet
from shelfmark.plans.rule_update import load_rules, update_rules
from shelfmark.schemas import RULES
from shelfmark.sources.documents import read_rules

DOC = {
    "version": 4,
    "categories": [
        {"id": "soft", "name": "Plush", "keywords": ["Bear", "兔", None],
         "children": [{"id": "soft-big", "name": "Big", "keywords": ["BIG"]},
                      {"id": "soft-nil", "name": "Nil"}]},
        {"id": "bag", "name": "Bags", "keywords": ["bag"]},
        {"id": "soft2", "name": "Plush", "keywords": ["fox"]},
        {"id": "none", "name": "None"},
    ],
}
RULE_SET = RuleSet.of(DOC)
NAMES = ["big bear bag", "BEAR", "邦尼兔", "fox bear", "big bag", "stone", None, "100% ''"]


@pytest.fixture
def products(spark):
    return spark.createDataFrame(list(enumerate(NAMES)), "seq long, name string").repartition(3)


def test_labels(products):
    assert rows(classify.label_products(products, RULE_SET), "seq", "category_id") == [
        (0, "bag"), (0, "soft"), (1, "soft"), (2, "soft"), (3, "soft"), (3, "soft2"), (4, "bag")]


def test_a_child_needs_its_parent(products):
    assert rows(classify.label_subcategories(products, RULE_SET), "seq", "child_id") == [(0, "soft-big")]
    counts = classify.subcategory_counts(products, RULE_SET)
    assert rows(counts, "child_id", "n") == [("soft-big", 1), ("soft-nil", 0)]


def test_counts_by_id_keep_zeros(products):
    assert rows(classify.category_counts(products, RULE_SET), "position", "category_id", "n") == [
        (-1, "all", 8), (0, "soft", 4), (1, "bag", 2), (2, "soft2", 1), (3, "none", 0),
        (4, "uncategorized", 3)]
    nothing = products.where("false")
    assert {r["n"] for r in classify.category_counts(nothing, RULE_SET).collect()} == {0}


def test_counts_by_name_add_up(products):
    assert rows(classify.rule_stats(products, RULE_SET)) == [("Bags", 2), ("Plush", 5)]


def test_uncategorized_and_summary(products):
    assert rows(classify.uncategorized(products, RULE_SET), "seq") == [(5,), (6,), (7,)]
    sample = classify.uncategorized_sample(products, RULE_SET, 2)
    assert [r["seq"] for r in sample.collect()] == [5, 6]
    summary = classify.stats_summary(products, RULE_SET, 2).first()
    assert (summary["total"], summary["uncategorized"]) == (8, 3)
    assert list(summary["per_category"].items()) == [("Plush", 5), ("Bags", 2)]
    assert summary["first_uncategorized"] == ["stone", None]
    text = classify.stats_text(classify.stats_summary(products.where("name is not null"), RULE_SET), 1).first()
    assert text["counts_line"] == "Plush：5 件　Bags：2 件　未分类：2 件"
    assert text["names_line"] == "未分类商品：stone…"
    empty = classify.stats_summary(products.where("false"), RULE_SET).first()
    assert (empty["total"], empty["per_category"], empty["first_uncategorized"]) == (0, {}, [])


def test_gate_is_strict(spark, products):
    five = spark.createDataFrame([("bear",)] * 4 + [("stone",)], "name string")
    assert classify.coverage_gate(five, RULE_SET).first()["passes"] is True
    assert classify.coverage_gate(five, RULE_SET, 0.19).first()["passes"] is False
    empty = classify.coverage_gate(five.where("false"), RULE_SET).first()
    assert (empty["total"], empty["ratio"], empty["passes"]) == (0, 0.0, True)


def test_empty_keyword_matches_every_text(products):
    rule_set = RuleSet.of({"categories": [{"id": "e", "name": "E", "keywords": ["", "zzz"]}]})
    assert rows(classify.label_products(products, rule_set), "seq") == [(i,) for i in (0, 1, 2, 3, 4, 5, 7)]


def test_many_groups_match_as_one_by_one(spark):
    words = [f"{a}{b}" for a in "abcd" for b in "abcde"] + ["aab", "b", "İ", "ß"]
    groups = [words[i : i + 3] for i in range(0, len(words), 2)] + [[], [""]]
    texts = ["aabbcc", "xyz", "DACABE", "", None, "Straße b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for every in (False, True):
        test = all if every else any
        found = {r["t"]: r["hits"] for r in keywords.with_hits(df, F.col("t"), groups, "hits", every).collect()}
        for t in texts:
            low = None if t is None else t.lower()
            want = [i for i, g in enumerate(groups) if test(low is not None and w.lower() in low for w in g)]
            assert found[t] == want


def test_matching_runs_once_and_without_a_shuffle(spark, products):
    plan = classify.label_products(products, RULE_SET)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    assert plan.count("lower(name") + plan.count("scan(") <= 2


def test_verdicts(products):
    def verdict(doc, attempt):
        row = classify.evaluate_rules(products, doc, attempt).first()
        return row["status"], row["reason"]

    assert verdict(DOC, 1) == verdict(DOC, 2) == ("retry", "too many uncategorized")
    assert verdict(DOC, 3) == ("accepted", "too many uncategorized")
    assert verdict({"version": 1}, 1) == ("retry", "no categories")
    assert verdict({"version": 1}, 3) == ("rejected", "no categories")
    wide = {"categories": [{"id": "x", "name": "X", "keywords": ["", "b"]}]}
    assert verdict(wide, 1) == ("accepted", None)


def test_rule_documents(spark, tmp_path):
    path = tmp_path / "rules.json"
    assert read_rules(spark, str(path)).count() == 0
    path.write_text(json.dumps(DOC, ensure_ascii=False, indent=2), encoding="utf-8")
    document = read_rules(spark, str(path))
    assert RuleSet.of_row(document.first()) == RULE_SET
    flat = rows(rules.flatten_rules(document), "category_id", "child_id", "keyword")
    assert ("soft", "soft-big", "BIG") in flat and ("none", None, None) in flat and len(flat) == 8
    assert rules.validate_rules(document).first()["is_valid"] is True


def test_versions_of_rules(spark):
    documents = spark.createDataFrame([(2, "b", None, None), (5, "e", None, None)], RULES)
    assert rules.next_version(documents).first()[0] == 6
    assert rules.next_version(documents.where("false")).first()[0] == 1
    assert rows(rules.current_rules(documents), "version", "name") == [(5, "e")]
    assert rules.current_rules(documents.where("false")).count() == 0


def test_rule_update_publishes_accepted_sets(spark, products, tmp_path):
    path = str(tmp_path)
    assert load_rules(spark, path) is None
    assert update_rules(spark, products, DOC, path, attempt=1)[0] == "retry"
    status, first = update_rules(spark, products, DOC, path, attempt=3)
    assert status == "accepted" and first.version == 1 and load_rules(spark, path) == first
    assert update_rules(spark, products, DOC, path, attempt=3)[1].version == 2
    assert load_rules(spark, path).version == 2


def test_many_words_match_as_one_by_one(spark):
    some = ["ab", "abc", "b", "cab", "x.y", "a|b", "[", "\\", "^", "$", "", "é", "😀", "漢字", " ", "-", "q" * 150, "q" * 99]
    texts = ["", None, "xaby", "x.y", "xzy", "a|b", "[]", "\\", "^", "漢", "漢字", "😀", "é", "a b", "q" * 149, "q" * 150, "-"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for words in (some[:10], some[1:], [w for w in some if w], some[3:10] + some[14:], [w for w in some if len(w) > 1]):
        found = df.select("i", keywords.matches(F.col("t"), words).alias("hit"), keywords.any_of(F.col("t"), words).alias("want"))
        assert all(r["hit"] == r["want"] == any(w in (texts[r["i"]] or "\0") for w in words if texts[r["i"]] is not None)
                   for r in found.collect())

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfmark.operators import delta
from shelfmark.operators.delta import history_until, lookup_asof, lookup_values, new_values
from shelfmark.operators.extract import first_seen
from shelfmark.plans.daily_lookup import backfill, daily_run, publish, run_day, run_new_files
from shelfmark.schemas import DAY_TRIPLE, TRIPLE
from shelfmark.sources import commits, ledger, ranges, seen, storage
from shelfmark.sources.registry import Settings, SourceSpec
from shelfmark.workload.tables import SPECS

SPEC = SPECS["events"]
DAYS = [f"2024-01-0{d}" for d in range(1, 6)]
DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    base = dt.datetime(2024, 1, 1)
    data = [
        (base + dt.timedelta(hours=7 * i), None if i % 5 == 0 else i % 3, ["view", "click"][i % 2],
         None if i % 7 == 0 else f"p{i % 6}")
        for i in range(17)
    ]
    return spark.createDataFrame(data, "ts timestamp_ntz, user_id int, event_type string, props string")


def raw(spark, root):
    return storage.read_days(spark, root, storage.RAW)


def test_difference_treats_null_companies_as_equal(spark):
    fresh = spark.createDataFrame([(None, "c", "1"), (None, "c", "2"), ("a", "c", "1"), ("a", "c", "1")], TRIPLE)
    history = spark.createDataFrame([(None, "c", "1"), ("b", "c", "1"), (None, "c", "1")], TRIPLE)
    found = new_values(fresh, history)
    assert rows(found) == [(None, "c", "2"), ("a", "c", "1")]


def test_history_is_cut_before_it_is_shuffled(spark, events, tmp_path):
    days = first_seen(events, SPEC)
    days.write.parquet(str(tmp_path / "days"))
    history = spark.read.parquet(str(tmp_path / "days"))
    keys = list(history.columns[:3])
    fresh = history.where("ds = date'2024-01-02'").select(*keys)
    for found in (new_values(fresh, history), delta.unseen(fresh, history, keys, ("company_guid",))):
        plan = found._jdf.queryExecution().sparkPlan().toString().splitlines()
        semi = [line for line in plan if "LeftSemi" in line]
        assert len(semi) == 1 and "BroadcastHashJoin" in semi[0]
        # Above the history's scan the cut comes first: no aggregate or other join lies between.
        scans = [i for i, line in enumerate(plan) if "FileScan" in line]
        between = plan[plan.index(semi[0]) + 1 : min(i for i in scans if i > plan.index(semi[0]))]
        assert not any("Aggregate" in line or "Join" in line for line in between)


def test_daily_runs_equal_the_backfill_and_can_be_repeated(spark, events, tmp_path):
    root = str(tmp_path)
    for day in DAYS:
        run_day(spark, root, [SPEC], lambda name: events, day)
    run_day(spark, root, [SPEC], lambda name: events, DAYS[-1])
    run_day(spark, root, [SPEC], lambda name: events, DAYS[2])
    assert rows(raw(spark, root)) == rows(first_seen(events, SPEC))
    plan = raw(spark, root).where("ds <= date'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan


def test_backfill_in_one_job(spark, events, tmp_path):
    daily, at_once = str(tmp_path / "daily"), str(tmp_path / "once")
    specs = [SPEC, SourceSpec("others", ("event_type",), company=None)]
    for day in DAYS[1:4]:
        run_day(spark, daily, specs, lambda name: events, day)
    backfill(spark, at_once, specs, lambda name: events, DAYS[1], DAYS[3])
    assert rows(raw(spark, daily)) == rows(raw(spark, at_once))


@pytest.mark.parametrize("bounds", [
    {"MOST_GENERATIONS": 1, "PREFIX_KEYS": 1, "ROUND_KEYS": 2, "FILTER_KEYS": 0, "BROADCAST_KEYS": 0},
    {"MOST_GENERATIONS": 3, "PREFIX_KEYS": 2, "BROADCAST_KEYS": 8}])
def test_many_prefixes_rounds_and_merges_give_the_same(spark, events, tmp_path, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(seen, name, value)
    root = str(tmp_path)
    for day in [*DAYS, DAYS[2], DAYS[4], DAYS[0]]:
        run_day(spark, root, [SPEC], lambda name: events, day)
    assert rows(raw(spark, root)) == rows(first_seen(events, SPEC))
    assert len(seen.refresh(spark, root)) <= bounds["MOST_GENERATIONS"]
    assert {d for g in seen.manifest(spark, root) for d in g.days} == {dt.date.fromisoformat(d) for d in DAYS}


def test_a_history_without_the_keys_is_hardly_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(seen, "BROADCAST_KEYS", 1000)

    def keys(prefix, n):
        return spark.range(n).selectExpr("'a' AS company_guid", "'t.c' AS column_name", f"'{prefix}' || id AS column_value")

    root = str(tmp_path)
    storage.write_day(keys("old", 200_000), root, storage.RAW, "2024-01-01")
    generation, = seen.refresh(spark, root)
    fresh = seen.hashed(keys("new", 500_000))
    assert seen.suspects(fresh, root, generation).count() < 0.02 * 500_000
    assert seen.suspects(seen.hashed(keys("old", 200_000)), root, generation).count() == 200_000
    # Neither the lookup by filter nor that by prefix shuffles what the index holds.
    some = seen.hashed(keys("old", 100).unionByName(keys("new", 100)))
    assert seen.unknown(some, root, [generation], DAY).count() == 100
    assert seen.new_triples(keys("new", 500_000), root, DAY).count() == 500_000
    assert seen.new_triples(keys("old", 200_000), root, DAY).count() == 0
    assert seen.new_triples(keys("old", 10), root, DAY - dt.timedelta(days=1)).count() == 10
    plan = seen.suspects(fresh, root, generation)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_fresh_keys_cut_an_unrelated_history(spark):
    history = spark.range(100_000).selectExpr("'h' || id AS id")
    fresh = spark.range(300_000).selectExpr("'f' || id AS id")
    assert delta.hits(history, fresh, ["id"]).count() < 0.02 * 100_000
    assert delta.hits(history, history.limit(500), ["id"]).count() >= 500


def test_backfill_loses_no_triple_of_later_days(spark, tmp_path):
    def source(*days):
        data = [(dt.datetime.fromisoformat(d), 1, "view", "p") for d in days]
        return spark.createDataFrame(data, "ts timestamp_ntz, user_id int, event_type string, props string")

    for staged in (True, False):
        root = str(tmp_path / str(staged))
        if staged:
            for day in ("2024-01-13", "2024-01-14"):
                run_day(spark, root, [SPEC], lambda name: source("2024-01-13", "2024-01-14"), day)
        else:
            backfill(spark, root, [SPEC], lambda name: source("2024-01-13", "2024-01-14"), "2024-01-13", "2024-01-14")
        found = raw(spark, root)
        assert rows(found.select("ds").distinct()) == [(dt.date(2024, 1, 13),)]
        n = found.count()
        # The row of the 13th goes, that of the 14th stays.
        backfill(spark, root, [SPEC], lambda name: source("2024-01-14"), "2024-01-13", "2024-01-13")
        assert rows(raw(spark, root).groupBy("ds").count()) == [(dt.date(2024, 1, 14), n)]
        run_day(spark, root, [SPEC], lambda name: source("2024-01-14"), "2024-01-14")
        run_day(spark, root, [SPEC], lambda name: source("2024-01-14"), "2024-01-15")
        assert raw(spark, root).where("ds > '2024-01-14'").count() == 0 and raw(spark, root).count() == n


def test_backfill_keeps_other_days(spark, events, tmp_path):
    root = str(tmp_path)
    for day in (DAYS[0], DAYS[1], DAYS[4]):
        run_day(spark, root, [SPEC], lambda name: events, day)
    before = rows(raw(spark, root).where(F.col("ds") < DAYS[1]))
    backfill(spark, root, [SPEC], lambda name: events, DAYS[1], DAYS[3])
    assert rows(raw(spark, root).where(F.col("ds") < DAYS[1])) == before
    assert rows(raw(spark, root)) == rows(first_seen(events, SPEC))
    # Days that turn out empty are replaced too.
    backfill(spark, root, [SPEC], lambda name: events.where("ts < '2024-01-02'"), DAYS[1], DAYS[2])
    assert {str(r["ds"]) for r in raw(spark, root).select("ds").distinct().collect()}.isdisjoint(DAYS[1:3])


def test_catalog_tables_show_what_the_runs_leave(spark, events, tmp_path):
    events.write.parquet(str(tmp_path / "sources/set/events"))
    root = str(tmp_path / "target")
    for day in DAYS[:3]:
        run_day(spark, root, [SPEC], lambda name: events, day, table="days_table")
        publish(spark, root, table="now_table")
    assert rows(spark.table("days_table").select("company_guid", "column_name", "column_value", "ds")) == rows(raw(spark, root))
    assert rows(spark.table("now_table")) == rows(storage.read_lookup(spark, root))
    assert len(storage.versions(spark, f"{root}/{storage.PUBLISHED}")) == 2
    spark.sql("DROP TABLE days_table")
    spark.sql("DROP TABLE now_table")


def test_a_version_belongs_to_one_writer(spark, tmp_path):
    path = str(tmp_path / "table")
    assert storage._claim(spark, f"{path}/_claims/1") and not storage._claim(spark, f"{path}/_claims/1")
    assert storage.write_version(storage.empty(spark, TRIPLE), path) == 2


def test_consumers_filters_reach_the_published_files(spark, events, tmp_path):
    storage.publish_lookup(first_seen(events, SPEC).drop("ds"), str(tmp_path))
    found = lookup_values(storage.read_lookup(spark, str(tmp_path)), "1", "events.props")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "In(company_guid, [1,universal])" in plan and "EqualTo(column_name,events.props)" in plan


def test_inclusive_rerun_empties_the_day(spark, events, tmp_path):
    root = str(tmp_path)
    counts = []
    for _ in range(2):
        run_day(spark, root, [SPEC], lambda name: events, DAYS[0], inclusive=True)
        counts.append(raw(spark, root).count())
    assert counts[0] > 0 and counts[1] == 0


def test_an_empty_result_replaces_a_filled_day(spark, events, tmp_path):
    root = str(tmp_path)
    run_day(spark, root, [SPEC], lambda name: events, DAYS[0])
    assert raw(spark, root).count() > 0
    run_day(spark, root, [SPEC], lambda name: events.where("false"), DAYS[0])
    assert raw(spark, root).count() == 0


def test_stages_keep_the_sources_apart(spark, events, tmp_path):
    root, other = str(tmp_path), SourceSpec("others", ("event_type",), company=None)
    run_day(spark, root, [SPEC, other], lambda name: events, DAYS[0])
    names = {r[1] for r in rows(storage.read_triples(spark, root, "others", DAYS[0]))}
    assert names == {"others.event_type"}
    assert storage.read_triples(spark, root, "events", "2030-01-01").count() == 0


def test_publish_versions(spark, events, tmp_path):
    root = str(tmp_path)
    assert storage.read_lookup(spark, root).count() == 0
    for day in DAYS:
        run_day(spark, root, [SPEC], lambda name: events, day)
    assert publish(spark, root) == 1
    full = rows(storage.read_lookup(spark, root))
    storage.point_lookup_table(spark, "lookup_now", root)
    assert rows(spark.table("lookup_now")) == full
    assert full == rows(first_seen(events, SPEC).drop("ds"))
    assert publish(spark, root, as_of=DAYS[1]) == 2
    assert rows(storage.read_lookup(spark, root)) == rows(lookup_asof(raw(spark, root), DAYS[1]))
    storage.point_lookup_table(spark, "lookup_now", root)
    assert spark.table("lookup_now").count() == storage.read_lookup(spark, root).count() < len(full)
    spark.sql("DROP TABLE lookup_now")
    path = f"{root}/{storage.PUBLISHED}"
    storage.empty(spark, TRIPLE).write.parquet(f"{path}/version=3")
    (tmp_path / storage.PUBLISHED / "version=3" / "_SUCCESS").unlink()
    assert storage.versions(spark, path) == [1, 2]
    assert storage.write_version(storage.empty(spark, TRIPLE), path) == 3
    storage.drop_versions(spark, path, keep=1)
    assert storage.versions(spark, path) == [3]


def test_published_files_split_a_large_company(spark):
    lookup = spark.range(40_000).select(
        F.when(F.col("id") % 3 > 0, "big").otherwise(F.col("id").cast("string")).alias("company_guid"),
        F.lit("t.c").alias("column_name"),
        F.col("id").cast("string").alias("column_value"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = storage.clustered(lookup).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 40_000 / 8 * 2


def test_history_and_consumer(spark):
    days = spark.createDataFrame(
        [("a", "t.c", "1", dt.date(2024, 1, 1)), ("universal", "t.c", "2", dt.date(2024, 1, 2)),
         ("b", "t.c", "3", dt.date(2024, 1, 3)), ("a", "t.d", "4", dt.date(2024, 1, 1))],
        DAY_TRIPLE,
    )
    assert history_until(days, "2024-01-02").count() == 2
    assert history_until(days, "2024-01-02", inclusive=True).count() == 3
    assert rows(lookup_values(days.drop("ds"), "a", "t.c")) == [("1",), ("2",)]


def test_whole_run_from_settings(spark, events, tmp_path):
    fleet = tmp_path / "sources" / "fleet"
    zones = spark.createDataFrame([("a", "z1", "Depot", None)],
                                  "CompanyGuid string, ZoneId string, ZoneName string, ZoneTypes string")
    rules = spark.createDataFrame([("a", "r1", "Speeding", dt.datetime(2024, 1, 1, 12))],
                                  "CompanyGuid string, RuleId string, RuleName string, StreamDateTime timestamp")
    zones.write.parquet(str(fleet / "Zones"))
    rules.write.parquet(str(fleet / "Rule"))
    settings = Settings(str(tmp_path / "out"), {"Zones": "fleet", "Rule": "fleet"}, str(tmp_path / "sources"))
    assert daily_run(spark, settings, "2024-01-01") == 1
    assert daily_run(spark, settings, "2024-01-02") == 2
    found = rows(storage.read_lookup(spark, settings.target_root))
    assert found == [("a", "Rule.RuleId", "r1"), ("a", "Rule.RuleName", "Speeding"),
                     ("a", "Zones.ZoneId", "z1"), ("a", "Zones.ZoneName", "Depot")]


def test_catalog_table_over_the_days(spark, events, tmp_path):
    root = str(tmp_path)
    storage.create_triple_table(spark, "raw_days", f"{root}/{storage.RAW}")
    storage.create_triple_table(spark, "raw_days", f"{root}/{storage.RAW}")
    run_day(spark, root, [SPEC], lambda name: events, DAYS[0])
    storage.add_day(spark, "raw_days", DAYS[0])
    assert spark.table("raw_days").where(f"ds = date'{DAYS[0]}'").count() == raw(spark, root).count() > 0
    comments = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE raw_days").collect()}
    assert "Company" in comments["company_guid"]
    spark.sql("DROP TABLE raw_days")


def test_all_sources_run_from_settings(spark, tmp_path):
    """Every source once: each value column gives its triples, the day filter holds, universal ones have no company."""
    from shelfmark.sources.registry import FLEET_SPECS, UNIVERSAL

    day, expected = dt.date(2024, 1, 2), set()
    for spec in FLEET_SPECS.values():
        columns = [*spec.values, *([spec.company] if spec.company else []), *([spec.day_column] if spec.day_column else [])]
        data = []
        for shift, company in ((0, "c1"), (0, None), (1, "c2")):
            row = {c: f"{c}Id" for c in spec.values}
            row[spec.values[-1]] = f"{spec.values[-1]} of {company}"
            row[spec.company] = company
            row[spec.day_column] = day + dt.timedelta(days=shift)
            data.append(tuple(row[c] for c in columns))
            if spec.day_column is None or shift == 0:
                for c in spec.values:
                    if c not in spec.keep or row[c].endswith("Id"):
                        expected.add((company if spec.company else UNIVERSAL, f"{spec.name}.{c}", row[c]))
        kinds = ", ".join(f"`{c}` {'date' if c == spec.day_column else 'string'}" for c in columns)
        spark.createDataFrame(data, kinds).write.parquet(str(tmp_path / "sources" / "fleet" / spec.name))
    settings = Settings(str(tmp_path / "target"), dict.fromkeys(FLEET_SPECS, "fleet"), str(tmp_path / "sources"))
    assert len(FLEET_SPECS) == 18 and daily_run(spark, settings, day, database="fleet_db") == 1
    found = {tuple(r) for r in storage.read_lookup(spark, settings.target_root).collect()}
    assert found == expected
    assert {tuple(r) for r in spark.table("fleet_db.lookup").collect()} == expected
    assert spark.table("fleet_db.lookup_raw").where("ds = date'2024-01-02'").count() == len(expected)
    spark.sql("DROP DATABASE fleet_db CASCADE")


def files_of(spark, root):
    found = storage.read_lookup(spark, root).select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("t"))
    return {tuple(r) for r in found.distinct().collect()}


def test_a_day_rewrites_the_ranges_it_touches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_ROWS", 1500)
    root = str(tmp_path)

    def write(day, start, end, company="c"):
        some = spark.range(start, end).selectExpr(
            f"'{company}' || lpad(id, 6, '0') AS company_guid", "'t.c' AS column_name", "CAST(id AS STRING) AS column_value")
        storage.write_day(some, root, storage.RAW, day)

    write("2024-01-01", 0, 10_000)
    assert publish(spark, root) == 1
    before = files_of(spark, root)
    assert len(before) > 4
    # A few triples more, below all and among one range.
    storage.write_day(spark.createDataFrame([(None, "t.c", "1"), ("c005000", "t.c", "new"), ("c005000", "t.c", "new")], TRIPLE),
                      root, storage.RAW, "2024-01-02")
    assert publish(spark, root) == 2
    after = files_of(spark, root)
    assert len(before - after) == 2 and len(after) == len(before)
    found = storage.read_lookup(spark, root)
    assert found.count() == 10_002 and found.where("company_guid IS NULL").count() == 1
    # Nothing new, nothing written.
    assert publish(spark, root) == 3 and files_of(spark, root) == after
    # Many triples in one place: their range is cut.
    write("2024-01-03", 0, 9_000, "c0050001x")
    publish(spark, root)
    held, _ = storage.published_ranges(spark, root)
    assert max(r.n for r in held) < 4 * 1500 and sum(r.n for r in held) == 19_002
    assert len(after & files_of(spark, root)) == len(after) - 1
    starts = [r.order() for r in held]
    assert starts == sorted(starts)
    assert rows(storage.read_lookup(spark, root)) == rows(raw(spark, root).drop("ds").distinct())
    # A day that changed makes the whole anew; versions that are gone leave no folder.
    write("2024-01-03", 0, 10)
    publish(spark, root, keep=1)
    assert rows(storage.read_lookup(spark, root)) == rows(raw(spark, root).drop("ds").distinct())
    folders = {f"range={r.name}" for r in storage.published_ranges(spark, root)[0]}
    assert {p.name for p in (tmp_path / "lookup" / "ranges").iterdir() if p.name.startswith("range=")} == folders


def test_publishing_shuffles_once(spark):
    days = spark.range(100).selectExpr("CAST(id AS STRING) AS company_guid", "'t' || id AS column_name", "'v' || id AS column_value")
    plan = days.repartitionByRange(*days.columns).distinct().sortWithinPartitions(*days.columns)
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_triples_find_their_range(spark):
    import random

    draw = random.Random(3)
    data = [(draw.choice([None, "", "a", "b", "é"]), draw.choice("xy"), str(draw.randrange(30))) for _ in range(400)]
    df = spark.createDataFrame(data, TRIPLE)
    for n in (1, 2, 3, 8, 33):
        held = sorted((ranges.Range(str(i), start, 1) for i, start in enumerate(set(draw.sample(data, n)))), key=ranges.Range.order)
        for r in df.withColumn("at", ranges.range_of(held)).collect():
            mine = ranges.Range("", tuple(r)[:3], 0).order()
            assert r["at"] == max(0, sum(h.order() <= mine for h in held) - 1)


def test_commits_have_one_writer_each(spark, tmp_path):
    path = str(tmp_path / "commits")
    assert commits.latest(spark, path) == (0, None)
    assert commits.commit(spark, path, 1, ["ä"]) and not commits.commit(spark, path, 1, ["b"])
    assert commits.commit(spark, path, 2, {}) and commits.read(spark, path, 1) == ["ä"]
    assert commits.latest(spark, path) == (2, {}) and commits.numbers(spark, path) == [1, 2]


def test_files_count_once_whatever_their_days(spark, events, tmp_path):
    source, root = str(tmp_path / "sources"), str(tmp_path / "target")

    def deliver(condition):
        events.where(condition).coalesce(1).write.mode("append").parquet(f"{source}/events")

    def run(day):
        run_new_files(spark, root, [SPEC], source, day)

    deliver("ts < '2024-01-03'")
    run("2024-01-02")
    first = rows(raw(spark, root))
    assert first and {str(r[3]) for r in first} == {"2024-01-02"}
    # A late file of old days, and one that is not finished: the run dies, the next one takes it.
    deliver("ts >= '2024-01-03'")
    files = ledger.NewFiles(spark, f"{source}/events", f"{root}/ledger/events")
    assert files.files.count() == 1
    run("2024-01-05")
    assert {r[:3] for r in rows(raw(spark, root))} == set(rows(first_seen(events, SPEC).drop("ds")))
    assert [r for r in rows(raw(spark, root)) if str(r[3]) == "2024-01-02"] == first
    run("2024-01-06")
    assert raw(spark, root).where("ds = '2024-01-06'").count() == 0
    assert ledger.known_files(spark, f"{root}/ledger/events").count() == 2
    assert ledger.files_of(spark, str(tmp_path / "none")).count() == 0

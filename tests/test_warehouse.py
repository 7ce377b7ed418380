from datetime import date

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from footfall.operators import quality as dq
from footfall.operators import rulesets, warehouse
from footfall.plans.load import add_missing, load_all, load_metric
from footfall.sources.jdbc import jdbc_mode, jdbc_options
from footfall.sources.metric_store import APPEND, REPLACE_ALL, read_days, table_path, write_days

BOUNCE = "dt date, landing_page_type string, total_sessions long, bounce_sessions long, bounce_rate double"
D1, D2 = date(2026, 5, 22), date(2026, 5, 23)


def bounce(spark, *rows):
    return spark.createDataFrame(list(rows), BOUNCE)


def outcomes(df, rules):
    return {r.rule: (r.outcome, r.failing_rows) for r in dq.evaluate(df, rules, "t").collect()}


def test_rules_count_offending_rows(spark):
    df = bounce(
        spark,
        (D1, "home", 1000, 248, 0.248),
        (D1, "cart", -1, 0, 1.5),
        (D1, None, 0, 0, 1.0),
        (None, "home", 5, -1, None),
    )
    got = outcomes(df, rulesets.FULL_RULES["bounce_rate"])
    assert got['IsComplete "dt"'] == ("Failed", 1)
    assert got['ColumnValues "total_sessions" > 0'] == ("Failed", 2)
    assert got['ColumnValues "bounce_rate" between 0 and 1'] == ("Failed", 1), "bounds belong"
    assert got['ColumnDataType "bounce_rate" = "DOUBLE"'] == ("Passed", 0)
    assert got['ColumnValues "bounce_sessions" >= 0'] == ("Failed", 1)


def test_column_type_of_strings_is_tested_by_value(spark):
    df = spark.createDataFrame([("2026-05-22", "1"), ("junk", "x"), (None, None)], "d string, n string")
    got = outcomes(df, [dq.has_type("d", "DATE"), dq.has_type("n", "INTEGER")])
    assert set(got.values()) == {("Failed", 1)}
    assert outcomes(spark.range(3), [dq.has_type("id", "DATE")])['ColumnDataType "id" = "DATE"'] == (
        "Failed", 3,
    )


def test_primary_key_is_unique_and_complete(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3)], "a int, b int")
    name, rule = 'IsPrimaryKey "a" "b"', dq.is_primary_key("a", "b")
    assert outcomes(df, [rule])[name] == ("Failed", 3)
    assert outcomes(df.filter("b = 2"), [rule])[name] == ("Passed", 0)


def test_empty_table_passes(spark):
    got = outcomes(bounce(spark), rulesets.CONSTRAINTS["bounce_rate"])
    assert {o for o, _ in got.values()} == {"Passed"}


def test_gate_raises_and_publishes(spark, tmp_path):
    rules, results = rulesets.LOAD_RULES["bounce_rate"], str(tmp_path / "dq")
    good = bounce(spark, (D1, "home", 10, 2, 0.2))
    assert dq.gate(good, rules, "dq_bounce_rate", results) is good
    with pytest.raises(dq.QualityError, match="total_sessions"):
        dq.gate(bounce(spark, (D1, "home", 0, 0, 0.0)), rules, "dq_bounce_rate", results)
    published = spark.read.json(results)
    assert published.count() == 2 * len(rules)
    assert published.filter("outcome = 'Failed'").count() == 1
    assert {"context", "rule", "outcome", "failing_rows", "evaluated_at"} == set(published.columns)


def test_passing_and_failing_rows_split_the_table(spark):
    df = bounce(spark, (D1, "home", 10, 2, 0.2), (D1, "cart", 0, 0, 2.0), (D1, None, 1, 0, 0.0))
    rules = rulesets.LOAD_RULES["bounce_rate"]
    assert [r.landing_page_type for r in dq.passing_rows(df, rules).collect()] == ["home"]
    broken = {r["landing_page_type"]: r["broken_rules"] for r in as_dicts(dq.failing_rows(df, rules))}
    assert len(broken["cart"]) == 2 and broken[None] == ['IsComplete "landing_page_type"']


def test_every_fact_has_rules_and_schemas():
    for table in (rulesets.LOAD_RULES, rulesets.FULL_RULES, rulesets.CONSTRAINTS,
                  warehouse.FACT_SCHEMAS, warehouse.NUMERIC_SCHEMAS,
                  warehouse.BUSINESS_KEYS):
        assert set(table) == set(warehouse.FACT_TABLES)
    assert warehouse.FACT_TABLES["funnel"] == "fact_conversion_funnel"


def test_change_schema_selects_renames_and_casts(spark):
    df = spark.createDataFrame([("2026-05-22", 3, "x")], "day string, n long, extra string")
    out = warehouse.change_schema(df, "dt date, n smallint", {"dt": "day"})
    assert out.dtypes == [("dt", "date"), ("n", "smallint")]
    assert out.first().dt == D1


def test_dim_date(spark):
    rows = {r["dt"]: r for r in as_dicts(warehouse.dim_date(spark, date(2026, 1, 1), date(2026, 12, 31)))}
    assert len(rows) == 365
    friday = rows[D1]
    assert (friday["day_of_week"], friday["is_weekend"], friday["week_of_year"]) == (4, False, 21)
    assert rows[D2]["is_weekend"] and rows[date(2026, 1, 1)]["week_of_year"] == 1
    assert rows[date(2026, 12, 31)]["week_of_year"] == 53
    for day, row in rows.items():
        assert row["day_of_week"] == day.weekday() and row["week_of_year"] == day.isocalendar()[1]


def test_dimensions_only_gain_missing_rows(spark, tmp_path):
    path = str(tmp_path / "dim_device")
    add_missing(warehouse.dim_device(spark), path, ["device_type"])
    more = spark.createDataFrame([("mobile",), ("watch",), ("watch",)], "device_type string")
    add_missing(more, path, ["device_type"])
    assert sorted(r.device_type for r in spark.read.parquet(path).collect()) == [
        "desktop", "mobile", "tablet", "watch",
    ]
    assert warehouse.dim_country(spark).count() == 10


def test_facts_need_their_day_in_the_calendar(spark):
    dates = warehouse.dim_date(spark, D1, D1)
    known = bounce(spark, (D1, "home", 1, 0, 0.0))
    assert dq.require_references(known, dates, "dt") is known
    stray = bounce(spark, (D2, "home", 1, 0, 0.0), (D2, "cart", 1, 0, 0.0))
    assert [(r.dt, r.fact_rows) for r in dq.missing_references(stray, dates, "dt").collect()] == [(D2, 2)]
    with pytest.raises(dq.QualityError):
        dq.require_references(stray, dates, "dt")


@pytest.fixture
def store(spark, tmp_path):
    base = str(tmp_path / "metrics")
    write_days(
        bounce(spark, (D1, "home", 10, 2, 0.2), (D1, "cart", 4, 1, 0.25), (D2, "home", 3, 0, 0.0)),
        table_path(base, "bounce_rate"),
    )
    return base


def loaded(spark, facts):
    df = read_days(spark, table_path(facts, "fact_bounce_rate"))
    return sorted((r.dt, r.landing_page_type, r.total_sessions) for r in df.collect())


def test_loading_a_day_again_replaces_only_that_day(spark, store, tmp_path):
    facts = str(tmp_path / "facts")
    assert load_metric(spark, "bounce_rate", store, facts)
    write_days(bounce(spark, (D1, "home", 11, 2, 0.2)), table_path(store, "bounce_rate"))
    assert load_metric(spark, "bounce_rate", store, facts, run_date="2026-05-22")
    assert loaded(spark, facts) == [(D1, "home", 11), (D2, "home", 3)]
    assert load_metric(spark, "bounce_rate", store, facts, run_date="2026-05-22")
    assert len(loaded(spark, facts)) == 2, "idempotent"


def test_load_modes(spark, store, tmp_path):
    facts = str(tmp_path / "facts")
    load_metric(spark, "bounce_rate", store, facts)
    load_metric(spark, "bounce_rate", store, facts, mode=APPEND)
    assert len(loaded(spark, facts)) == 6
    load_metric(spark, "bounce_rate", store, facts, run_date="2026-05-23", mode=REPLACE_ALL)
    assert loaded(spark, facts) == [(D2, "home", 3)]


def test_loaded_rows_are_typed_stamped_and_identified(spark, store, tmp_path):
    facts = str(tmp_path / "facts")
    load_metric(spark, "bounce_rate", store, facts, exact=True)
    df = read_days(spark, table_path(facts, "fact_bounce_rate"))
    types = dict(df.dtypes)
    assert types["bounce_rate"] == "decimal(6,4)" and types["total_sessions"] == "int"
    assert types["loaded_at"] == "timestamp"
    assert df.select("id").distinct().count() == 3


def test_missing_day_is_skipped_and_bad_rows_stop_the_run(spark, store, tmp_path):
    facts = str(tmp_path / "facts")
    assert not load_metric(spark, "bounce_rate", store, facts, run_date="2026-01-01")
    write_days(bounce(spark, (D2, "home", 0, 0, 0.0)), table_path(store, "bounce_rate"))
    with pytest.raises(dq.QualityError):
        load_all(spark, store, facts, only="bounce_rate")
    assert not (tmp_path / "facts").exists()


def test_one_day_scan_prunes_the_other_folders(spark, store):
    plan = read_days(spark, table_path(store, "bounce_rate"), "2026-05-22")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in text
    assert plan.count() == 2


def test_jdbc_options_leave_out_what_is_not_given():
    assert jdbc_options("jdbc:x:y", "fact_top_pages", user="u") == {
        "url": "jdbc:x:y", "dbtable": "fact_top_pages", "user": "u", "batchsize": "1000",
    }


def test_jdbc_load_modes():
    assert jdbc_mode("replace_all") == "overwrite" and jdbc_mode("append") == "append"
    with pytest.raises(ValueError, match="replaced by day"):
        jdbc_mode("replace_days")


def test_of_conflicting_new_rows_always_the_same_is_inserted(spark):
    rows = [("a", 3, "x"), ("a", 2, "z"), ("a", 2, "y"), ("b", 1, None), ("c", 9, "w"), ("c", 8, "w")]
    held = spark.createDataFrame([("c", 1, "old")], "k string, n int, t string")
    for parts in (1, 5):
        new = spark.createDataFrame(rows, "k string, n int, t string").repartition(parts)
        got = sorted(map(tuple, warehouse.absent_rows(new, held, ["k"]).collect()))
        assert got == [("a", 2, "y"), ("b", 1, None)]


def test_serial_ids_have_no_gaps(spark):
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("n"), F.lit("c").alias("id"))
    rows = warehouse.with_serial_ids(df, ["n"], last=40).collect()
    assert sorted((r.n, r.serial_id) for r in rows) == [(n, n + 41) for n in range(500)]
    assert warehouse.with_serial_ids(df.limit(0), ["n"]).count() == 0


def test_rule_sets_fall_back_to_the_rules_of_every_load():
    assert rulesets.rules_for("top_pages") is rulesets.LOAD_RULES["top_pages"]
    assert rulesets.rules_for("top_pages", "typed") is rulesets.TYPED_RULES["top_pages"]
    assert rulesets.rules_for("funnel", "typed") is rulesets.LOAD_RULES["funnel"]


def test_load_with_stricter_rules_writes_nothing_it_rejects(spark, tmp_path):
    metrics, facts = str(tmp_path / "m"), str(tmp_path / "f")
    rows = bounce(spark, (D1, "home", 10, -1, 0.5))
    write_days(rows, table_path(metrics, "bounce_rate"))
    with pytest.raises(dq.QualityError, match="bounce_sessions"):
        load_all(spark, metrics, facts, only="bounce_rate", rule_set="full")
    assert not (tmp_path / "f").exists()
    assert load_all(spark, metrics, facts, only="bounce_rate", rule_set="typed") == {"bounce_rate": True}


def test_jdbc_partitions_are_an_option():
    assert "numPartitions" not in jdbc_options("jdbc:x", "t")
    assert jdbc_options("jdbc:x", "t", partitions=8)["numPartitions"] == "8"

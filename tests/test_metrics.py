import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from footfall.functions.groups import first_rows
from footfall.operators.metrics import METRICS
from footfall.operators.metrics import anomalies as an
from footfall.operators.metrics import day_sketches
from footfall.operators.metrics.bounce_rate import bounce_rate
from footfall.operators.metrics.device_country import device_country
from footfall.operators.metrics.funnel import funnel
from footfall.operators.metrics.nav_paths import nav_paths, session_paths
from footfall.operators.metrics.product_gap import product_gap
from footfall.operators.metrics.top_pages import top_pages


def test_top_pages_ranks_by_average_with_missing_last(events):
    df = events(
        {"page_url": "a", "page_type": "home", "time_on_page_seconds": 10.0},
        {"page_url": "a", "page_type": "home", "time_on_page_seconds": 30.0},
        {"page_url": "b", "page_type": "home", "time_on_page_seconds": 25.0},
        {"page_url": "c", "page_type": "home"},
        {"event_type": "click", "page_url": "z"},
    )
    rows = {r["page_url"]: r for r in as_dicts(top_pages(df))}
    assert set(rows) == {"a", "b", "c"}
    assert (rows["a"]["views"], rows["a"]["avg_time_on_page"]) == (2, 20.0)
    assert rows["a"]["p95_time_on_page"] == 30.0
    assert {r["page_url"] for r in as_dicts(top_pages(df, top_n=2))} == {"a", "b"}


def test_session_over_midnight_counts_on_its_landing_day(events):
    df = events(
        {"session_id": "S1", "at": "2026-05-22 23:59:00", "page_type": "home"},
        {"session_id": "S1", "at": "2026-05-23 00:01:00", "page_type": "cart"},
        {"session_id": "S2", "at": "2026-05-23 10:00:00", "page_type": "home"},
        {"session_id": "S2", "event_type": "click", "at": "2026-05-23 09:00:00"},
    )
    rows = {str(r["dt"]): r for r in as_dicts(bounce_rate(df))}
    assert rows["2026-05-22"]["bounce_sessions"] == 0
    assert rows["2026-05-23"]["total_sessions"] == rows["2026-05-23"]["bounce_sessions"] == 1
    assert rows["2026-05-23"]["bounce_rate"] == 1.0


def test_landing_tie_goes_to_the_smaller_event_id(events):
    df = events({"event_id": "B", "page_type": "cart"}, {"event_id": "A", "page_type": "home"})
    assert as_dicts(bounce_rate(df))[0]["landing_page_type"] == "home"


def test_funnel_stages_are_independent(events):
    df = events(
        {"session_id": "S1"},
        {"session_id": "S2", "page_type": "checkout"},
        {"session_id": "S3", "event_type": "product_view"},
        {"session_id": "S4", "event_type": "cart_event", "action": "remove"},
        {"session_id": "S5", "event_type": "cart_event", "action": "add"},
        {"session_id": "S6", "event_type": "cart_event", "action": "add"},
    )
    rows = {r["stage"]: r for r in as_dicts(funnel(df))}
    assert {s: r["sessions"] for s, r in rows.items()} == {
        "page_view": 2, "product_view": 1, "cart_event": 2, "purchase": 1,
    }
    assert rows["page_view"]["conversion_rate_from_previous"] == 1.0
    assert rows["cart_event"]["conversion_rate_from_previous"] == 2.0
    assert rows["purchase"]["conversion_rate_overall"] == 0.5


def test_funnel_of_a_day_without_page_views_divides_nothing(events):
    rows = {r["stage"]: r for r in as_dicts(funnel(events({"event_type": "click"})))}
    assert rows["page_view"]["conversion_rate_overall"] is None
    assert rows["page_view"]["conversion_rate_from_previous"] == 1.0
    assert rows["product_view"]["conversion_rate_from_previous"] is None


def product_rows(n, product="P1", category="toys", **more):
    row = {"event_type": "product_view", "product_id": product, "category": category, **more}
    return [dict(row) for _ in range(n)]


def adds(n, product="P1", action="add"):
    row = {"event_type": "cart_event", "product_id": product, "action": action}
    return [dict(row) for _ in range(n)]


def test_product_gap(events):
    df = events(
        *product_rows(4), *product_rows(2, category="food"), *adds(3), *adds(5, action="remove"),
        *product_rows(3, product="P2"), *adds(2, product="P3"), *product_rows(1, product="P4"),
    )
    rows = {(r["product_id"], r["category"]): r for r in as_dicts(product_gap(df, min_views=2))}
    assert set(rows) == {("P1", "toys"), ("P1", "food"), ("P2", "toys")}
    assert rows["P1", "toys"]["gap_score"] == 0.25
    assert rows["P1", "food"]["gap_score"] == -0.5, "adds can exceed views"
    assert rows["P2", "toys"]["cart_adds"] == 0
    top = as_dicts(product_gap(df, min_views=2, top_n=1))
    assert [r["product_id"] for r in top] == ["P2"]


def test_paths_are_cut_and_null_steps_counted(events):
    steps = [{"page_type": f"p{i}", "at": f"10:00:{i:02d}"} for i in range(12)]
    df = events(
        *steps,
        {"session_id": "S2", "page_type": "home"},
        {"session_id": "S2", "page_type": None, "at": "10:00:01"},
    )
    rows = {r["session_id"]: r for r in as_dicts(session_paths(df))}
    assert rows["S1"]["path"] == "->".join(f"p{i}" for i in range(10))
    assert rows["S1"]["path_length"] == 10
    assert (rows["S2"]["path"], rows["S2"]["path_length"]) == ("home", 2)


def test_equal_times_in_a_path_are_ordered_by_page_type(events):
    df = events({"page_type": "home"}, {"page_type": "cart"})
    assert as_dicts(session_paths(df))[0]["path"] == "cart->home"


def test_top_paths(events):
    df = events(
        {"session_id": "S1", "page_type": "home"},
        {"session_id": "S2", "page_type": "home"},
        {"session_id": "S3", "page_type": "cart"},
        {"session_id": "S4", "page_type": "other"},
    )
    rows = as_dicts(nav_paths(df, top_n=2))
    assert {(r["path"], r["sessions"]) for r in rows} == {("home", 2), ("cart", 1)}


def test_long_session_reaches_the_shuffle_as_its_first_steps(events):
    df = events(*[{"page_type": "home", "at": f"10:{i // 60:02d}:{i % 60:02d}"} for i in range(90)])
    plan = session_paths(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_device_country(events):
    df = events(
        {"device_type": "mobile", "country": "MX", "time_on_page_seconds": 46.51},
        {"device_type": "mobile", "country": "MX", "time_on_page_seconds": 46.52},
        {"session_id": "S2", "device_type": "mobile", "country": "MX"},
        {"session_id": "S2", "device_type": "mobile", "country": "CO"},
        {"event_type": "click", "device_type": "mobile", "country": "MX"},
    )
    rows = {r["country"]: r for r in as_dicts(device_country(df))}
    assert rows["MX"]["page_views"] == 3 and rows["MX"]["unique_sessions"] == 2
    assert rows["MX"]["avg_time_on_page"] == 46.52, "a tie rounds up"
    assert rows["CO"]["avg_time_on_page"] is None and rows["CO"]["p95_time_on_page"] is None


def test_rows_without_a_day_keep_their_segment(events):
    df = events({"at": None, "device_type": "mobile", "country": "MX"})
    assert as_dicts(device_country(df))[0]["page_views"] == 1


def test_session_features(events):
    df = events(
        {"at": "10:00:00", "page_url": "a"},
        {"at": "10:01:00", "page_url": "a"},
        {"at": "10:02:00", "event_type": "click", "page_url": "b"},
        {"session_id": "S2"},
    )
    rows = {r["session_id"]: r for r in as_dicts(an.session_features(df))}
    one = rows["S1"]
    assert (one["total_events"], one["unique_pages"]) == (3, 1)
    assert (one["session_duration_seconds"], one["events_per_minute"]) == (120.0, 1.5)
    assert rows["S2"]["events_per_minute"] == 0.0


FEATURE_ROW = """dt date, session_id string, user_id string, total_events long, unique_pages long,
    session_duration_seconds double, events_per_minute double"""


def features(spark, *totals):
    rows = [(f"S{i}", "U", t, 1, 60.0, 1.0) for i, t in enumerate(totals)]
    df = spark.createDataFrame(rows, FEATURE_ROW.replace("dt date,", ""))
    return df.withColumn("dt", F.lit("2026-05-22").cast("date"))


def test_single_session_day_has_zero_scores(spark):
    row = as_dicts(an.zscore_flags(features(spark, 5)))[0]
    assert row["z_total_events"] == 0.0 and row["flag_z_total_events"] == 0


def test_score_is_rounded_before_the_test(spark):
    # mean 0, deviation 1 by construction: 3.0004 rounds to 3.0, 3.0006 to 3.001
    moments = features(spark, 0).groupBy("dt").agg(
        *[F.lit(0.0).alias(f"mean_{f}") for f in an.FEATURES],
        *[F.lit(1.0).alias(f"std_{f}") for f in an.FEATURES],
    )
    df = features(spark, 0, 0).withColumn(
        "events_per_minute", F.when(F.col("session_id") == "S0", 3.0004).otherwise(3.0006)
    )
    rows = {r["session_id"]: r for r in as_dicts(an.zscore_flags(df, moments))}
    assert rows["S0"]["flag_z_events_per_minute"] == 0
    assert rows["S1"]["flag_z_events_per_minute"] == 1


def test_constant_feature_flags_only_values_off_it(spark):
    rows = as_dicts(an.iqr_flags(features(spark, *[5] * 9, 6)))
    assert sum(r["flag_iqr_total_events"] for r in rows) == 1
    assert sum(r["flag_iqr_unique_pages"] for r in rows) == 0


def test_anomalies_need_two_flags_and_name_the_first(events):
    quiet = [{"session_id": f"S{i}", "user_id": f"U{i}", "page_url": "a"} for i in range(40)]
    busy = [
        {"session_id": "X", "user_id": "UX", "page_url": f"p{i}", "at": f"10:00:{i:02d}"}
        for i in range(30)
    ]
    rows = as_dicts(an.anomalies(events(*quiet, *busy)))
    assert [r["session_id"] for r in rows] == ["X"]
    assert rows[0]["anomaly_type"] == "high_velocity"
    assert rows[0]["total_flags"] == 8


def test_registry_has_the_seven_metrics():
    assert list(METRICS) == [
        "top_pages", "bounce_rate", "funnel", "product_gap", "nav_paths", "device_country",
        "anomalies",
    ]


@pytest.mark.parametrize("n", [3, 40])
def test_first_rows_beyond_the_group_limit(spark, n):
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "10")
    try:
        df = spark.range(500).selectExpr("id % 2 AS g", "id AS v")
        got = first_rows(df, ["g"], [F.desc("v")], n).collect()
    finally:
        spark.conf.set(key, before)
    want = {(v % 2, v) for v in range(500 - 2 * n, 500)}
    assert {(r.g, r.v) for r in got} == want


def test_sketches_of_days_answer_for_ranges(spark):
    rows = spark.range(60_000).select(
        F.lit("page_view").alias("event_type"),
        F.date_add(F.lit("2026-05-01").cast("date"), (F.col("id") % 6).cast("int")).alias("dt"),
        F.lit("/a").alias("page_url"),
        F.when(F.col("id") % 10 == 0, "cart").otherwise("home").alias("page_type"),
        (F.col("id") % 7001).cast("string").alias("session_id"),
        F.when(F.col("id") % 10 > 0, (F.col("id") * 7919 % 60_000).cast("double")).alias(
            "time_on_page_seconds"
        ),
    )
    stored = day_sketches.page_sketches(rows).filter("dt >= '2026-05-03'")
    found = {r.page_type: r for r in day_sketches.pages_over_days(stored).collect()}
    kept = rows.filter("dt >= '2026-05-03' AND page_type = 'home'")
    below = kept.filter(F.col("time_on_page_seconds") <= found["home"].time_quantile).count()
    assert abs(below / kept.count() - 0.95) < 0.004
    assert found["home"].views == kept.count()
    assert found["home"].unique_sessions == kept.select("session_id").distinct().count()
    assert found["cart"].time_quantile is None, "a page without any time"
    assert day_sketches.pages_over_days(stored.limit(0)).count() == 0

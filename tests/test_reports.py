from datetime import date

import pytest
from conftest import as_dicts

from footfall.operators import profile, reports

D1, D2 = date(2026, 5, 22), date(2026, 5, 23)


@pytest.fixture
def segments(spark):
    return spark.createDataFrame(
        [
            (D1, "mobile", "MX", 10, 20.0, 25.0, 8),
            (D1, "desktop", "MX", 30, 40.0, 45.0, 20),
            (D1, "mobile", "UNKNOWN", 10, None, None, 5),
            (D2, "mobile", "MX", 1, 1.0, 1.0, 1),
        ],
        """dt date, device_type string, country string, page_views int, avg_time_on_page double,
        p95_time_on_page double, unique_sessions int""",
    )


@pytest.fixture
def bounces(spark):
    return spark.createDataFrame(
        [(D1, "home", 10, 2, 0.2), (D1, "cart", 30, 3, 0.1), (D2, "home", 1, 1, 1.0)],
        "dt date, landing_page_type string, total_sessions int, bounce_sessions int, bounce_rate double",
    )


def test_summary_of_a_day(segments, bounces):
    (row,) = as_dicts(reports.session_summary(segments, bounces, "2026-05-22"))
    assert (row["total_sessions"], row["total_page_views"], row["segments"]) == (33, 50, 3)
    assert row["avg_time_on_page"] == (20 * 10 + 40 * 30) / 50, "missing averages still weigh"
    assert row["overall_bounce_rate"] == 5 / 40


def test_filters_leave_the_bounce_rate_alone(segments, bounces):
    report = reports.session_summary(segments, bounces, D1, country=" mx ", device="desktop")
    (row,) = as_dicts(report)
    assert (row["total_sessions"], row["avg_time_on_page"]) == (20, 40.0)
    assert row["overall_bounce_rate"] == 5 / 40 and row["country"] == "MX"


def test_no_segment_means_no_data(segments, bounces):
    report = reports.session_summary(segments, bounces, D1, country="AR")
    assert report.collect() == []
    with pytest.raises(reports.NoDataError):
        reports.require_data(report)


def test_summary_plan_has_no_join(segments, bounces):
    plan = reports.session_summary(segments, bounces, D1)._jdf.queryExecution().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_bounce_ranking(spark, bounces):
    rows = as_dicts(reports.top_pages("bounce_rate", None, bounces, "2026-05-22", "1"))
    assert [r["landing_page_type"] for r in rows] == ["home"]


def test_time_ranking_puts_missing_last(spark):
    pages = spark.createDataFrame(
        [(D1, u, "home", 1, t, t) for u, t in [("a", 1.0), ("b", None), ("c", 5.0)]],
        "dt date, page_url string, page_type string, views int, avg_time_on_page double, p95_time_on_page double",
    )
    rows = as_dicts(reports.top_pages("time_on_page", pages, None, D1))
    assert [r["page_url"] for r in rows] == ["c", "a", "b"]


def test_anomalies_are_ranked_by_flags_then_score(spark):
    def row(name, flags, *z):
        return (D1, name, "U", 1, 1.0, 1, 1.0, *z, flags, "high_volume")

    df = spark.createDataFrame(
        [
            row("a", 2, 1.0, None, 0.0, 0.0),
            row("b", 2, 0.0, None, -9.0, 0.0),
            row("c", 4, None, None, None, None),
            row("d", None, 99.0, 0.0, 0.0, 0.0),
        ],
        """dt date, session_id string, user_id string, total_events int,
        session_duration_seconds double, unique_pages int, events_per_minute double,
        z_total_events double, z_session_duration_seconds double, z_unique_pages double,
        z_events_per_minute double, total_flags int, anomaly_type string""",
    )
    rows = as_dicts(reports.ranked_anomalies(df, "2026-05-22"))
    assert [r["session_id"] for r in rows] == ["c", "b", "a", "d"]
    assert rows[1]["z_score"]["unique_pages"] == -9.0


@pytest.mark.parametrize("value", [None, "", "22-05-2026", "2026-13-01", "today"])
def test_bad_dates(value):
    with pytest.raises(reports.ArgumentError):
        reports.check_date(value)


@pytest.mark.parametrize("value", ["0", "101", "ten", -1])
def test_bad_limits(value):
    with pytest.raises(reports.ArgumentError):
        reports.check_limit(value, reports.PAGE_LIMIT)


def test_defaults_and_choices():
    assert reports.check_limit(None, reports.ANOMALY_LIMIT) == 100
    assert reports.check_limit("1000", reports.ANOMALY_LIMIT) == 1000
    assert reports.check_country(" mx ") == "MX" and reports.check_country("") is None
    for bad in ("MEX", "M1", "  "):
        with pytest.raises(reports.ArgumentError):
            reports.check_country(bad)
    with pytest.raises(reports.ArgumentError):
        reports.check_choice("watch", ("mobile",), "device", required=False)
    with pytest.raises(reports.ArgumentError):
        reports.check_choice(None, reports.PAGE_RANKINGS, "metric")


def test_profile(events):
    df = events(
        {"event_id": "A"}, {"event_id": "A", "country": "MX"}, {"event_id": None},
        {"event_type": "click"},
    )
    assert [(r.event_type, r.events) for r in profile.event_type_counts(df).collect()] == [
        ("page_view", 3), ("click", 1),
    ]
    (nulls,) = as_dicts(profile.page_view_nulls(df))
    assert nulls == {"null_country": 2, "null_device": 3, "null_time": 3, "null_event_id": 1}
    assert profile.duplicate_ids(df).first().duplicate_ids == 1

from conftest import as_dicts

from footfall.operators import cleaning


def by_id(df, column):
    return {row["event_id"]: row[column] for row in as_dicts(df)}


def test_earliest_copy_wins_and_null_ids_go(events):
    df = events(
        {"event_id": "A", "at": "10:00:05", "page_url": "late"},
        {"event_id": "A", "at": "10:00:01", "page_url": "early"},
        {"event_id": None},
        {"event_id": "B", "page_url": "only"},
    )
    assert by_id(cleaning.deduplicate(df), "page_url") == {"A": "early", "B": "only"}


def test_copy_without_time_sorts_first(events):
    df = events(
        {"event_id": "A", "at": "10:00:05", "page_url": "timed"},
        {"event_id": "A", "at": None, "page_url": "untimed"},
    )
    assert by_id(cleaning.deduplicate(df), "page_url") == {"A": "untimed"}


def test_one_id_holding_most_rows_collapses_before_the_shuffle(spark, events):
    rows = [{"event_id": "HOT", "at": f"10:00:{i % 60:02d}"} for i in range(300)]
    df = events(*rows, {"event_id": "B"}).repartition(8)
    out = cleaning.count_copies(df)
    assert by_id(out, "copies") == {"HOT": 300, "B": 1}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_copies_add_up_to_raw_rows_with_null_ids(events):
    df = events({"event_id": None}, {"event_id": None}, {"event_id": "A"}, {"event_id": "A"})
    counted = cleaning.count_copies(df)
    assert by_id(counted, "copies") == {None: -2, "A": 2}
    assert [r.event_id for r in cleaning.with_ids(counted).collect()] == ["A"]


def test_country_is_imputed_for_every_event_type(events):
    df = events({"country": None}, {"event_type": "click", "country": None}, {"country": "mx"})
    out = cleaning.normalize_country(cleaning.impute_country(df))
    assert by_id(out, "country") == {"E0": "UNKNOWN", "E1": "UNKNOWN", "E2": "MX"}


def test_normalize_country_keeps_null(events):
    assert by_id(cleaning.normalize_country(events({"country": None})), "country") == {"E0": None}


def test_device_is_the_users_mode_with_ties_by_name(events):
    df = events(
        {"device_type": "tablet"},
        {"device_type": "desktop"},
        {"event_type": "click"},
        {"user_id": "U2", "device_type": "mobile"},
        {"user_id": "U2", "device_type": "mobile"},
        {"user_id": "U2", "device_type": "desktop"},
        {"user_id": "U2", "event_type": "search"},
        {"user_id": "U3", "event_type": "cart_event"},
        {"user_id": None, "event_type": "click"},
        {"user_id": "U4", "event_type": "click", "device_type": "tablet"},
        {"user_id": "U4"},
    )
    out = by_id(cleaning.impute_device(df), "device_type")
    assert out["E2"] == "desktop"
    assert out["E6"] == "mobile"
    assert out["E7"] == out["E8"] == "UNKNOWN"
    assert out["E10"] == "UNKNOWN", "only page views give the mode"
    assert out["E0"] == "tablet", "known devices stay"


def test_time_is_the_lower_median_of_its_page_type(events):
    df = events(
        {"page_type": "home", "time_on_page_seconds": 10.0},
        {"page_type": "home", "time_on_page_seconds": 20.0},
        {"page_type": "home"},
        {"page_type": None},
        {"page_type": "cart"},
        {"event_type": "product_view", "page_type": "home"},
    )
    out = by_id(cleaning.impute_time_on_page(df), "time_on_page_seconds")
    assert out["E2"] == 10.0
    assert out["E3"] is None and out["E4"] is None and out["E5"] is None


def test_url_loses_query_and_case(events):
    df = events(
        {"page_url": "HTTPS://Shop/A?x=1?y=2"}, {"page_url": "plain"}, {"page_url": None}
    )
    out = by_id(cleaning.normalize_url(df), "page_url")
    assert out == {"E0": "https://shop/a", "E1": "plain", "E2": None}


def test_pipeline_on_some_columns_equals_the_whole(events):
    df = events(
        {"page_type": "home", "time_on_page_seconds": 5.0, "device_type": "mobile"},
        {"page_type": "home", "page_url": "X?1"},
        {"event_id": "E1", "at": "09:00:00", "page_type": "home", "page_url": "Y?1"},
    )
    whole = cleaning.clean_events(df)
    assert whole.columns == df.columns
    some = ["event_id", "page_url", "device_type", "time_on_page_seconds"]
    part = cleaning.clean_events(df, some)
    assert sorted(part.collect()) == sorted(whole.select(*some).collect())
    assert by_id(part, "page_url")["E1"] == "y"

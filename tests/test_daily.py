import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_validation import COMMON, VALID

from footfall.operators.cleaning import clean_events, impute_device
from footfall.operators.metrics import METRIC_SCHEMAS, METRICS
from footfall.plans.daily import run, run_daily
from footfall.sources.events import read_event_days, read_events, write_event_days
from footfall.sources.metric_store import read_days, read_metric, table_path
from footfall.sources.staging import scratch_path, shared_folder, stage, staging_scope, workspace


def line(i, day, kind="page_view", **more):
    return {**COMMON, **VALID[kind], "event_type": kind, "event_id": f"E{i:016x}",
            "timestamp": f"{day}T10:{i % 60:02d}:00Z", **more}


@pytest.fixture
def landing(tmp_path):
    base = tmp_path / "events"
    for day in ("22", "23"):
        folder = base / "year=2026" / "month=05" / f"day={day}"
        folder.mkdir(parents=True)
        date = f"2026-05-{day}"
        rows = [line(i, date, kind, session_id=f"S{i:012x}")
                for i, kind in enumerate(list(VALID) * 3, start=100 * int(day))]
        rows.append(rows[0])
        rows.append(line(9999, "2026-05-24", session_id="Slate"))
        text = [json.dumps(r) for r in rows] + ["{broken"]
        (folder / f"events_{date}.jsonl").write_text("\n".join(text))
    return str(base)


def tables(spark, out, day=None):
    return {m: read_metric(spark, out, m, day) for m in METRICS}


def test_one_day(spark, landing, tmp_path):
    out = str(tmp_path / "metrics")
    summary = run(spark, landing, out, "2026-05-22")
    # the misfiled row and the broken line have another day or none
    assert summary["events_raw"] == 16 and summary["events_clean"] == 15
    assert summary["metrics"]["funnel"] == 4
    for name, df in tables(spark, out).items():
        assert df.count() == summary["metrics"][name], name
        assert {str(r.dt) for r in df.select("dt").distinct().collect()} <= {"2026-05-22"}


def test_metric_tables_have_the_declared_columns(spark, landing):
    events = read_event_days(spark, landing)
    for name, metric in METRICS.items():
        got = metric.compute(events)
        want = spark.createDataFrame([], METRIC_SCHEMAS[name])
        assert got.dtypes == want.dtypes, name


def test_running_a_day_again_replaces_only_that_day(spark, landing, tmp_path):
    out = str(tmp_path / "metrics")
    run(spark, landing, out)
    path = table_path(out, "device_country")
    before = sorted(read_days(spark, path).collect())
    run(spark, landing, out, "2026-05-23")
    assert sorted(read_days(spark, path).collect()) == before
    assert {str(r.dt) for r in before} == {"2026-05-22", "2026-05-23", "2026-05-24"}


def test_no_events_write_nothing(spark, landing, tmp_path):
    out = tmp_path / "metrics"
    assert run(spark, landing, str(out), "2025-01-01") == {"events_processed": 0}
    assert not out.exists()


def test_staged_tables_are_dropped(spark, landing, tmp_path):
    def staged():
        found = []
        for db in spark.catalog.listDatabases("footfall_stage*"):
            found += [t.name for t in spark.catalog.listTables(db.name)]
        return set(found)

    before = staged()
    run(spark, landing, str(tmp_path / "metrics"))
    assert staged() == before


def test_selected_metrics_and_options(spark, landing, tmp_path):
    out = str(tmp_path / "metrics")
    summary = run_daily(
        read_event_days(spark, landing), out, metrics=["product_gap"],
        options={"product_gap": {"min_views": 1}},
    )
    assert list(summary["metrics"]) == ["product_gap"] and summary["metrics"]["product_gap"] == 2


def test_day_scan_prunes_folders_and_columns(spark, landing):
    df = read_event_days(spark, landing, "2026-05-22").select("event_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*day", plan)
    assert "element_id" not in plan
    assert df.count() == 16


def test_bad_timestamps_and_lines_become_null(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"event_id": "A", "timestamp": "junk"}\n{broken\n{"event_id": "B", '
                    '"timestamp": "2026-05-22T23:30:00.25+02:00", "extra": 1}\n')  # fmt: skip
    rows = {r.event_id: r for r in read_events(spark, str(path)).collect()}
    assert rows["A"].dt is None and rows["A"].hour is None
    assert str(rows["B"].dt) == "2026-05-22" and rows["B"].hour == 21


def test_landing_layout_is_zero_padded(spark, landing, tmp_path):
    base = tmp_path / "copy"
    raw = read_event_days(spark, landing).filter(F.col("event_id").isNotNull())
    write_event_days(raw, str(base))
    assert (base / "year=2026" / "month=05" / "day=22").is_dir()
    columns = raw.columns
    again = read_event_days(spark, str(base)).select(*columns)
    assert sorted(map(str, again.collect())) == sorted(map(str, raw.collect()))


def test_shared_folder_follows_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert scratch_path(spark, "x").startswith(folder)
    with staging_scope(spark):
        files = stage(spark.range(3), "three").inputFiles()
    assert files and all(folder in f for f in files)


def test_staged_frames_are_files_not_tables(spark):
    """A table of the catalogue costs the driver another query, which it keeps."""
    rows = spark.createDataFrame([(1, None, [2.5], {"a": 1})], "a int, b string, c array<double>, d map<string, int>")
    with staging_scope(spark):
        staged = stage(rows, "rows")
        folder = Path(staged.inputFiles()[0].removeprefix("file:")).parent
        assert staged.schema == rows.schema and staged.collect() == rows.collect()
        assert stage(rows.filter("a > 1"), "none").count() == 0
        assert not spark.catalog.listTables(folder.parent.name)
    assert not folder.exists()


class Session:
    class conf:
        @staticmethod
        def get(key, default=None):
            return {"spark.master": "spark://host:7077", "spark.app.id": "a"}.get(key, default)


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session)


def test_workspace_leaves_nothing(spark, events):
    folder = Path(shared_folder(spark))
    stage(spark.range(1), "kept")
    databases = {d.name for d in spark.catalog.listDatabases()}
    before = set(folder.iterdir())
    with workspace(spark):
        clean_events(events({"device_type": None}, {"device_type": "mobile"})).collect()
        spark.range(3).write.parquet(scratch_path(spark, "made"))
        assert set(folder.iterdir()) > before
    assert {d.name for d in spark.catalog.listDatabases()} == databases
    assert set(folder.iterdir()) == before


def test_one_day_lists_one_folder(spark, tmp_path):
    base = str(tmp_path / "events")
    for day in ("2026-05-21", "2026-05-22"):
        line = json.dumps({"event_id": day, "event_type": "click", "timestamp": f"{day}T08:00:00Z"})
        year, month, number = day.split("-")
        folder = tmp_path / "events" / f"year={year}" / f"month={month}" / f"day={number}"
        folder.mkdir(parents=True)
        (folder / "a.jsonl").write_text(line + "\n")
    one = read_event_days(spark, base, "2026-05-22")
    assert [r.event_id for r in one.collect()] == ["2026-05-22"]
    assert len(one.inputFiles()) == 1
    none = read_event_days(spark, base, "2026-05-23")
    assert none.columns == one.columns and none.count() == 0


def test_only_rows_without_device_are_joined(spark, events):
    devices = spark.createDataFrame([("U1", "tablet")], "user_id string, __modal_device string")
    rows = events({"device_type": None}, {"device_type": "mobile"}, {"user_id": "U9", "device_type": None})
    filled = impute_device(rows, devices)
    assert {r.event_id: r.device_type for r in filled.collect()} == {
        "E0": "tablet", "E1": "mobile", "E2": "UNKNOWN",
    }

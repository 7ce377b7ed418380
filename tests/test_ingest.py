import gzip
import json

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F
from test_validation import event

from footfall.functions.isolation import spoilers
from footfall.operators import ingest as op
from footfall.operators.validation import validate_lines
from footfall.plans.ingest import IngestTargets, ingest_lines, slim_verdicts
from footfall.sources.lines import read_lines
from footfall.streaming import arrivals
from footfall.streaming.arrivals import start_ingest, stream_rollup

DAY = "year=2026/month=05/day=22"


def put(root, key, lines):
    path = root / key
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    return path


def good(n, kind="page_view"):
    return [event(kind)] * n


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "bucket"
    put(root, f"events/{DAY}/valid.jsonl", good(50) + good(50, "cart_event"))
    mixed = good(4) + ["{not valid json}"] + good(4) + [event("page_view", user_id="bad")]
    put(root, f"events/{DAY}/mixed.jsonl", mixed)
    put(root, f"events/{DAY}/corrupt.jsonl", ["junk"] * 8 + good(2))
    put(root, "events/year=2026/month=05/day=23/half.jsonl", ["junk"] + good(1))
    return root


def results(out):
    return IngestTargets.under(str(out))


def run(spark, root, out, batch="1", paths=None):
    lines = read_lines(spark, paths or f"{root}/events", str(root))
    ingest_lines(lines, IngestTargets.under(str(out)), "bucket", batch)


def test_files_are_summarised_and_rejects_kept(spark, landing, tmp_path):
    out = tmp_path / "out"
    run(spark, landing, out)
    files = {r["source_key"]: r for r in as_dicts(results(out).summaries(spark))}
    valid = files[f"events/{DAY}/valid.jsonl"]
    assert (valid["records_valid"], valid["records_invalid"]) == (100, 0)
    assert (valid["page_view"], valid["cart_event"], valid["click"]) == (50, 50, 0)
    assert valid["quarantine_key"] is None and valid["quarantine_count"] == 0
    assert valid["size_bytes"] == (landing / "events" / DAY / "valid.jsonl").stat().st_size
    mixed = files[f"events/{DAY}/mixed.jsonl"]
    assert (mixed["records_valid"], mixed["records_invalid"], mixed["invalid_ratio"]) == (8, 2, 0.2)
    assert mixed["quarantine_key"] == f"quarantine/{DAY}/mixed.errors.jsonl"
    corrupt = files[f"events/{DAY}/corrupt.jsonl"]
    assert corrupt["is_corrupt"] and corrupt["quarantine_count"] == -1
    assert corrupt["quarantine_key"] == f"quarantine/{DAY}/corrupt.full.jsonl"
    assert files["events/year=2026/month=05/day=23/half.jsonl"]["is_corrupt"], "0.5 is enough"

    rows = sorted(as_dicts(results(out).rejects(spark)), key=lambda r: r["line_number"])
    assert [r["line_number"] for r in rows] == [5, 10]
    assert {r["source_key"] for r in rows} == {f"events/{DAY}/mixed.jsonl"}
    assert rows[0]["error_reason"].startswith("json_decode_error")
    assert rows[0]["raw_payload"] == "{not valid json}" and rows[0].get("event_type") is None
    assert rows[1]["event_type"] == "page_view"

    assert {r["quarantine_key"] for r in rows} == {mixed["quarantine_key"]}
    folder = f"quarantine_key={mixed['quarantine_key']}".replace("/", "%2F").replace("=", "%3D")
    folder = folder.replace("%3D", "=", 1)
    first = next(out.glob(f"rejects/attempt=*/{DAY}/{folder}/*.json")).read_text().splitlines()[0]
    assert set(json.loads(first)) == {
        "line_number", "source_key", "event_type", "error_reason", "raw_payload", "batch",
    }

    copy = results(out).whole_files(spark, corrupt["quarantine_key"]).collect()
    text = (landing / "events" / DAY / "corrupt.jsonl").read_text().split("\n")[:-1]
    assert [r.line for r in sorted(copy, key=lambda r: r.line_number)] == text
    assert sorted(r.line_number for r in copy) == list(range(1, len(text) + 1))

    metrics = {
        r["name"]: r["value"]
        for r in as_dicts(results(out).metrics(spark))
        if r["source_key"].endswith("mixed.jsonl") and r["event_type"] is None
    }
    assert metrics["RecordsInvalid"] == 2.0 and metrics["InvalidRate"] == 20.0
    assert metrics["ProcessingDurationMs"] > 0


def test_running_a_batch_again_replaces_it(spark, landing, tmp_path):
    out = tmp_path / "out"
    run(spark, landing, out)
    run(spark, landing, out)
    assert results(out).summaries(spark).count() == 4
    assert results(out).rejects(spark).count() == 2


def test_line_numbers_over_many_blocks(spark, tmp_path):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    lines = ["bad " + "x" * (i % 37) if i % 7 == 0 else event("search") for i in range(1, 3001)]
    path = put(tmp_path, "events/long.jsonl", lines)
    put(tmp_path, "events/other.jsonl", ["bad", event("search"), "bad"])
    spark.conf.set(key, "20000")
    try:
        scan = read_lines(spark, f"{tmp_path}/events", str(tmp_path))
        assert scan.select("source_key", "block").distinct().count() > 20
        verdicts = slim_verdicts(validate_lines(scan))
        offsets = op.block_offsets(scan)
        got = op.with_line_numbers(verdicts.filter(~F.col("is_valid")), offsets).collect()
    finally:
        spark.conf.set(key, before)
    numbers = sorted(r.line_number for r in got if r.source_key == "events/long.jsonl")
    assert numbers == list(range(7, 3001, 7))
    text = path.read_text().split("\n")
    assert all(text[r.line_number - 1] == r.raw for r in got if r.source_key.endswith("long.jsonl"))
    assert sorted(r.line_number for r in got if r.source_key.endswith("other.jsonl")) == [1, 3]


def test_payload_is_cut_at_1000_characters(spark, tmp_path):
    put(tmp_path, "events/a.jsonl", [json.dumps(event("page_view")) + "x" * 5000] + good(2))
    out = tmp_path / "out"
    run(spark, tmp_path, out)
    row = results(out).rejects(spark).first()
    assert len(row.raw_payload) == 1000 and row.line_number == 1


def test_keys_without_the_usual_prefix_and_suffix(spark):
    df = spark.createDataFrame([("data/x.txt",), ("events/a/b.jsonl",)], "k string")
    rows = df.select(op.quarantine_key(F.col("k"), F.lit(False)).alias("q")).collect()
    assert [r.q for r in rows] == ["quarantine/data/x.txt.errors.jsonl",
                                   "quarantine/a/b.errors.jsonl"]


def start(spark, root, out, **options):
    query = start_ingest(
        spark, f"{root}/events", str(root), str(out), f"{out}/checkpoint", **options
    )
    query.awaitTermination()


def test_each_arriving_file_is_ingested_once(spark, landing, tmp_path):
    out = tmp_path / "out"
    start(spark, landing, out)
    assert results(out).summaries(spark).count() == 4
    put(landing, f"events/{DAY}/late.jsonl", good(3, "search"))
    start(spark, landing, out)
    files = results(out).summaries(spark)
    assert files.count() == 5
    late = files.filter(F.col("source_key").endswith("late.jsonl")).first()
    assert late.search == 3 and late.batch.endswith("-1")


def test_odd_names_and_a_second_checkpoint(spark, tmp_path):
    root, out = tmp_path / "bucket", tmp_path / "out"
    put(root, "events/a/x.jsonl", ["junk"] * 3)
    put(root, "events/b/x.jsonl", ["rubbish"] * 2)
    put(root, "events/a/with space+[1].jsonl", good(2))
    start(spark, root, out)
    files = {r.source_key: r for r in results(out).summaries(spark).collect()}
    assert set(files) == {"events/a/x.jsonl", "events/b/x.jsonl", "events/a/with space+[1].jsonl"}
    assert files["events/a/with space+[1].jsonl"].records_valid == 2
    assert results(out).failures(spark).count() == 0
    whole = results(out).whole_files(spark)
    counts = {r["line"]: r["count"] for r in whole.groupBy("line").count().collect()}
    assert counts == {"junk": 3, "rubbish": 2}
    query = start_ingest(spark, f"{root}/events", str(root), str(out), f"{tmp_path}/second")
    query.awaitTermination()
    assert results(out).summaries(spark).count() == 6, "the first results stay"


def test_named_files_without_lines_are_reported(spark, tmp_path):
    put(tmp_path, "events/a.jsonl", good(2))
    named = spark.createDataFrame(
        [("events/a.jsonl", 9), ("events/empty.jsonl", 0)], "source_key string, size_bytes long"
    )
    targets = IngestTargets.under(f"{tmp_path}/out")
    lines = read_lines(spark, f"{tmp_path}/events", str(tmp_path))
    ingest_lines(lines, targets, "bucket", "1", files=named)
    rows = {r.source_key: r for r in targets.summaries(spark).collect()}
    empty = rows["events/empty.jsonl"]
    assert (empty.size_bytes, empty.records_valid, empty.is_corrupt) == (0, 0, False)
    assert rows["events/a.jsonl"].records_valid == 2


def test_unreadable_file_does_not_stop_the_others(spark, landing, tmp_path):
    out = tmp_path / "out"
    broken = landing / "events" / DAY / "broken.jsonl.gz"
    broken.write_bytes(gzip.compress(b"x" * 100000)[:60] + b"\x00" * 10)
    start(spark, landing, out, pattern="*.jsonl*")
    assert results(out).summaries(spark).count() == 4
    failed = results(out).failures(spark).collect()
    assert [(r.source_key, r.error) for r in failed] == [(f"events/{DAY}/broken.jsonl.gz", True)]


def test_only_corrupt_files_are_listed_again(spark, landing, monkeypatch):
    from footfall.plans import ingest

    plans = []
    read = ingest.read_lines

    def spied(session, paths, root):
        plans.append(paths)
        return read(session, paths, root)

    monkeypatch.setattr(ingest, "read_lines", spied)
    path = read(spark, f"{landing}/events/{DAY}/corrupt.jsonl", "/").first().path
    corrupt = spark.createDataFrame([("k", path, "q")], "source_key string, path string, quarantine_key string")
    rows = ingest.whole_file_lines(spark, corrupt).collect()
    assert plans == [[path]] and len(rows) == 10 and {r.quarantine_key for r in rows} == {"q"}


def test_whole_files_of_many_blocks_keep_their_lines(spark, tmp_path):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    lines = [f"junk {i} " + "y" * (i % 41) for i in range(2000)]
    put(tmp_path, "events/all.jsonl", lines)
    spark.conf.set(key, "9000")
    try:
        run(spark, tmp_path, tmp_path / "out")
    finally:
        spark.conf.set(key, before)
    rows = results(tmp_path / "out").whole_files(spark).collect()
    assert [r.line for r in sorted(rows, key=lambda r: r.line_number)] == lines


def test_a_batch_killed_half_way_leaves_nothing_to_readers(spark, landing, tmp_path, monkeypatch):
    from footfall.plans import ingest

    out = tmp_path / "out"
    put(tmp_path / "bucket", f"events/{DAY}/more.jsonl", ["bad", *good(9)])
    write = ingest.write_part

    def dies(df, attempt, kind, *folders, **options):
        if kind == "summaries":
            raise RuntimeError("executor lost")
        write(df, attempt, kind, *folders, **options)

    monkeypatch.setattr(ingest, "write_part", dies)
    with pytest.raises(Exception, match="executor lost"):
        start(spark, landing, out)
    assert list(out.glob("rejects/attempt=*")), "the first try has written rejects"
    assert results(out).rejects(spark).count() == 0
    monkeypatch.setattr(ingest, "write_part", write)
    start(spark, landing, out)
    assert len(list(out.glob("rejects/attempt=*"))) == 2
    rows = [(r.quarantine_key[-17:], r.line_number) for r in results(out).rejects(spark).collect()]
    assert sorted(rows) == [("ixed.errors.jsonl", 5), ("ixed.errors.jsonl", 10), ("more.errors.jsonl", 1)]
    assert results(out).summaries(spark).count() == 5


def test_a_committed_batch_is_not_ingested_twice(spark, landing, tmp_path):
    out = tmp_path / "out"
    start(spark, landing, out)
    progress = out / "checkpoint" / "commits" / "0"
    progress.unlink()
    (out / "checkpoint" / "commits" / ".0.crc").unlink(missing_ok=True)
    start(spark, landing, out)
    assert len(list(out.glob("summaries/attempt=*"))) == 1
    assert results(out).summaries(spark).count() == 4


def test_broken_files_are_found_by_halving():
    for bad in (set(), {0}, {49}, {7, 8}, {3, 31}, {0, 49}, set(range(50))):
        tries = []

        def spoiled(group, bad=bad, tries=tries):
            tries.append(list(group))
            return bool(bad & set(group))

        assert set(spoilers(range(50), spoiled)) == bad
        assert len(tries) <= (15 if len(bad) < 3 else 101)
        if len(bad) == 1:
            assert len(tries) <= 8


def test_files_that_a_failure_names_are_not_halved():
    for bad in (set(), {0}, {7, 8}, {3, 31, 49}, set(range(50))):
        tries, last = [], [sorted(bad)]

        def spoiled(group, bad=bad, tries=tries, last=last):
            tries.append(list(group))
            last[0] = [i for i in group if i in bad]
            return bool(last[0])

        found = spoilers(range(50), spoiled, lambda group, last=last: [i for i in last[0][:1] if i in group])
        assert set(found) == bad
        assert len(tries) <= (2 * len(bad) if 0 < len(bad) < 6 else 101)
    text = "[FAILED_READ_FILE.NO_HINT] Encountered error while reading file file:///a/x%20y%252F.gz.  SQLSTATE"
    paths = ["file:/a/x y%2F.gz", "file:/a/x y/.gz", "/a/other.gz"]
    assert arrivals.named_files(text, paths) == paths[:1] and not arrivals.named_files("lost", paths)


def test_no_line_is_validated_before_all_compressed_files_are_read(spark, tmp_path, monkeypatch):
    lines = "\n".join(json.dumps(x) for x in good(500)).encode()
    folder = tmp_path / "bucket" / "events" / DAY
    folder.mkdir(parents=True)
    for i in range(6):
        (folder / f"whole {i}.jsonl.gz").write_bytes(gzip.compress(lines))
    for i in range(2):
        (folder / f"cut {i}.jsonl.gz").write_bytes(gzip.compress(lines)[:100])
    tries, ingest, find = [], arrivals.ingest_lines, arrivals.spoilers

    def counted(items, spoiled, *told):
        return find(items, lambda group: tries.append(len(group)) or spoiled(group), *told)

    monkeypatch.setattr(arrivals, "ingest_lines", lambda *a, **k: tries.append("ingest") or ingest(*a, **k))
    monkeypatch.setattr(arrivals, "spoilers", counted)
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    start(spark, tmp_path / "bucket", tmp_path / "out", pattern="*.gz")
    assert tries == [1, 7, 1, 6, "ingest"]
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) == before
    rows = results(tmp_path / "out").summaries(spark).collect()
    assert sorted(r.records_valid for r in rows) == [500] * 6
    failed = results(tmp_path / "out").failures(spark).collect()
    assert sorted(r.source_key[-14:] for r in failed) == ["cut 0.jsonl.gz", "cut 1.jsonl.gz"]


METRIC = """source_key string, recorded_at timestamp, name string, value double, unit string,
    event_type string, source string"""


def metric_rows(spark):
    rows = [
        ("a", "2026-05-22 10:01:00", "RecordsValid", 10.0, "Count", None, "s"),
        ("b", "2026-05-22 10:04:59", "RecordsValid", 5.0, "Count", None, "s"),
        ("c", "2026-05-22 10:05:00", "RecordsValid", 1.0, "Count", None, "s"),
        ("a", "2026-05-22 10:01:00", "InvalidRate", 20.0, "Percent", None, "s"),
        ("b", "2026-05-22 10:02:00", "InvalidRate", 40.0, "Percent", None, "s"),
        ("a", "2026-05-22 10:01:00", "ProcessingDurationMs", 3.0, "Milliseconds", None, "s"),
        ("a", "2026-05-22 10:01:00", "EventsByType", 7.0, "Count", "click", "s"),
    ]
    flat = spark.createDataFrame(rows, METRIC.replace("recorded_at timestamp", "at string"))
    return flat.withColumn("recorded_at", F.col("at").cast("timestamp")).drop("at")


def test_five_minute_rollup(spark):
    rows = {
        (r["window_start"].minute, r["name"]): r for r in as_dicts(op.rollup_metrics(metric_rows(spark)))
    }
    assert rows[0, "RecordsValid"]["total"] == 15.0 and rows[5, "RecordsValid"]["total"] == 1.0
    assert rows[0, "InvalidRate"]["average"] == 30.0 and rows[0, "InvalidRate"]["alert_at"] == 50.0
    assert rows[0, "ProcessingDurationMs"]["maximum"] == 3.0
    assert rows[0, "EventsByType"]["event_type"] == "click"


def test_rollup_of_a_metric_stream(spark, tmp_path):
    metric_rows(spark).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(metric_rows(spark).schema).parquet(f"{tmp_path}/in")
    query = (
        stream_rollup(stream)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("rolled")
        .option("checkpointLocation", f"{tmp_path}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    want = {tuple(r) for r in op.rollup_metrics(metric_rows(spark)).collect()}
    assert {tuple(r) for r in spark.table("rolled").collect()} == want


def test_kept_rollup_survives_a_death_before_its_commit_and_reports_late_rows(
    spark, tmp_path, monkeypatch
):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    rows = metric_rows(spark)
    cut = F.lit("2026-05-22 10:04:00").cast("timestamp")
    rows.filter(F.col("recorded_at") >= cut).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(arrivals, "commit", killed)
        with pytest.raises(Exception, match="killed"):
            arrivals.start_rollup(stream, out, progress, "1 minute").awaitTermination()
    assert arrivals.read_rollup(spark, out).isEmpty(), "nothing counts before the commit"
    arrivals.start_rollup(stream, out, progress, "1 minute").awaitTermination()
    late = rows.filter(F.col("recorded_at") < cut)
    older = late.withColumn("recorded_at", F.expr("recorded_at - INTERVAL 1 HOUR"))
    late.unionByName(older).coalesce(1).write.mode("append").parquet(source)
    arrivals.start_rollup(stream, out, progress, "1 minute").awaitTermination()
    arrivals.start_rollup(stream, out, progress, "1 minute").awaitTermination()

    got = arrivals.read_rollup(spark, out)
    want = op.rollup_metrics(rows.unionByName(older))
    assert {tuple(r) for r in got.drop("late_rows").collect()} == {tuple(r) for r in want.collect()}
    # the window of 10:00 is still open at 10:04, an hour before it all windows are closed
    by_hour = got.groupBy(F.hour("window_start").alias("h")).agg(F.sum("late_rows").alias("n"))
    assert {r.h: r.n for r in by_hour.collect()} == {9: older.count(), 10: 0}

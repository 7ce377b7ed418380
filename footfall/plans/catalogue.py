"""Every operator as a query over the supplied tables.

Each entry takes a session and a folder of Parquet tables and runs on the whole
tables. Values that depend on summation order are rounded to six places.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.operators import cleaning, ingest, profile, reports, rulesets, warehouse
from footfall.operators import quality as dq
from footfall.operators import validation as check
from footfall.operators.metrics import METRICS
from footfall.operators.metrics import anomalies as anomaly
from footfall.operators.metrics import day_sketches
from footfall.plans.daily import run, run_daily
from footfall.plans.ingest import IngestTargets
from footfall.plans.load import load_all, load_metric
from footfall.session import configure
from footfall.sources import shop_tables as shop
from footfall.sources.events import on_day, read_event_days, write_event_days
from footfall.sources.lines import copy_start
from footfall.sources.metric_store import (
    APPEND,
    REPLACE_ALL,
    read_days,
    read_metric,
    table_path,
    write_days,
)
from footfall.sources.staging import scratch_path, stage
from footfall.streaming.arrivals import read_rollup, start_ingest, start_rollup

REPORT_DAY = "2024-01-15"
# A product has at most a few views per day in the small tables.
METRIC_OPTIONS = {"product_gap": {"min_views": 3}}
_SOURCE = "shop"


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return shop.clickstream(spark, folder)


def _local_time(df: DataFrame) -> DataFrame:
    return df.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


def _deduped(spark, folder, *columns) -> DataFrame:
    return cleaning.deduplicate(_events(spark, folder).select("event_id", "event_ts", *columns))


def _clean(spark, folder, columns) -> DataFrame:
    return cleaning.clean_events(_events(spark, folder), columns)


def _metric(spark, folder, name) -> DataFrame:
    metric = METRICS[name]
    events = _clean(spark, folder, metric.columns)
    return metric.compute(events, **METRIC_OPTIONS.get(name, {}))


def _fact(spark, folder, name, exact=False) -> DataFrame:
    return warehouse.to_fact(name, _metric(spark, folder, name), exact)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- scan and cleaning ------------------------------------------------------------
def events_typed(spark, folder):
    return _local_time(_events(spark, folder)).select(
        "event_id", "event_type", "user_id", "session_id", "timestamp", "event_ts", "dt", "hour",
        "page_url", "page_type", "time_on_page_seconds", "device_type", "country",
        "product_id", "category", "price", "action",
    )


def day_guard(spark, folder):
    return on_day(_events(spark, folder), REPORT_DAY).select("event_id", "event_type", "dt")


def landing_round_trip(spark, folder):
    """Write JSON lines by day, read them back with the typed scan."""
    base = scratch_path(spark, "landing")
    write_event_days(shop.raw_clickstream(spark, folder), base)
    return (
        read_event_days(spark, base)
        .groupBy("dt", "event_type")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_distinct("event_id").alias("ids"),
            F.round(F.sum("time_on_page_seconds"), 2).alias("seconds"),
            F.max("event_ts").cast("timestamp_ntz").alias("last_ts"),
        )
    )


def landing_one_day(spark, folder):
    """Only the folders of one day are scanned."""
    base = scratch_path(spark, "landing")
    write_event_days(shop.raw_clickstream(spark, folder), base)
    return read_event_days(spark, base, REPORT_DAY).select("event_id", "event_type", "hour", "dt")


def dedup(spark, folder):
    return _local_time(_deduped(spark, folder, "event_type", "user_id", "dt", "page_url"))


def impute_country(spark, folder):
    return cleaning.impute_country(_deduped(spark, folder, "country")).select("event_id", "country")


def impute_device(spark, folder):
    events = _deduped(spark, folder, "event_type", "user_id", "device_type")
    return cleaning.impute_device(stage(events, "deduped")).select(
        "event_id", "user_id", "device_type"
    )


def impute_time(spark, folder):
    events = _deduped(spark, folder, "event_type", "page_type", "time_on_page_seconds")
    return cleaning.impute_time_on_page(stage(events, "deduped")).select(
        "event_id", "page_type", "time_on_page_seconds"
    )


def normalize_url(spark, folder):
    return cleaning.normalize_url(_events(spark, folder)).select("event_id", "page_url")


def normalize_country(spark, folder):
    return cleaning.normalize_country(_events(spark, folder)).select("event_id", "country")


def clean(spark, folder):
    columns = [
        "event_id", "event_ts", "event_type", "user_id", "session_id", "dt", "page_url",
        "page_type", "time_on_page_seconds", "device_type", "country", "product_id", "action",
    ]
    return _local_time(_clean(spark, folder, columns))


# --- metrics ----------------------------------------------------------------------
def top_pages(spark, folder):
    return _rounded(_metric(spark, folder, "top_pages"), "avg_time_on_page")


def _session_features(spark, folder):
    events = _clean(spark, folder, METRICS["anomalies"].columns)
    return anomaly.session_features(events)


def zscore_flags(spark, folder):
    return anomaly.zscore_flags(stage(_session_features(spark, folder), "features"))


def iqr_flags(spark, folder):
    return anomaly.iqr_flags(stage(_session_features(spark, folder), "features"))


def daily_batch(spark, folder):
    """The whole batch written and read back: rows of every metric table."""
    base = scratch_path(spark, "metrics")
    run_daily(_events(spark, folder), base, options=METRIC_OPTIONS)
    tables = {name: read_metric(spark, base, name) for name in METRICS}
    return profile.metric_row_counts(tables)


def pages_over_days(spark, folder):
    """Pages over the days from the report day on, from sketches stored per day."""
    path = scratch_path(spark, "page_sketches")
    write_days(day_sketches.page_sketches(_clean(spark, folder, day_sketches.COLUMNS)), path)
    recent = read_days(spark, path).filter(F.col("dt") >= F.lit(REPORT_DAY).cast("date"))
    return day_sketches.pages_over_days(recent)


def daily_without_events(spark, folder):
    """The batch over the day after the last one stops before it writes; the others are there."""
    base, out = scratch_path(spark, "landing"), scratch_path(spark, "metrics")
    events = shop.raw_clickstream(spark, folder)
    write_event_days(events, base)
    last = read_event_days(spark, base).agg(F.max("dt").alias("last")).first().last
    found = []
    for day in [last, last + timedelta(days=1)]:
        summary = run(spark, base, f"{out}/{day}", day.isoformat())
        tables = len(summary.get("metrics", {}))
        found.append((day, summary.get("events_raw", summary.get("events_processed")), tables))
    return spark.createDataFrame(found, "dt date, events_read long, tables_written int")


def output_check(spark, folder):
    base = scratch_path(spark, "metrics")
    run_daily(_events(spark, folder), base, options=METRIC_OPTIONS)
    tables = {name: read_metric(spark, base, name, REPORT_DAY) for name in METRICS}
    return profile.metric_row_counts(tables)


# --- validation and ingest --------------------------------------------------------
def _verdicts(spark, folder):
    return check.validate_lines(shop.event_lines(spark, folder))


def _positioned(verdicts: DataFrame) -> DataFrame:
    place = Window.partitionBy("source_key", "block").orderBy("ts", "number", "copy")
    return verdicts.withColumn("position", F.row_number().over(place))


def _summary(verdicts: DataFrame) -> DataFrame:
    return ingest.file_summary(verdicts, F.sum(F.col("line_bytes") + 1), last_ts=F.max("ts"))


def _staged_verdicts(spark, folder):
    columns = ("source_key", "is_valid", "event_type", "line_bytes", "ts")
    return stage(_verdicts(spark, folder).select(*columns), "verdicts")


def validate_verdicts(spark, folder):
    return _verdicts(spark, folder).select("number", "copy", "is_valid", "event_type", "error")


def valid_events(spark, folder):
    return check.valid_events(_verdicts(spark, folder)).select(
        "event_id", "event_type", "page_url", "time_on_page_seconds", "x_position", "y_position",
        "results_count", "product_id", "price", "action",
    )


def event_shape(spark, folder):
    lines = check.matches_one_event_shape(shop.event_lines(spark, folder))
    return lines.select("number", "copy", "matches_event")


def quarantine_records(spark, folder):
    columns = (
        "source_key", "block", "ts", "number", "copy", "line_bytes",
        "is_valid", "event_type", "error", "raw",
    )
    verdicts = stage(_positioned(_verdicts(spark, folder).select(*columns)), "verdicts")
    offsets = stage(ingest.block_offsets(verdicts), "offsets")
    return ingest.quarantine_records(verdicts, offsets, stage(_summary(verdicts), "summary"))


def ingest_summary(spark, folder):
    return _summary(_staged_verdicts(spark, folder))


def corrupt_files(spark, folder):
    return ingest.corrupt_files(_summary(_staged_verdicts(spark, folder)))


def _metrics(spark, folder):
    # The time an ingest takes is not a function of the data; size stands in for it.
    return ingest.ingest_metrics(
        _summary(_staged_verdicts(spark, folder)),
        _SOURCE,
        F.col("last_ts").cast("timestamp"),
        F.col("size_bytes") / 1000,
    )


def ingest_metrics(spark, folder):
    return _rounded(_metrics(spark, folder), "value").withColumn(
        "recorded_at", F.col("recorded_at").cast("timestamp_ntz")
    )


def metric_rollup_5m(spark, folder):
    rolled = ingest.rollup_metrics(stage(_metrics(spark, folder), "metrics"))
    return _rounded(rolled, "total", "average", "maximum").withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")
    )


def rollup_restarted(spark, folder):
    """The roll-up of a stream that stops and starts again; the second run only has late rows."""
    base, out, progress = [scratch_path(spark, k) for k in ("metrics", "rollup", "progress")]
    metrics = stage(_metrics(spark, folder), "metrics")
    recent = F.col("recorded_at") >= F.lit(REPORT_DAY).cast("timestamp")
    spark.createDataFrame([], metrics.schema).write.parquet(base)
    stream = spark.readStream.schema(metrics.schema).parquet(base)
    for rows in (metrics.filter(recent), metrics.filter(~recent)):
        rows.write.mode("append").parquet(base)
        start_rollup(stream, out, progress).awaitTermination()
    return _rounded(read_rollup(spark, out), "total", "average", "maximum").withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")
    )


def entity_validation(spark, folder):
    checked = check.validate_entities(shop.entity_lines(spark, folder))
    return checked.select("entity", "id", "is_valid", "error")


def arrival_ingest(spark, folder):
    """Lines written as text files, ingested by the arrival stream, totalled by day."""
    base, out = scratch_path(spark, "arrivals"), scratch_path(spark, "ingested")
    lines = shop.event_lines(spark, folder).withColumn("day", F.to_date("ts"))
    lines.select("day", F.col("line").alias("value")).write.partitionBy("day").text(base)
    query = start_ingest(
        spark, base, base, out, scratch_path(spark, "progress"), _SOURCE, pattern="*.txt"
    )
    query.awaitTermination()
    day = F.regexp_extract("source_key", "day=([0-9-]+)", 1).cast("date")
    totals = ("records_valid", "records_invalid", "page_view", "click", "search", "product_view",
              "cart_event")
    files = IngestTargets.under(out).summaries(spark)
    return files.groupBy(day.alias("day")).agg(*[F.sum(c).alias(c) for c in totals])


def _landed(spark, folder, compression="none") -> str:
    """Event lines as one text file per source key, in the order of their events."""
    base = scratch_path(spark, "arrivals")
    (
        shop.event_lines(spark, folder)
        .repartition("source_key")
        .sortWithinPartitions("source_key", "ts", "number", "copy")
        .select("source_key", F.col("line").alias("value"))
        .write.option("compression", compression)
        .partitionBy("source_key")
        .text(base)
    )
    return base


def _arrived(spark, base, pattern="*.txt*") -> IngestTargets:
    out = scratch_path(spark, "ingested")
    query = start_ingest(
        spark, base, base, out, scratch_path(spark, "progress"), _SOURCE, pattern=pattern
    )
    query.awaitTermination()
    return IngestTargets.under(out)


def _landed_key() -> Column:
    """The source key that a landed file stands for: its folder's, without the part's name."""
    return F.url_decode(F.regexp_extract("source_key", "^source_key=([^/]+)/", 1))


def arrival_rejects(spark, folder):
    """Rejected lines where the files' summaries say they are kept, through the manifest."""
    results = _arrived(spark, _landed(spark, folder))
    keys = results.summaries(spark).filter("NOT is_corrupt").select("quarantine_key")
    return results.rejects(spark).join(keys, "quarantine_key").select(
        _landed_key().alias("source_key"), "line_number", "error_reason"
    )


def arrival_whole_files(spark, folder):
    """Every line of the files that were set aside as a whole, with its number."""
    results = _arrived(spark, _landed(spark, folder))
    keys = results.summaries(spark).filter("is_corrupt").select("quarantine_key")
    return results.whole_files(spark).join(keys, "quarantine_key").select(
        _landed_key().alias("source_key"), "line_number", "line"
    )


def arrival_summary(spark, folder):
    results = _arrived(spark, _landed(spark, folder))
    return results.summaries(spark).select(
        _landed_key().alias("source_key"), "size_bytes", "records_valid", "records_invalid",
        "invalid_ratio", "is_corrupt", "quarantine_count", "quarantine_reason",
    )


def arrival_retry(spark, folder):
    """Compressed files, two of which also arrive a second time cut in half: those alone fail."""
    base = _landed(spark, folder, "gzip")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    named = F.struct("path", "length")
    ends = files.agg(F.min(named).alias("a"), F.max(named).alias("b")).first()
    for path, length in {ends.a, ends.b} - {None}:
        copy_start(spark, path, path.replace(".txt.gz", "-half.txt.gz"), length // 2)
    results = _arrived(spark, base)
    failed = results.failures(spark).select("source_key", F.lit(1).alias("failed"))
    read = results.summaries(spark).select("source_key", "records_valid", "records_invalid")
    rows = read.unionByName(failed, allowMissingColumns=True).withColumn("source_key", _landed_key())
    return rows.groupBy("source_key").agg(
        F.sum("records_valid").alias("records_valid"),
        F.sum("records_invalid").alias("records_invalid"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"),
    )


# --- quality and warehouse --------------------------------------------------------
def _stored_facts(spark, folder, names):
    """Facts of metrics the daily batch wrote: events are cleaned once for all."""
    base = scratch_path(spark, "metrics")
    run_daily(_events(spark, folder), base, metrics=names, options=METRIC_OPTIONS)
    return {name: warehouse.to_fact(name, read_metric(spark, base, name)) for name in names}


def dq_outcomes(spark, folder):
    facts = _stored_facts(spark, folder, list(rulesets.FULL_RULES))
    return warehouse.union_all(
        [dq.evaluate(df, rulesets.FULL_RULES[name], f"dq_{name}") for name, df in facts.items()]
    )


def dq_outcomes_typed(spark, folder):
    """The typed set; metrics it does not name are held against the rules of every load."""
    facts = _stored_facts(spark, folder, list(METRICS))
    return warehouse.union_all(
        [dq.evaluate(df, rulesets.rules_for(name, "typed"), f"dq_{name}") for name, df in facts.items()]
    )


def constraint_outcomes(spark, folder):
    """Row and key checks of the warehouse tables, with the table's exact types."""
    base = scratch_path(spark, "metrics")
    run_daily(_events(spark, folder), base, options=METRIC_OPTIONS)
    return warehouse.union_all(
        [
            dq.evaluate(
                warehouse.to_fact(name, read_metric(spark, base, name), exact=True), rules, table
            )
            for name, rules in rulesets.CONSTRAINTS.items()
            for table in [warehouse.FACT_TABLES[name]]
        ]
    )


def _loaded(spark, folder, rule_set="load"):
    """All metrics of the batch loaded by one job: base of the facts, folder of gate results."""
    metrics, facts, results = [scratch_path(spark, k) for k in ("metrics", "facts", "results")]
    run_daily(_events(spark, folder), metrics, options=METRIC_OPTIONS)
    days = _clean(spark, folder, ["dt"]).select("dt")
    dates = stage(warehouse.calendar_spanning(days, "dt"), "dates")
    load_all(spark, metrics, facts, rule_set=rule_set, results=results, dates=dates)
    return facts, results


def gate_results(spark, folder):
    """What the gates of a load of all metrics published, by context and rule."""
    _, results = _loaded(spark, folder)
    schema = "context string, rule string, outcome string, failing_rows long, evaluated_at timestamp"
    return spark.read.schema(schema).json(results).select(
        "context", "rule", "outcome", "failing_rows", F.col("evaluated_at").isNotNull().alias("timed")
    )


def load_all_metrics(spark, folder):
    """Every metric under the name of its fact table: rows, ids of business keys, days, stamps."""
    facts, _ = _loaded(spark, folder, "typed")
    counted = [
        read_days(spark, table_path(facts, table)).agg(
            F.lit(metric).alias("metric"),
            F.lit(table).alias("fact_table"),
            F.count(F.lit(1)).alias("fact_rows"),
            F.count_distinct("id").alias("ids"),
            F.count_distinct("dt").alias("days"),
            F.count("loaded_at").alias("stamped"),
        )
        for metric, table in warehouse.FACT_TABLES.items()
    ]
    return warehouse.union_all(counted)


def dq_outcomes_lineitem(spark, folder):
    """Rules over a large table: one pass for all row rules, one grouping for the key."""
    rules = [
        dq.is_complete("l_orderkey"),
        dq.values("l_quantity", ">", 0),
        dq.values("l_extendedprice", ">", 1000),
        dq.values("l_quantity", ">=", 10),
        dq.values_between("l_discount", 0, 0.05),
        dq.has_type("l_returnflag", "INTEGER"),
        dq.has_type("l_linenumber", "INTEGER"),
        dq.has_type("l_tax", "DOUBLE"),
        dq.is_primary_key("l_orderkey", "l_linenumber"),
    ]
    return dq.evaluate(shop.table(spark, folder, "lineitem"), rules, "dq_lineitem")


def dq_passing_rows(spark, folder):
    return dq.passing_rows(_fact(spark, folder, "product_gap"), rulesets.FULL_RULES["product_gap"])


def dq_failing_rows(spark, folder):
    rows = dq.failing_rows(_fact(spark, folder, "product_gap"), rulesets.FULL_RULES["product_gap"])
    return rows.withColumn("broken_rules", F.array_join("broken_rules", "; "))


def unique_key_check(spark, folder):
    facts = _stored_facts(spark, folder, ["bounce_rate", "funnel", "device_country"])
    rules = {
        name: [*[r for r in rulesets.CONSTRAINTS[name] if r.keys], *rulesets.COMMON_RULES]
        for name in facts
    }
    return warehouse.union_all(
        [dq.evaluate(df, rules[name], name) for name, df in facts.items()]
    )


def change_schema(spark, folder):
    return _fact(spark, folder, "anomalies", exact=True)


def _order_days(spark, folder):
    return shop.table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("dt"))


def _ship_calendar(spark, folder):
    days = shop.table(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("dt"))
    return warehouse.calendar_spanning(days, "dt")


def referential_check(spark, folder):
    return dq.missing_references(
        _order_days(spark, folder), stage(_ship_calendar(spark, folder), "dates"), "dt"
    )


def dim_date(spark, folder):
    return warehouse.calendar_spanning(_order_days(spark, folder), "dt")


def dims_insert_absent(spark, folder):
    return warehouse.absent_rows(
        dim_date(spark, folder), stage(_ship_calendar(spark, folder), "dates"), ["dt"]
    )


def countries_insert_absent(spark, folder):
    """Countries in the events that the dimension does not have yet."""
    used = _clean(spark, folder, ["country"]).select(F.col("country").alias("country_code"))
    return warehouse.absent_rows(used, warehouse.dim_country(spark), ["country_code"])


def device_dimension_use(spark, folder):
    """Every device of the dimension with the cleaned events that refer to it."""
    used = _clean(spark, folder, ["device_type"]).groupBy("device_type").agg(
        F.count(F.lit(1)).alias("events")
    )
    return warehouse.dim_device(spark).join(used, "device_type", "left").select(
        "device_type", F.coalesce("events", F.lit(0)).alias("events")
    )


def fact_load_append(spark, folder):
    """Load everything twice in append mode: rows, ids from business keys and stamps by day."""
    metrics, facts = scratch_path(spark, "metrics"), scratch_path(spark, "facts")
    write_days(_metric(spark, folder, "device_country"), table_path(metrics, "device_country"))
    for _ in range(2):
        load_metric(spark, "device_country", metrics, facts, mode=APPEND)
    loaded = read_days(spark, table_path(facts, "fact_device_country"))
    return loaded.groupBy("dt").agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_distinct("id").alias("ids"),
        F.count("loaded_at").alias("stamped"),
    )


def fact_serial_ids(spark, folder):
    """Two loads, mobile rows first: the second one's numbers go on where the first one's end."""
    facts = stage(_fact(spark, folder, "device_country"), "facts")
    path = scratch_path(spark, "serial_facts")
    order, last = list(warehouse.BUSINESS_KEYS["device_country"]), 0
    for rows in (facts.filter("device_type = 'mobile'"), facts.filter("device_type <> 'mobile'")):
        warehouse.with_serial_ids(rows, order, last).write.mode("append").parquet(path)
        last = spark.read.parquet(path).agg(F.max("serial_id")).first()[0] or 0
    return spark.read.parquet(path).select("serial_id", *order, "page_views")


def fact_load_replace_all(spark, folder):
    """Load all days, then replace the whole table by one day."""
    metrics, facts = scratch_path(spark, "metrics"), scratch_path(spark, "facts")
    write_days(_metric(spark, folder, "device_country"), table_path(metrics, "device_country"))
    load_metric(spark, "device_country", metrics, facts)
    load_metric(spark, "device_country", metrics, facts, run_date=REPORT_DAY, mode=REPLACE_ALL)
    loaded = read_days(spark, table_path(facts, "fact_device_country"))
    return loaded.select("dt", "device_type", "country", "page_views", "unique_sessions")


def fact_load_replace_day(spark, folder):
    """Load all days, then load one day again with only its mobile rows."""
    metrics, facts = scratch_path(spark, "metrics"), scratch_path(spark, "facts")
    path = table_path(metrics, "device_country")
    write_days(_metric(spark, folder, "device_country"), path)
    load_metric(spark, "device_country", metrics, facts)
    mobile = read_days(spark, path, REPORT_DAY).filter(F.col("device_type") == "mobile")
    write_days(stage(mobile, "mobile"), path)
    load_metric(spark, "device_country", metrics, facts, run_date=REPORT_DAY)
    loaded = read_days(spark, table_path(facts, "fact_device_country"))
    return loaded.select("dt", "device_type", "country", "page_views", "unique_sessions")


# --- reports ----------------------------------------------------------------------
def _report_facts(spark, folder, *names, exact=False):
    """Facts of the report day as the warehouse stores them; other days are pruned.

    The batch and the load stand for what has run before: the report itself reads
    only the folders of its day.
    """
    metrics, facts = scratch_path(spark, "metrics"), scratch_path(spark, "facts")
    run_daily(_events(spark, folder), metrics, metrics=list(names), options=METRIC_OPTIONS)
    loaded = []
    for name in names:
        path = table_path(facts, name)
        write_days(warehouse.to_fact(name, read_metric(spark, metrics, name), exact), path)
        loaded.append(read_days(spark, path, REPORT_DAY))
    return loaded


def pages_top_time(spark, folder):
    (pages,) = _report_facts(spark, folder, "top_pages", exact=True)
    report = reports.top_pages_by_time(pages, REPORT_DAY)
    return report.withColumns(
        {c: F.col(c).cast("double") for c in ("avg_time_on_page", "p95_time_on_page")}
    )


def pages_top_bounce(spark, folder):
    (bounces,) = _report_facts(spark, folder, "bounce_rate")
    return reports.top_pages_by_bounce(bounces, REPORT_DAY)


def sessions_summary(spark, folder):
    segments, bounces = _report_facts(spark, folder, "device_country", "bounce_rate")
    report = reports.session_summary(segments, bounces, REPORT_DAY)
    return _rounded(report, "avg_time_on_page", "overall_bounce_rate")


def sessions_summary_filtered(spark, folder):
    segments, bounces = _report_facts(spark, folder, "device_country", "bounce_rate")
    report = reports.session_summary(
        segments, bounces, REPORT_DAY, country=" mx ", device="desktop"
    )
    return _rounded(report, "avg_time_on_page", "overall_bounce_rate")


def anomalies_ranked(spark, folder):
    (sessions,) = _report_facts(spark, folder, "anomalies")
    report = reports.ranked_anomalies(sessions, REPORT_DAY)
    return report.select("*", *[F.col("z_score")[f].alias(f"z_{f}") for f in anomaly.FEATURES]).drop(
        "z_score"
    )


# --- profile ----------------------------------------------------------------------
def event_type_counts(spark, folder):
    return profile.event_type_counts(_events(spark, folder))


def null_counts(spark, folder):
    return profile.page_view_nulls(_events(spark, folder))


def duplicate_ids(spark, folder):
    return profile.duplicate_ids(_events(spark, folder))


def _plain_metric(name):
    return lambda spark, folder: _metric(spark, folder, name)


_QUERIES = {
    "events_typed": events_typed,
    "day_guard": day_guard,
    "landing_round_trip": landing_round_trip,
    "landing_one_day": landing_one_day,
    "dedup": dedup,
    "impute_country": impute_country,
    "impute_device": impute_device,
    "impute_time": impute_time,
    "normalize_url": normalize_url,
    "normalize_country": normalize_country,
    "clean": clean,
    "top_pages": top_pages,
    "bounce_rate": _plain_metric("bounce_rate"),
    "funnel": _plain_metric("funnel"),
    "product_gap": _plain_metric("product_gap"),
    "nav_paths": _plain_metric("nav_paths"),
    "device_country": _plain_metric("device_country"),
    "session_features": _session_features,
    "zscore_flags": zscore_flags,
    "iqr_flags": iqr_flags,
    "anomalies": _plain_metric("anomalies"),
    "daily_batch": daily_batch,
    "output_check": output_check,
    "daily_without_events": daily_without_events,
    "pages_over_days": pages_over_days,
    "validate_verdicts": validate_verdicts,
    "valid_events": valid_events,
    "event_shape": event_shape,
    "quarantine_records": quarantine_records,
    "corrupt_files": corrupt_files,
    "ingest_summary": ingest_summary,
    "ingest_metrics": ingest_metrics,
    "metric_rollup_5m": metric_rollup_5m,
    "rollup_restarted": rollup_restarted,
    "arrival_ingest": arrival_ingest,
    "arrival_rejects": arrival_rejects,
    "arrival_whole_files": arrival_whole_files,
    "arrival_summary": arrival_summary,
    "arrival_retry": arrival_retry,
    "entity_validation": entity_validation,
    "dq_outcomes": dq_outcomes,
    "dq_outcomes_typed": dq_outcomes_typed,
    "constraint_outcomes": constraint_outcomes,
    "gate_results": gate_results,
    "load_all_metrics": load_all_metrics,
    "dq_outcomes_lineitem": dq_outcomes_lineitem,
    "dq_passing_rows": dq_passing_rows,
    "dq_failing_rows": dq_failing_rows,
    "unique_key_check": unique_key_check,
    "change_schema": change_schema,
    "referential_check": referential_check,
    "dim_date": dim_date,
    "dims_insert_absent": dims_insert_absent,
    "countries_insert_absent": countries_insert_absent,
    "device_dimension_use": device_dimension_use,
    "fact_load_append": fact_load_append,
    "fact_serial_ids": fact_serial_ids,
    "fact_load_replace_all": fact_load_replace_all,
    "fact_load_replace_day": fact_load_replace_day,
    "pages_top_time": pages_top_time,
    "pages_top_bounce": pages_top_bounce,
    "sessions_summary": sessions_summary,
    "sessions_summary_filtered": sessions_summary_filtered,
    "anomalies_ranked": anomalies_ranked,
    "event_type_counts": event_type_counts,
    "null_counts": null_counts,
    "duplicate_ids": duplicate_ids,
}


def _configured(query):
    return lambda spark, folder: query(configure(spark), folder)


def queries():
    """All queries by name; each applies the engine's session settings first."""
    return {name: _configured(query) for name, query in _QUERIES.items()}

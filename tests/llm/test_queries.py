"""The registered queries against their SQL, and the pipeline's stages."""

import math
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from footfall.llm import mixing, queries
from tools.check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    frame = queries.queries()[name](spark, FOLDER)
    result = db.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, result.fetchall())


def test_stages_keep_columns_and_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    ids = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        assert {r.doc_id for r in out.collect()} <= ids, name


def test_near_copies_equal_all_pairs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    runs, class_of = {}, {d.doc_id: d.doc_id for d in docs}
    assert len(class_of) == len(docs)
    for d in docs:
        words = re.findall("[0-9a-z\u0080-\U0010ffff]+", (d.text or "").lower())
        n = max(1, len(words) - 4) if words else 0
        runs[d.doc_id] = Counter(tuple(words[i : i + 5]) for i in range(n))
    df = Counter(run for found in runs.values() for run in found)
    idf = {run: 1 + math.log(len(docs) / n) / math.log(len(docs)) for run, n in df.items()}
    links = 0
    for i, a in runs.items():
        for j, b in runs.items():
            if i >= j or not a.keys() & b.keys():
                continue
            common = sum(min(n, b[run]) * idf[run] for run, n in a.items())
            either = sum(max(a[run], b[run]) * idf[run] for run in a.keys() | b.keys())
            if common >= 0.8 * either:
                links += 1
                low, high = sorted((class_of[i], class_of[j]))
                class_of = {k: low if c == high else c for k, c in class_of.items()}
    assert links
    found = queries.queries()["op3_near_dedup"](spark, FOLDER).collect()
    assert {r.doc_id: r.class_id for r in found} == class_of


def test_mixing_stage_tells_rows_apart_by_id_and_text(spark):
    rows = [(100, "w " * 40, "a"), (100, "v " * 3, "a"), (None, "u " * 5, "a"), (None, "t " * 9, "b")]
    rows += [(i, "x " * (i % 9 + 1), "ab"[i % 2]) for i in range(60)]
    docs = spark.createDataFrame(
        [(*r, 7, "x", "y") for r in rows], "doc_id long, text string, source string, c int, k string, s string"
    )
    out = corpus_pipeline.mix_sources(spark, docs, FOLDER)
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text, r.source) for r in out.collect())
    assert set(got) <= set(rows) and max(got.values()) <= 2
    for source in "ab":
        words = sum(len(t.split()) * n for (_, t, s), n in got.items() if s == source)
        size = sum(len(t.split()) for _, t, s in rows if s == source)
        assert words <= 2 * size + 40
    assert corpus_pipeline.mix_sources(spark, docs.limit(0), FOLDER).count() == 0


def test_mixing_stage_leaves_texts_where_they_are(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("w "), F.repeat(F.lit("x "), (F.col("id") % 9).cast("int"))).alias("text"),
        F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).alias("source"),
    )
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        out = corpus_pipeline.mix_sources(spark, docs, FOLDER)
        assert out.count() > 4000
        assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)


def test_mixing_stage_takes_what_the_mix_says(spark):
    rows = [(i, "x " * (i % 9), [None, "a", "b", "c"][i * i % 4]) for i in range(200)]
    rows += rows[:20]  # twice in a source: both as often as the one taken more
    shared = [(i, "x " * (i % 9), "d") for i in range(30, 60)]
    for given in (rows, rows + shared):  # in two sources: both as the one taken more
        docs = spark.createDataFrame(given, "doc_id long, text string, source string")
        hashed = docs.withColumn("row", F.sha2(F.concat(F.col("doc_id").cast("string"), F.lit("\n"), "text"), 256))
        most: Counter = Counter()
        for r in mixing.mix(hashed, id_col="row").collect():
            most[r.doc_id] = max(most[r.doc_id], r.copies)
        want: Counter = Counter()
        for r in hashed.collect():
            want[r.doc_id, r.text, r.source] += most[r.row]
        out = corpus_pipeline.mix_sources(spark, docs, FOLDER).collect()
        assert Counter(tuple(r) for r in out) == +want


def test_stages_take_columns_of_any_name(spark):
    rows = [(i, "one two three four five six " + "word " * (i % 4), "a", "b", 1, 2, 3, 4) for i in range(12)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, source string, lang string, k int, s int, r int, node int"
    )
    for stage in (corpus_pipeline.drop_exact_copies, corpus_pipeline.drop_near_copies):
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and 0 < out.count() <= 4

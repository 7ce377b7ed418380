"""A training corpus from ``documents``: filter, deduplicate, mix and encode.

Each stage takes the rows its predecessor kept and is written and read again as
Parquet. All but the last return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from footfall.llm.common import (
    SPACE, bound_batches, scratch_path, ship_package, stage, table, unused,
)

#: The toxicity model, and with it the rows that remain, has no SQL counterpart.
ORACLE_SQL = None


def _prepare(spark: SparkSession) -> None:
    """Ship the package, and bound the session's batches, as what a stage returns runs later."""
    ship_package(spark)
    bound_batches(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier does not call toxic."""
    _prepare(spark)
    return toxicity.clean_rows(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts; of rows that repeat its id, one."""
    _prepare(spark)
    text = F.sha2(F.encode(exact_dedup.normalised(F.col("text")), "UTF-8"), 256)
    k, t = unused(docs, "__kept_id"), unused(docs, "__kept_text")
    kept = exact_dedup.exact_duplicates(docs).filter("kept")
    kept = kept.select(F.col("doc_id").alias(k), F.col("text_sha256").alias(t))
    chosen = docs.join(
        kept.distinct(), F.col("doc_id").eqNullSafe(F.col(k)) & (text == F.col(t)), "left_semi"
    )
    repeated = kept.groupBy(k, t).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if repeated.isEmpty():
        return chosen
    return chosen.withColumn(t, text).dropDuplicates(["doc_id", t]).drop(t)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each class of near copies.

    Rows are told apart by id and text, so another text of a dropped id stays.
    """
    _prepare(spark)
    k, r = unused(docs, "__dropped_id"), unused(docs, "__dropped_row")
    dropped = near_dedup.near_classes(docs).filter("NOT kept")
    dropped = dropped.select(F.col("doc_id").alias(k), F.col("row").alias(r)).distinct()
    row = near_dedup.row_hash(F.col("doc_id"), F.col("text"))
    return docs.join(dropped, (F.col("doc_id") == F.col(k)) & (row == F.col(r)), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it; the row at a source's cut is rounded.

    Rows are told apart by id and text. A source takes all its rows for whole epochs and
    those up to its cut in the order of the mix once more, so rows only need their source's
    cut, and texts stay where they are.
    """
    _prepare(spark)
    row, times = unused(docs, "__row"), unused(docs, "__times")
    id_ = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    text = F.coalesce("text", F.lit(""))
    keyed = docs.withColumn(row, F.sha2(F.concat(id_, F.lit("\n"), text), 256))
    mixed = mixing.mix(keyed, id_col=row).select(
        "doc_id", "source", "mix_key", "copies", mixing.whole_epochs().alias("epochs")
    )
    mixed = stage(mixed, "mixed_rows")
    # rows of several sources that share id and text are all taken as the most taken one
    shared = mixed.groupBy("doc_id").agg(F.max("copies").alias("n"), *_ends("source"))
    if shared.filter("NOT least <=> most OR (nulls > 0 AND least IS NOT NULL)").isEmpty():
        s, e, c = (unused(docs, n) for n in ("__source", "__epochs", "__cut"))
        cuts = mixed.groupBy(F.col("source").alias(s)).agg(
            F.max("epochs").alias(e), F.max(F.when(F.expr("copies > epochs"), F.col("mix_key"))).alias(c)
        )
        more = F.coalesce(mixing.mix_key(F.col(row)) <= F.col(c), F.lit(False)).cast("int")
        taken = F.when(text.rlike(f"[^{SPACE}]"), F.col(e) + more).otherwise(0).cast("int")
        found = keyed.join(stage(cuts, "cuts"), F.col("source").eqNullSafe(F.col(s)))
    else:
        k, taken = unused(docs, "__taken_row"), F.col(unused(docs, "__taken"))
        most = shared.select(F.col("doc_id").alias(k), F.col("n").cast("int").alias(unused(docs, "__taken")))
        found = keyed.join(most, F.col(row) == F.col(k))
    return found.withColumn(times, F.explode(F.array_repeat(F.lit(1), taken))).select(*docs.columns)


def _ends(name: str) -> list[Column]:
    return [
        F.min(name).alias("least"), F.max(name).alias("most"),
        F.count_if(F.col(name).isNull()).alias("nulls"),
    ]


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text for every row."""
    _prepare(spark)
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"corpus_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

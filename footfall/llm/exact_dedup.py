"""Exact deduplication by 128-bit content hash, with the bytes of a group compared.

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import SPACE, stage


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]", "")


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    content_hash: Callable[[Column], Column] = md5_128,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they agree after all white space is deleted. Of equal
    texts the row with the most code points in its original text stays, of those
    the one with the smallest id (a null id comes last).

    Only ids, lengths and digests are shuffled by hash. The bytes are compared by
    a grouping on (hash, text): it combines inside map tasks, so a text that
    fills a third of the table leaves each task once. A hash with more than one
    text is a collision; its rows are then grouped by their text instead.

    * null text: counts as empty; all empty texts are one group.
    * repeated rows: each counts in group_size and has its own output row; rows
      that repeat the id that stays are all marked kept.
    * empty table: no rows. Other columns are ignored, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("raw"), normalised(F.col(text_col)).alias("norm")
    ).select("doc_id", F.length("raw").alias("len"), "norm", content_hash(F.col("norm")).alias("h"))
    narrow = stage(
        rows.select("doc_id", "len", "h", F.sha2(F.encode("norm", "UTF-8"), 256).alias("sha")),
        "hashes",
    )
    texts = rows.groupBy("h", "norm").agg(F.count(F.lit(1)))
    collided = stage(
        texts.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("h"),
        "collisions",
    )
    keyed = narrow.withColumn("variant", F.lit(None).cast("string"))
    if not collided.isEmpty():
        keyed = stage(_with_variants(rows, collided), "variants")
    groups = stage(
        keyed.groupBy("h", "variant")
        .agg(
            F.count(F.lit(1)).alias("group_size"),
            F.max(F.struct("len", (-F.col("doc_id")).alias("neg"))).alias("best"),
        )
        .filter("group_size > 1")
        .select(
            F.col("h").alias("gh"), F.col("variant").alias("gv"), "group_size",
            (-F.col("best.neg")).alias("keep_id"),
        ),
        "groups",
    )
    same = (F.col("h") == F.col("gh")) & F.col("variant").eqNullSafe(F.col("gv"))
    joined = keyed.join(groups, same, "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _with_variants(rows: DataFrame, collided: DataFrame) -> DataFrame:
    """The narrow rows; where a hash has several texts, ``variant`` holds the text itself."""
    hit = collided.withColumn("hit", F.lit(True))
    return rows.join(hit, "h", "left").select(
        "doc_id",
        "len",
        "h",
        F.sha2(F.encode("norm", "UTF-8"), 256).alias("sha"),
        F.when(F.col("hit"), F.col("norm")).alias("variant"),
    )

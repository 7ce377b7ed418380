"""Mixing sources to target weights: hash-random order, prefix sums, exact budgets.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import SPACE, running_sums, stage

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
#: The mix holds this share of all words.
SHARE = 1.5
#: No source gives more than this many times its words.
MOST_EPOCHS = 2
SEED = "mix-1"

_RANGE = 1 << 32


def word_count(text):
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACE}]+")).cast("long")


def mix_key(id_, seed: str = SEED):
    """The hash of seed and id by which a source's documents are ordered."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("-"))))


def whole_epochs():
    """How often a source's target holds all its words, from its columns."""
    epochs = F.floor(F.floor("target") / F.col("source_size"))
    return F.when(F.col("source_size") > 0, epochs).otherwise(0)


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most_epochs: int = MOST_EPOCHS,
) -> DataFrame:
    """``sizes(source, source_size, n)`` with each source's ``weight`` and ``target``.

    Sources are ranked by code point, null last, without gathering them in one
    task. A source whose part exceeds ``most_epochs`` times its size is held
    there and the excess is shared again by weight, until none is above. Only
    sums of the sources still open reach the driver in each round.
    """
    ranked = running_sums(
        sizes.select(
            F.col("source").isNull().cast("int").alias("last"),
            "source",
            "source_size",
            "n",
            F.lit(1).alias("one"),
        ),
        ["last", "source"],
        "one",
        "rank",
    )
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")
    )
    rows = stage(
        ranked.select("source", "source_size", "n", weight.alias("weight")), "source_weights"
    )
    size, w = F.col("source_size"), F.col("weight")
    total = (rows.agg(F.sum(size)).first()[0] or 0) * float(share)
    level, held = 0.0, F.lit(False)
    open_words, open_weight = total, rows.agg(F.sum(w)).first()[0]
    while open_weight:
        # a source stays held once it is: the level only rises
        over = (F.lit(open_words) * w / F.lit(open_weight)) > size * most_epochs
        kept = rows.agg(
            F.sum(F.when(over, size * most_epochs)), F.sum(F.when(~over, w)), F.count_if(over)
        ).first()
        level, before = (open_words, open_weight), (open_words, open_weight)
        open_words, open_weight = total - (kept[0] or 0), kept[1]
        held = over
        if (open_words, open_weight) == before:
            break
    words, weights_sum = level if level else (0.0, 1)
    share_of = F.lit(words) * w / F.lit(weights_sum)
    return rows.withColumn(
        "target", F.when(held, (size * most_epochs).cast("double")).otherwise(share_of)
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = SEED,
    **options,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken, copies, mix_key.

    ``taken`` counts words: whole epochs give every document that often, and in
    the last, partial epoch documents are read in the order of a hash of seed and
    id until the source's budget is used up; the document at the cut gives just
    the words that are left. ``copies`` rounds that document to whole ones.

    The order is cut into even ranges of the hash, about sqrt(n) rows each, so
    that a source with a third of all rows is summed by many tasks; totals of
    the ranges are summed per source.

    * null source: a source of its own, ranked last. Null text: size 0, taken 0.
    * repeated rows: equal ids share a hash; ties fall back to the size, so equal
      rows may swap places but give the same numbers.
    * no words at all, or an empty table: every target is 0, or there are no rows.
    * other columns are ignored, whatever their names.
    """
    rows = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            mix_key(F.col(id_col), seed).alias("mix_key"),
        ),
        "sizes",
    )
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")
    )
    targets = stage(source_targets(sizes, **options), "targets").select(
        F.col("source").alias("s"), "source_size", "n", "target"
    )
    joined = rows.join(targets, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    ranges = F.greatest(F.lit(1), F.ceil(2 * F.sqrt("n"))).cast("long")
    position = F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("long")
    ranged = stage(joined.withColumn("r", F.floor(position * ranges / _RANGE)), "ranged")
    before = Window.partitionBy("source").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ranged.groupBy("source", "r")
        .agg(F.sum("size").alias("words"))
        .select(
            F.col("source").alias("s"),
            F.col("r").alias("tr"),
            F.coalesce(F.sum("words").over(before), F.lit(0)).alias("shift"),
        )
    )
    totals = stage(totals, "range_shifts")
    inside = (
        Window.partitionBy("source", "r")
        .orderBy("mix_key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = ranged.withColumn("at", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        totals, F.col("source").eqNullSafe(F.col("s")) & (F.col("r") == F.col("tr"))
    )
    budget = F.floor("target")
    left = F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("at") - F.col("shift")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left))
    whole = ((F.col("size") > 0) & (F.col("part") * 2 >= F.col("size"))).cast("long")
    return (
        placed.withColumn("budget", budget)
        .withColumn("epochs", whole_epochs())
        .withColumn("part", part)
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"),
            F.when(F.col("size") > 0, F.col("epochs") + whole).otherwise(0).alias("copies"),
            "mix_key",
        )
    )

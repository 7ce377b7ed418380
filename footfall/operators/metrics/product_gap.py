"""Products that are viewed much and added to the cart little, per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.columns import is_event, ratio
from footfall.functions.groups import first_rows

COLUMNS = ("event_type", "dt", "product_id", "category", "action")


def product_gap(events: DataFrame, min_views: int = 50, top_n: int = 50) -> DataFrame:
    """The ``top_n`` products of each day by gap among those with ``min_views`` views.

    Adds belong to a product, views to a product and category: a product shown in
    two categories carries the same adds in both rows. Both sides are aggregated
    before they meet, so the join handles one row per product and day.
    """
    views = (
        events.filter(is_event("product_view"))
        .groupBy("dt", "product_id", "category")
        .agg(F.count(F.lit(1)).alias("views"))
        .filter(F.col("views") >= min_views)
    )
    adds = (
        events.filter(is_event("cart_event") & (F.col("action") == "add"))
        .groupBy("dt", "product_id")
        .agg(F.count(F.lit(1)).alias("cart_adds"))
    )
    share = F.try_divide(F.col("cart_adds").cast("double"), F.col("views").cast("double"))
    scored = (
        views.join(adds, ["dt", "product_id"], "left")
        .withColumn("cart_adds", F.coalesce("cart_adds", F.lit(0).cast("bigint")))
        .withColumn("conversion", ratio(F.col("cart_adds"), F.col("views")))
        .withColumn("gap_score", F.round(F.lit(1.0) - share, 4))
        .select("dt", "product_id", "category", "views", "cart_adds", "conversion", "gap_score")
    )
    order = [F.desc("gap_score"), F.desc("views"), F.asc("product_id"), F.asc("category")]
    return first_rows(scored, ["dt"], order, top_n)

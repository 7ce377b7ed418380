"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in ``links(a, b)``; component is the smallest id reached.

    Each round hooks every node to its smallest neighbour, follows those pointers
    twice, and contracts the links; a star ends in one round, a chain of n links
    in about log n. Nothing is collected: the driver only learns whether links
    are left. Every round is a staged frame, so lost executors cost one round.
    """
    links = stage(links.filter("a <> b").select("a", "b").distinct(), "links")
    ids = links.select(F.col("a").alias("id")).union(links.select("b")).distinct()
    labels = stage(ids.select("id", F.col("id").alias("component")), "labels")
    while not links.isEmpty():
        both = links.union(links.select(F.col("b"), F.col("a")))
        hook = stage(
            both.groupBy(F.col("a").alias("node"))
            .agg(F.min("b").alias("near"))
            .select("node", F.least("node", "near").alias("up")),
            "hooks",
        )
        for _ in range(2):
            over = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
            hook = hook.join(over, "up").select("node", F.col("top").alias("up"))
        hook = stage(hook, "hooks")
        to_a = hook.select(F.col("node").alias("a"), F.col("up").alias("ca"))
        to_b = hook.select(F.col("node").alias("b"), F.col("up").alias("cb"))
        links = stage(
            links.join(to_a, "a")
            .join(to_b, "b")
            .filter("ca <> cb")
            .select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"))
            .distinct(),
            "links",
        )
        moved = hook.select(F.col("node").alias("component"), F.col("up").alias("top"))
        labels = stage(
            labels.join(moved, "component", "left").select(
                "id", F.coalesce("top", "component").alias("component")
            ),
            "labels",
        )
    return labels

"""Connected components of a graph given by its links, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.tables import written

MOST_ROUNDS = 100


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it is linked with, directly or not).

    ``links`` has two bigint columns; order, repeats and links of a node to itself don't
    matter, rows with a null are left out. A node without links, and a root, has no row.

    Each round hangs every node's larger neighbours on its smallest neighbour and then
    its smaller neighbours likewise, so that paths shrink by about half and no node's
    neighbours are ever gathered in one place: a round is minima by node, combined
    before the shuffle, and joins whose skewed keys Spark splits. Every round is a
    written table. Once no node hangs on two, what is left are trees with their smallest
    node on top, and each node is hung on what its own holds on to until none moves.
    """
    a, b = links.columns
    now = (
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u > v")
        .distinct()
    )
    for _ in range(MOST_ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        larger = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(smaller.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
        if now.groupBy("u").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] in (None, 1):
            return _flat(now)
    raise RuntimeError(f"components not found in {MOST_ROUNDS} rounds")


def _flat(trees: DataFrame) -> DataFrame:
    """``node`` and ``root`` from the trees' (u, v), where each node u hangs on one v."""
    for _ in range(MOST_ROUNDS):
        above = trees.select(F.col("u").alias("up"), F.col("v").alias("next"))
        moved = trees.join(above, F.col("v") == F.col("up"), "left")
        trees = written(
            moved.select("u", F.coalesce("next", "v").alias("v"), F.col("next").isNotNull().alias("moved")), "links"
        )
        if not trees.agg(F.bool_or("moved")).first()[0]:
            return trees.select(F.col("u").alias("node"), F.col("v").alias("root"))
        trees = trees.drop("moved")
    raise RuntimeError(f"roots not found in {MOST_ROUNDS} rounds")

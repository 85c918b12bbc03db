"""From buckets of possible partners to components of verified links.

No step pairs all nodes of a large bucket. Small buckets give their pairs; in a larger one
each node is paired with one hub, which joins a large group of nodes that are alike at
the price of a pair a node. Buckets whose nodes are then still in several components are
settled at once if the nodes outside the main component are few (see below); the others hold
nodes that share what is common (a passage in many texts) and may differ elsewhere; those
nodes are dealt again by what is rare in them (``rarest``), which loses no link. In a large
bucket that this still leaves open, the nodes outside its main component are held against
all of its nodes, and only pairs whose sizes and dense sketches allow a link are made.

A dense sketch is the parity of a set's members at each of some hundred places, so two
sketches differ in no more bits than their sets in members.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm import text
from brindle.llm.components import components
from brindle.llm.tables import written

# Nodes up to which a bucket gives all its pairs at once.
FEW = 16
# Pairs up to which an open bucket is settled by its strays before nodes are dealt again.
SETTLED = 1 << 17
BITS = 1024


def shared_buckets(placed: DataFrame) -> DataFrame:
    """(bucket, node, n_nodes, hub) of the buckets with more than one node.

    ``placed`` has bigint ``bucket`` and ``node``; repeats make no other pairs, but decide on
    the ``hub``, the node with the most rows (then the largest): what is copied most is the
    likeliest to be what the others are variants of. One exchange deals the rows by
    bucket, where a bucket with two nodes or more is told by its least and largest; only
    the rows of those, a small part, are counted. A bucket's rows spill if they are many.
    """
    of_bucket = Window.partitionBy("bucket")
    ends = {"least": F.min("node").over(of_bucket), "largest": F.max("node").over(of_bucket)}
    apart = placed.withColumns(ends).where("least < largest")
    nodes = apart.groupBy("bucket", "node").agg(F.count("*").alias("copies"))
    counted = nodes.withColumns({"n_nodes": F.count("*").over(of_bucket), "top": F.max(F.struct("copies", "node")).over(of_bucket)})
    return written(counted.select("bucket", "node", "n_nodes", F.col("top.node").alias("hub")), "buckets")


def rarest(members: DataFrame, percent: int) -> DataFrame:
    """(bucket, node): sets that have ``percent`` of their union in common meet in a bucket.

    ``members`` has ``node``, the set's size ``n`` and its ``member``, a row each. All sets order
    their members by how many of the sets have them, rarest first. Of two such sets each
    has the first member they have in common within its first ``n - percent * n / 100 + 1``,
    so those are the buckets, less the members that no other set has.
    """
    times = members.groupBy("member").agg(F.count("*").alias("times"))
    in_order = Window.partitionBy("node").orderBy("times", "member")
    placed = members.join(times, "member").withColumn("place", F.row_number().over(in_order))
    need = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    return placed.where((F.col("place") <= need) & (F.col("times") > 1)).select(F.col("member").alias("bucket"), "node")


def dense_sketch(members: np.ndarray, bits: int = BITS) -> list[int]:
    """Parity of the members at each of ``bits`` places, as signed 64-bit numbers."""
    place = (text.mix(members + np.uint64(0x452821E638D01377)) % np.uint64(bits)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=bits) & 1).astype(bool)).view(np.int64).tolist()


def may_link(a: str, b: str, percent: int) -> Column:
    """Whether sizes ``n`` and sketches of both ends (columns with these prefixes) allow
    ``percent`` of their union to be common."""
    n_a, n_b = F.col(f"{a}n"), F.col(f"{b}n")
    distance = F.aggregate(
        F.zip_with(f"{a}sketch", f"{b}sketch", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda total, bits: total + bits,
    )
    alike = F.greatest(n_a, n_b) * percent <= F.least(n_a, n_b) * 100
    return alike & (distance * (100 + percent) <= (100 - percent) * (n_a + n_b))


def _ordered(one: str, other: str) -> tuple:
    return F.least(one, other).alias("a"), F.greatest(one, other).alias("b")


def _small_and_star(shared: DataFrame) -> DataFrame:
    """The pairs (a, b) of small buckets, and those with the hub of larger ones."""
    small = shared.where(F.col("n_nodes") <= FEW).select("bucket", "node")
    few = small.join(small.withColumnRenamed("node", "other_node"), "bucket").where("node < other_node")
    few = few.select(*_ordered("node", "other_node"))
    star = shared.where((F.col("n_nodes") > FEW) & (F.col("node") != F.col("hub"))).select(*_ordered("hub", "node"))
    return few.unionByName(star).distinct()


def _open(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """(bucket, node, root) of the buckets whose nodes are in several components."""
    rooted = rows.select("bucket", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = rooted.groupBy("bucket").agg((F.min("root") != F.max("root")).alias("apart")).where("apart")
    return written(rooted.join(split, "bucket", "left_semi").select("bucket", "node", "root"), "open-buckets")


def _soon_settled(opened: DataFrame) -> DataFrame:
    """(bucket) of the open buckets whose nodes outside the largest component make few pairs
    with all of its nodes."""
    sizes = opened.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    of_bucket = sizes.groupBy("bucket").agg(F.sum("n").alias("n"), F.max("n").alias("main"))
    return written(of_bucket.where(F.col("n") * (F.col("n") - F.col("main")) <= SETTLED).select("bucket"), "settled-buckets")


def _strays(opened: DataFrame, traits: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes outside an open bucket's largest component with all its
    nodes of other components, if their traits allow a link."""
    sizes = opened.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("main")).select("bucket", F.col("main.root").alias("main"))
    known = traits.join(opened.select("node").distinct(), "node", "left_semi")
    rows = written(opened.join(main, "bucket").join(known, "node"), "open-nodes")
    stray = rows.where("root != main").drop("main")
    stray = stray.select("bucket", *[F.col(c).alias(f"other_{c}") for c in stray.columns if c != "bucket"])
    met = rows.join(stray, "bucket").where((F.col("root") != F.col("other_root")) & may_link("", "other_", percent))
    return met.select(*_ordered("node", "other_node")).distinct()


def linked(
    shared: DataFrame,
    contents: Callable[[DataFrame], DataFrame],
    verify: Callable[[DataFrame], DataFrame],
    members: Callable[[DataFrame], DataFrame],
    percent: int,
    traits: DataFrame | None = None,
    rough: Callable[[DataFrame], DataFrame] | None = None,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """(node, root) of the components of all verified pairs that share a bucket.

    ``contents`` gives ``node`` and ``content`` of the nodes in a column; ``verify`` keeps the
    rows (a, b, content_a, content_b) that link, which takes ``percent`` of their members'
    union in common; ``members`` gives the rows (node, n, member) of contents. ``traits``
    (node, n, sketch), if known beforehand, drop pairs before contents are read; else
    ``rough`` gives such rows of contents, which drop pairs before they are verified. The
    strays of open buckets and the pairs of nodes that are dealt again are verified at once.
    ``pairs`` (a, b), if some that cannot link are known beforehand, are the others of small
    buckets and with hubs; ``shared`` then needs the nodes of large buckets only.

    A pair that could join two components is left unverified only if both its nodes were
    dealt again and did not meet there, or their traits speak against it: it cannot link.
    """

    def loaded(nodes: DataFrame) -> DataFrame:
        return written(contents(nodes), "contents")

    def verified(pairs: DataFrame, full: DataFrame) -> DataFrame:
        a = full.select(F.col("node").alias("a"), F.col("content").alias("content_a"))
        b = full.select(F.col("node").alias("b"), F.col("content").alias("content_b"))
        both = pairs.join(a, "a").join(b, "b").select("a", "b", "content_a", "content_b")
        return written(verify(both).select("a", "b"), "links")

    def considered(pairs: DataFrame, of_nodes: DataFrame) -> DataFrame:
        """The pairs of a written table that the nodes' traits allow."""
        known = of_nodes.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi")
        ends = [known.select(*[F.col(c).alias(x if c == "node" else f"{x}_{c}") for c in known.columns]) for x in "ab"]
        likely = pairs.join(ends[0], "a").join(ends[1], "b").where(may_link("a_", "b_", percent)).select("a", "b")
        return written(likely, "likely-pairs")

    def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
        """The components that the links make of those known."""
        if links.isEmpty():
            return roots
        return components(roots.toDF("a", "b").unionByName(links))

    nodes = None if pairs is None else shared.where(F.col("n_nodes") > FEW).select("node")
    pairs = written(_small_and_star(shared) if pairs is None else pairs, "pairs")
    if traits is not None:
        pairs = considered(pairs, traits)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    full = loaded((ends if nodes is None else ends.unionByName(nodes)).distinct())
    if rough is not None:
        known = written(rough(full), "traits")
        pairs = considered(pairs, known)
    # the partner that is met most often, as hubs are
    often = pairs.select(F.explode(F.array("a", "b")).alias("a")).groupBy("a").agg(F.count("*").alias("n"))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(often, "a")
    best = both.groupBy("b").agg(F.max(F.struct("n", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")

    nearest = verified(best, full)
    hung = nearest.select(F.col("b").alias("node"), F.col("a").alias("root"))
    roots = components(nearest.unionByName(verified(_across(pairs, hung), full)))

    opened = _open(shared.where(F.col("n_nodes") > FEW), roots)
    if opened.isEmpty():
        return roots
    hard, met = opened, None
    if rough is not None:  # all nodes of large buckets are then known
        settled, traits = _soon_settled(opened), known
        met = _strays(opened.join(settled, "bucket", "left_semi"), traits, percent)
        hard = opened.join(settled, "bucket", "left_anti")
    active = written(hard.select("node").distinct(), "open-nodes")
    if active.isEmpty():
        return merged(roots, verified(met, full))
    if rough is None:
        full = chosen = loaded(active)
    else:
        chosen = full.join(active, "node", "left_semi")
    shared = shared_buckets(rarest(members(chosen), percent))
    again = considered(written(_across(_small_and_star(shared), roots), "pairs"), traits)
    roots = merged(roots, verified(again if met is None else again.unionByName(met).distinct(), full))
    opened = _open(shared.where(F.col("n_nodes") > FEW), roots)
    if opened.isEmpty():
        return roots
    return merged(roots, verified(_strays(opened, traits, percent), full))


def _across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends do not have one root; a node without one is its own.

    Also those between a node and its own root are left out, whatever the root hangs on.
    """
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    known = pairs.join(a, "a", "left").join(b, "b", "left")
    one = (F.coalesce("root_a", "a") == F.coalesce("root_b", "b")) | F.coalesce(F.col("root_a") == F.col("b"), F.lit(False))
    return known.where(~(one | F.coalesce(F.col("root_b") == F.col("a"), F.lit(False)))).select("a", "b")

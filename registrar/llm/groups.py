"""Groups of rows that meet in buckets, and connected components; used by the joins on pairs."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import cut_lineage

#: A group of candidates that is compared in one task has about so many rows and items (n-grams) at most.
GROUP_ROWS = 512
GROUP_ITEMS = 1_000_000


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b): the least node of its connected component.

    Each round hangs every neighbour of a node that is greater than it, then
    every neighbour that is less, on the node's least neighbour; both are
    aggregates with a map-side combine and one join, and never add edges. It
    ends when every component is a star. A round's edges are written to the
    checkpoint folder; only whether they are stars comes to the driver.
    Hot nodes are joined on, where adaptive execution splits them. No edges
    give no rows; edges of a node with itself and nulls are ignored.
    """
    named = edges.toDF("a", "b").filter("a != b")
    stars = cut_lineage(named.select(F.greatest("a", "b").alias("big"), F.least("a", "b").alias("small")).distinct())
    while not _are_stars(stars):
        _release(stars)
        both = stars.union(stars.select("small", "big")).toDF("at", "other")
        least = both.groupBy("at").agg(F.least(F.col("at"), F.min("other")).alias("low"))
        hung = both.filter("other > at").join(least, "at").select(F.col("other").alias("big"), F.col("low").alias("small"))
        root = hung.groupBy("big").agg(F.min("small").alias("low"))
        moved = hung.join(root, "big").filter("small != low").select(F.col("small").alias("big"), F.col("low").alias("small"))
        stars = cut_lineage(moved.union(root.select("big", F.col("low").alias("small"))).distinct())
    roots = stars.select("small").distinct().select(F.col("small").alias("node"), F.col("small").alias("label"))
    return stars.select(F.col("big").alias("node"), F.col("small").alias("label")).union(roots)


def _release(df: DataFrame) -> None:
    """Let Spark delete the shuffle files of earlier rounds now: it does when the driver's JVM collects their plans."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other at most, and none that does has a node hanging on it."""
    ends = edges.select(F.col("big").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
        edges.select("small", F.lit(0), F.lit(1))
    )
    each = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return each.filter("hangs > 1 OR (hangs = 1 AND holds = 1)").isEmpty()


def met(members: DataFrame) -> DataFrame:
    """(bucket, node, size, low, count, items) of members (node, size, bucket) that meet another one.

    Buckets with the same members count once; ``low`` is the bucket's least
    node, ``count`` and ``items`` are the bucket's rows and their sizes' sum.
    """
    buckets = (
        members.groupBy("bucket")
        .agg(
            F.count("*").alias("count"), F.sum("size").alias("items"), F.min("node").alias("low"),
            F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
        )
        .filter("count > 1")
        .groupBy("count", "low", "x", "y")
        .agg(F.min("bucket").alias("bucket"), F.first("items").alias("items"))
        .select("bucket", "low", "count", "items")
    )
    return cut_lineage(members.join(buckets, "bucket"))


def candidate_groups(placed: DataFrame) -> DataFrame:
    """Which nodes are compared where: node, label, buckets, units (of ``met`` rows).

    Nodes that buckets connect form a cluster. ``units`` says in which groups,
    and how many blocks of bounded size each of them has: the cluster as a
    whole, or, where that sends fewer rows (a large cluster of small buckets),
    each of the node's buckets. ``buckets`` lists the node's buckets: a pair
    counts if it shares one, at every size of the cluster.
    """
    labels = components(placed.filter("node != low").select("node", "low").distinct())
    blocks = F.ceil(F.greatest(F.col("count") / GROUP_ROWS, F.col("items") / GROUP_ITEMS)).cast("int")
    by_node = (
        placed.withColumn("blocks", blocks)
        .groupBy("node")
        .agg(
            F.first("size").alias("size"), F.sum("blocks").alias("cost"),
            F.array_sort(F.collect_list(F.struct("bucket", "blocks"))).alias("buckets"),  # at most one for each band
        )
        .join(labels, "node")
    )
    sized = by_node.groupBy("label").agg(F.count("*").alias("rows"), F.sum("size").alias("items"), F.sum("cost").alias("costs"))
    all_blocks = F.ceil(F.greatest(F.col("rows") / GROUP_ROWS, F.col("items") / GROUP_ITEMS)).cast("int")
    sized = sized.select("label", all_blocks.alias("blocks"), (F.col("rows") * all_blocks <= F.col("costs")).alias("whole"))
    one = F.array(F.struct(F.lit(None).cast("long").alias("bucket"), F.col("blocks")))
    return by_node.join(sized, "label").select(
        "node", "label", F.transform("buckets", lambda x: x.bucket).alias("buckets"),
        F.when(F.col("whole"), one).otherwise(F.col("buckets")).alias("units"),
    )


def in_blocks(rows: DataFrame) -> DataFrame:
    """Rows of ``candidate_groups`` (and any further columns) for each group to compare, by block pairs.

    Adds group, bucket (null where the group is a whole cluster), side (0 or 1) and
    crossed (the two sides are different blocks: links inside a side are met
    in the group of that block with itself).
    """
    each = rows.withColumn("unit", F.explode("units")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("unit.blocks")))
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("unit.blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return each.select(
        F.concat_ws("/", F.coalesce(F.col("unit.bucket").cast("string"), F.hex("label")), low, high).alias("group"),
        F.col("unit.bucket").alias("bucket"),
        F.when(F.col("block") == low, 0).otherwise(1).alias("side"),
        (low != high).alias("crossed"),
        *[c for c in rows.columns if c != "units"],
    )

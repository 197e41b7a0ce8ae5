"""Linking the members of lists block by block, and connected components of a link table."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a``, ``b``, both long), where component
    is the smallest node that links lead to.

    Each round hangs the larger neighbours of a node below its smallest one (large star), then the
    smaller ones (small star), and stores the links; after O(log^2) rounds, in practice few, every
    component is one star. Minima combine before their shuffle; the joins are of a link with one
    row per node, so Spark can split a node with many links. Only a row count and a checksum come
    to the driver. Loops, repeated links and nulls are ignored; no links give an empty table.
    """
    links = stored(_ordered(edges.select("a", "b")), "links")
    before = None
    while True:
        state = links.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("big", "small").cast("decimal(38,0)"))
        ).first()
        if state == before or not state["n"]:
            break
        before = state
        links = stored(_small_star(_large_star(links)), "links")
    roots = links.select(F.col("small").alias("node")).distinct()
    return links.selectExpr("big AS node", "small AS component").unionByName(
        roots.withColumn("component", F.col("node"))
    )


def _ordered(edges: DataFrame) -> DataFrame:
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("big"), F.least("a", "b").alias("small"))
        .distinct()
    )


def _large_star(links: DataFrame) -> DataFrame:
    """Each link's larger end goes below the smallest neighbour of its smaller end."""
    least = (
        links.selectExpr("small", "small AS near")
        .unionByName(links.selectExpr("big AS small", "small AS near"))
        .groupBy("small")
        .agg(F.min("near").alias("least"))
    )
    # Stored, so that the join is between two shuffles and a node with many links can be split.
    least = stored(least, "least")
    return links.join(least, "small").selectExpr("big", "least AS small").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go below the smallest of them."""
    least = stored(links.groupBy("big").agg(F.min("small").alias("least")), "least")
    moved = links.join(least, "big").where("small <> least").selectExpr("small AS big", "least")
    return moved.unionByName(least).selectExpr("big", "least AS small").distinct()


def in_blocks(listed: DataFrame, keys: list[str], member: str, size: int) -> DataFrame:
    """Rows of lists (named by ``keys``) dealt so that any two rows of a list meet in some
    ``keys, lo, hi`` group of about ``2 * size`` rows at most, sorted by these columns. ``block`` is
    the row's own block, ``lo`` and ``hi`` the two that meet.

    Lists of one row go before anything is gathered. A longer list is cut into blocks by a hash of
    ``member``, and each pair of blocks is a group: a hot list becomes many tasks.
    """
    sizes = listed.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    dealt = (
        listed.join(sizes, keys)
        .withColumn("blocks", F.expr(f"CAST(ceil(n / {size}) AS INT)"))
        .withColumn("block", F.expr(f"CAST(pmod(xxhash64({member}), blocks) AS INT)"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumn("lo", F.least("block", "other"))
        .withColumn("hi", F.greatest("block", "other"))
        .drop("n", "blocks", "other")
    )
    group = [*keys, "lo", "hi"]
    return dealt.repartition(*group).sortWithinPartitions(*group)


def spanning(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Child and parent row numbers of a forest that spans the links of a boolean matrix."""
    parent = np.full(len(near), -1)
    seen = np.zeros(len(near), dtype=bool)
    for root in range(len(near)):
        if seen[root]:
            continue
        seen[root] = True
        front = np.array([root])
        while len(front):
            reach = near[front] & ~seen
            fresh = np.flatnonzero(reach.any(axis=0))
            parent[fresh] = front[reach[:, fresh].argmax(axis=0)]
            seen[fresh] = True
            front = fresh
    child = np.flatnonzero(parent >= 0)
    return child, parent[child]

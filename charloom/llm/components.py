"""Connected components of a table of links, by alternating star contraction.

Every round points each node's larger neighbours at its smallest one, then each
node's smaller neighbours too (large-star, small-star); the links end as stars
around the smallest member of each component.  Rounds are joins and
aggregations over the links alone, cut by checkpoints; only a row count and a
checksum reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from charloom.llm.common import cut


def _both(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v"), F.col("u")))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step; links are (u, v), u > v on the way out."""
    pairs = _both(links) if large else links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = pairs.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).withColumn("m", F.least("m", "node"))
    joined = pairs.join(low, F.col("u") == F.col("node"))
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select(F.col("node").alias("u"), F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node that has a link (columns ``u``, ``v`` of any
    one ordered type; null ends are no links); ``root`` is the smallest member."""
    kind = links.schema["u"].dataType
    links = cut(links.filter("u is not null and v is not null and u <> v")
                .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        state = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == before or state["n"] == 0:
            break
        before = state
        links = cut(_star(_star(links, True), False))
    else:
        raise RuntimeError("components: no fixed point")
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()).select(
        F.col("node").cast(kind).alias("node"), F.col("root").cast(kind).alias("root"))


def spanning_links(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` per local node 0..n-1 under links ``a``-``b``: the smallest index it
    reaches.  Vectorised label propagation with pointer jumping."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            jumped = root[root]
            if (jumped == root).all():
                break
            root = jumped
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root

"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintero.session import materialize


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(u, v)``; the root is the smallest node reached.

    Every round stores its links in the shared folder; the number of rounds
    grows with the logarithm of the component size.  Sums and minima combine
    before the shuffle; a node with very many links is split by the join.
    """
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = materialize(links.where("u <> v").distinct(), "links")
    before = _signature(links)
    while before[0]:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.union(least.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        large = materialize(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = moved.union(least.select("u", F.col("m").alias("v"))).distinct()
        links = materialize(links, "small-star")
        after = _signature(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)

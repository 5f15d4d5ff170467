"""Connected components of link tables, without ever holding one component in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tourledger.llm.common import cut


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The least vertex (``root``) of every vertex (``v``) that is in a link and is not itself the
    least of its component.

    Stars alternate until nothing changes: every vertex hands its greater neighbours, then
    its smaller ones, to the least vertex it knows. Each step is a grouping and a join on
    the vertex; a vertex with very many links is split at run time.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    edges = cut(links.where(F.col(a) != F.col(b)).select(high.alias("v"), low.alias("root")).distinct())
    before = None
    while True:
        both = edges.select(F.col("v").alias("u"), F.col("root").alias("n")).union(edges.select("root", "v"))
        least = both.groupBy("u").agg(F.min("n").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("n > u").select(F.col("n").alias("v"), F.col("m").alias("root")).distinct()
        least = large.groupBy("v").agg(F.min("root").alias("m"))
        small = large.join(least, "v")
        small = small.select("v", F.col("m").alias("root")).union(small.where("root != m").select("root", "m"))
        edges = cut(small.distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "root").cast("decimal(38,0)"))).first()
        if now == before:
            return edges
        before = now

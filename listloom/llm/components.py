"""Connected components of links that may be too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listloom.llm.common import shared_folder, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a link: root is the smallest node that can be reached, the node itself included.

    Alternates large-star and small-star rounds: each connects a node's larger (or smaller) neighbours to its smallest
    one, until the links are stars around the roots. A round writes its links to the shared folder, so lineage stays short
    and a lost executor costs one round at most. Smallest neighbours are aggregated before the shuffle and stored before
    they are joined, so that a hub with a large share of all links can be split by the adaptive join. Links with a null end
    are no links; a table without links gives no rows.
    """
    folder = shared_folder(links.sparkSession)
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    pairs, before, k = stored(pairs, f"{folder}/links"), None, 0
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{folder}/large-{k}")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, f"{folder}/larger-{k}")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), f"{folder}/small-{k}")
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p"))
        pairs = stored(small.select("p.u", "p.v").where("u <> v").distinct(), f"{folder}/links-{k}")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, k = now, k + 1
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

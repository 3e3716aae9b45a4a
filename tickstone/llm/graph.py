"""Connected components of link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickstone.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Alternating star contraction: each node hands its larger neighbours (first step), then its smaller ones and
    itself (second step) to its smallest neighbour, until nothing changes.  A link table grows in no step, a step is
    one exchange with plain minima, and rounds are logarithmic in the longest path.  Each round's links are
    written to the shared folder, so no lineage builds up.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = written(pairs, "links")
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select("a", F.least("a", "low").alias("low"))
        big = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        # links of a node to larger neighbours are replaced; a node without smaller neighbours keeps them
        big = big.distinct()
        low = big.groupBy("a").agg(F.min("b").alias("low"))
        joined = big.join(low, "a")
        small = joined.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.union(low.select("a", F.col("low").alias("b"))).where("a <> b")
        pairs = written(small.distinct(), "links")
        # sum of the lower ends: falls until every node hangs on its component's smallest
        state = tuple(pairs.agg(F.count("*"), F.sum(F.col("b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == before:
            break
        before = state
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )

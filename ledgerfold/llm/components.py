"""Connected components of a link table by minimum labels and shortcuts.

Every round a node takes the least label among itself and its neighbours, then
the label of its label. Minima are combined map-side, so a node with very many
links costs no more than its rows; joins on a label that many nodes share are
left to the adaptive skew handling. Nothing reaches the driver but a count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import settled


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """``node, component`` (the least node reachable) for every node that has a link."""
    one = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    # each edge is kept once, from its larger to its smaller end; contracted to roots every round
    edges = settled(one.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    labels = settled(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node")))
    for _ in range(rounds):
        if edges.isEmpty():
            break
        # hook: every root points at its least neighbouring root
        parent = settled(edges.groupBy("a").agg(F.min("b").alias("b")))
        # shortcut: follow the pointers to the end (they only ever lead to smaller nodes)
        while True:
            up = parent.select(F.col("a").alias("b"), F.col("b").alias("top"))
            longer = settled(parent.join(up, "b", "left").select("a", F.coalesce("top", "b").alias("b"), F.col("top").isNotNull().alias("moved")))
            parent = longer.select("a", "b")
            if longer.where("moved").isEmpty():
                break
        top = parent.select(F.col("a").alias("component"), F.col("b").alias("top"))
        labels = settled(labels.join(top, "component", "left").select("node", F.coalesce("top", "component").alias("component")))
        for end in ("a", "b"):
            edges = edges.join(parent.select(F.col("a").alias(end), F.col("b").alias("root")), end, "left").select(F.coalesce("root", end).alias(end), "b" if end == "a" else "a")
        edges = settled(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    else:
        raise RuntimeError(f"components didn't settle in {rounds} rounds")
    return labels

"""Connected components of a graph of links, without bringing any of it to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.shared import scratch


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, comp: comp is the least node that links of (a, b) connect it with. Each round takes the least label among
    neighbours and then the label of that label; a round is written to the scratch folder, and the last changes none.
    A node with very many links costs no task more than others: minima are combined before they are shuffled, and the
    join that brings labels to links has one row a node on its other side, so its hot keys can be split."""
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    both = scratch(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = scratch(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("m"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("up"))
        jump = labels.select(F.col("node").alias("up"), F.col("comp").alias("top"))
        labels = scratch(step.join(jump, "up").select("node", F.least("up", "top").alias("comp"), (F.least("up", "top") != F.col("old")).alias("moved")), "labels")
        if not labels.where("moved").head(1):
            return labels.select("node", "comp")

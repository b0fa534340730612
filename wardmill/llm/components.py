"""Connected components as joins: smallest label of the neighbours, then labels of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardmill.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(a, b) links to (node, label), the label being the smallest node that can be reached.

    Every round replaces a node's label by the smallest label next to it and then by that label's own
    label, so that chains halve. The state of a round is a stored table: no lineage grows, and the
    joins read both sides afresh, which lets Spark split a node with very many links.
    """
    edges = stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")))
    total = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
    while total is not None:
        near = (
            edges.join(labels, edges["b"] == labels["node"]).groupBy(F.col("a").alias("n")).agg(F.min("label").alias("l"))
        )
        low = labels.join(near, F.col("node") == F.col("n")).select("node", F.least("label", "l").alias("label"))
        low = stored(low)
        up = low.select(F.col("node").alias("n"), F.col("label").alias("l"))
        labels = stored(
            low.join(up, low["label"] == up["n"]).select("node", F.least("label", "l").alias("label"))
        )
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if now == total:
            break
        total = now
    return labels

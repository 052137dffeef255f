"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.llm.common import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node
    that links lead to, itself included.

    Every round a node takes the smallest label among its neighbours, then the
    label of that label, so long chains shorten quickly.  Each round is written
    to the shared folder.  Nothing is collected but one count a round.  A node
    with very many links costs no single task: the minimum is combined before
    the shuffle, and the joins read written tables on both sides, so adaptive
    execution can split them."""
    links = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = materialise(both.filter("a is not null and b is not null").distinct(), "links")
    labels = materialise(near.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                         .select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        heard = (near.join(labels.withColumnRenamed("node", "b"), "b")
                 .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard")))
        own = labels.join(heard, "node").select("node", "label", F.least("label", "heard").alias("new"))
        further = labels.select(F.col("node").alias("new"), F.col("label").alias("further"))
        following = materialise(
            own.join(further, "new", "left")
            .select("node", F.least("new", F.coalesce("further", "new")).alias("label"),
                    F.col("label").alias("before")), "labels")
        changed = following.filter("label <> before").count()
        labels = following.select("node", "label")
        if not changed:
            return labels.select("node", F.col("label").alias("component"))

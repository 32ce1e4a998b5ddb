"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import attach_groups, forget, saved


def components(links: DataFrame) -> DataFrame:
    """(v, c): each end of ``links`` (a, b) with the smallest end that it reaches.

    Every round takes the least label among a node and its neighbours, then the label's own label, so that long chains
    take a logarithmic number of rounds.  Nodes with many links, and labels with many nodes, are split by salts.  Labels are written to the
    shared folder each round and the last round's deleted; only counts reach the driver.
    """
    both = saved(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().withColumnRenamed("a", "uid"), "links")
    n_links = both.count()
    labels = saved(both.groupBy(F.col("uid").alias("v")).agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).select("v", F.least("v", "m").alias("c"), "n"), "labels")
    n_nodes = labels.count()
    while True:
        known = labels.select(F.col("v").alias("b"), "c", "n")
        near = attach_groups(both, known, "b", "n", n_links, how="inner").groupBy(F.col("uid").alias("v")).agg(F.min("c").alias("m"))
        low = saved(labels.join(near, "v", "left").select(F.col("v").alias("uid"), "c", "n", F.least("c", F.coalesce("m", "c")).alias("l")), "labels")
        used = low.groupBy("l").agg(F.count(F.lit(1)).alias("n_l"))
        far = labels.select(F.col("v").alias("l"), F.col("c").alias("f")).join(used, "l")
        step = saved(attach_groups(low, far, "l", "n_l", n_nodes).select(F.col("uid").alias("v"), F.least("l", F.coalesce("f", "l")).alias("to"), "c", "n"), "labels")
        forget(labels, low)
        if step.filter("to < c").isEmpty():
            forget(both)
            return step.select("v", F.col("to").alias("c"))
        labels = step.select("v", F.col("to").alias("c"), "n")
        labels.scratch = step.scratch

"""Connected components of a graph given as a table of edges, by minimum labels and pointer jumping."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens import session


def components(edges: DataFrame) -> DataFrame:
    """Smallest node that each node reaches: node, label; from columns a, b (long). Nodes without edges are not shown.

    Each round takes the smallest label among a node's neighbours, then the label of that label; rounds are written to
    the shared folder, which cuts the lineage. The number of rounds grows with the logarithm of a component's width.
    """
    spark = edges.sparkSession
    path = session.scratch(spark, "components")
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both.write.parquet(os.path.join(path, "edges"))
    both = spark.read.parquet(os.path.join(path, "edges"))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
        "node", F.least("node", "b").alias("label"))
    k = 0
    while True:
        labels.write.parquet(os.path.join(path, f"labels-{k}"))
        labels = spark.read.parquet(os.path.join(path, f"labels-{k}"))
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near")))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        new = lower.join(jump, "low", "left").select(
            "node", F.least("low", F.coalesce("far", "low")).alias("new"), (F.least("low", F.coalesce("far", "low"))
                                                                           < F.col("label")).alias("moved"))
        new.write.parquet(os.path.join(path, f"round-{k}"))
        new = spark.read.parquet(os.path.join(path, f"round-{k}"))
        if new.where("moved").isEmpty():
            return labels
        labels = new.select("node", F.col("new").alias("label"))
        k += 1

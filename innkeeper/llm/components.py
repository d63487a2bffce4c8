"""Connected components of links between documents, as Spark joins over stored tables.

Links are contracted: every vertex with a smaller neighbour hooks to its smallest one, the
hooks are followed to their roots by doubling, links are rewritten to roots, and so on
until none is left. Every step is written to the shared checkpoint folder, which cuts the
lineage and lets Spark split a hub's rows when it joins two stored tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeeper.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def relabel(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Links (a, b) between the roots of their ends: a > b, each once."""
    for end in ("a", "b"):
        to = labels.select(F.col("node").alias(f"_{end}"), F.col("root").alias(f"_root_{end}"))
        links = links.join(to, F.col(end) == F.col(f"_{end}"), "left").withColumn(
            end, F.coalesce(f"_root_{end}", end)).select("a", "b")
    return (links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def absorb(labels: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """labels (node, root) after the links (a, b); vertices that are their own root are left out."""
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stored(links if labels is None else relabel(links, labels), "links")
    while not links.isEmpty():
        hooks = stored(links.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"),
                                                                            F.col("b").alias("root")), "hooks")
        while True:
            up = hooks.select(F.col("node").alias("_node"), F.col("root").alias("_up"))
            moved = hooks.join(up, F.col("root") == F.col("_node"), "left")
            if moved.where(F.col("_up").isNotNull()).isEmpty():
                break
            hooks = stored(moved.select("node", F.coalesce("_up", "root").alias("root")), "hooks")
        if labels is None:
            labels = hooks
        else:
            to = hooks.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
            labels = stored(labels.join(to, F.col("root") == F.col("_node"), "left")
                            .select("node", F.coalesce("_root", "root").alias("root")).union(hooks), "labels")
        links = stored(relabel(links, hooks), "links")
    return labels

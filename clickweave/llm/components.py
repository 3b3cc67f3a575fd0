"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import drop_path
from clickweave.session import work_path


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) of the ends of
    ``edges`` (two columns of comparable type, any direction, repeats and
    loops allowed).

    Each round takes the smallest label among the neighbours, then the label
    of that label, so long chains shorten by half and more. A round's labels
    are a table in the shared checkpoint folder: lineage stays short, a lost
    executor costs one round at most, and both sides of each join are plain
    scans, so a label that a third of all nodes share is split by Spark's
    skew-join handling. Callers pass edges without hubs (few per node).
    """
    spark = edges.sparkSession
    a, b = edges.columns
    one_way = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct()
    links_path = work_path(spark, "links", unique=True)
    one_way.unionByName(one_way.select(F.col("v").alias("u"), F.col("u").alias("v"))).write.parquet(links_path)
    links = spark.read.parquet(links_path)

    path = work_path(spark, "labels", unique=True)
    links.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("label")).write.parquet(path)
    while True:
        labels = spark.read.parquet(path)
        near = (
            links.join(labels, F.col("v") == F.col("node"))
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("lower"))
        middle = work_path(spark, "labels", unique=True)
        lower.write.parquet(middle)
        lower = spark.read.parquet(middle)
        jump = lower.select(F.col("node").alias("lower"), F.col("lower").alias("further"))
        new_path = work_path(spark, "labels", unique=True)
        lower.join(jump, "lower").select(
            "node", F.least("lower", "further").alias("label"), (F.least("lower", "further") != F.col("label")).alias("moved")
        ).write.parquet(new_path)
        new = spark.read.parquet(new_path)
        done = new.filter("moved").isEmpty()
        drop_path(spark, middle)
        drop_path(spark, path)
        path = new_path
        if done:
            drop_path(spark, links_path)
            return new.select("node", F.col("label").alias("component"))

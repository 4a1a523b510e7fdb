"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import fresh_dir


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node) for every node of ``edges`` (a, b).

    Each round is written to the shared folder, so lineage stays short; rounds
    grow with the logarithm of the components' diameter.
    """
    now = edges.select("a", "b").filter("a <> b").distinct()
    before = None
    while True:
        path = fresh_dir(spark, "components")
        now.write.parquet(path)
        now = spark.read.parquet(path)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        now = _small(_large(now).distinct()).filter("a <> b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).groupBy("node").agg(F.min("component").alias("component"))

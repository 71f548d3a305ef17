"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmap.llm.scratch import scratch_path


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def components(spark: SparkSession, links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """``node`` and ``comp``, the smallest node it is linked to over any way; linked nodes only.

    Each round a node's larger neighbours are linked to its smallest (large star),
    then its smaller ones and itself (small star), until nothing changes; the
    number of rounds grows with the logarithm of the longest way. Every round is
    written to the scratch folder. A node with very many links is only ever the
    key of an aggregation or the small side of a join.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    pairs = _written(spark, pairs, "links")
    for _ in range(most_rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("x"), "m", "u")
        small = small.select(F.col("x").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        now = _written(spark, small.where("u != v").distinct(), "links")
        if now.count() == pairs.count() and now.join(pairs, ["u", "v"], "left_anti").isEmpty():
            break
        pairs = now
    else:
        raise RuntimeError("components did not settle")
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return nodes.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())

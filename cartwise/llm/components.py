"""Connected components of a link table.

Alternating large-star and small-star steps: each node points its larger
(then its smaller) neighbours at its smallest one, until the links form
stars.  Every step is a grouped minimum and an equi-join, both of which
Spark splits when one node has very many links; nothing is collected.  Steps
are written to the shared checkpoint folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import drop_stage, stage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b"), F.col("a"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    star = down.join(least, "u")
    return star.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").union(least.select("u", "m")).distinct()


def connected_components(links: DataFrame) -> tuple[DataFrame, str]:
    """(node, root) for every node with a link, root being its smallest node, and the staged path."""
    spark = links.sparkSession

    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now, path = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    before = state(now)
    while before[0]:
        new, new_path = stage(_small_star(_large_star(now)), "links")
        drop_stage(spark, path)
        now, path = new, new_path
        after = state(now)
        if tuple(after) == tuple(before):
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b")).distinct(), path

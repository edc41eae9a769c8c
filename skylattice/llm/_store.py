"""Intermediate tables in the cluster's shared folder, and connected components over link tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._batch import shared_dir

#: The database whose tables stand in the shared folder, so that dropping one deletes its files.
SCRATCH = "llm_scratch"


def saved(df: DataFrame, *partition_by: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage and survives lost executors."""
    spark: SparkSession = df.sparkSession
    name = f"{SCRATCH}.t{uuid.uuid4().hex}"
    where = f"{shared_dir(spark).rstrip('/')}/{SCRATCH}".replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH} LOCATION '{where}'")
    df.write.saveAsTable(name, format="parquet", partitionBy=list(partition_by) or None, compression=compression)
    table = spark.table(name)
    table._saved_as = name
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``saved`` made, once all that reads them has been saved or collected."""
    for t in tables:
        t.sparkSession.sql(f"DROP TABLE IF EXISTS {t._saved_as}")


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable over the links (a, b), for every node that has a link to another.

    Alternating large-star and small-star rounds; both take minima by grouped aggregation, so a node with very
    many links needs no list of them.  Null nodes and self-links are dropped.
    """
    edges = saved(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    for _ in range(rounds):
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Larger neighbours of u point at the smallest of its neighbourhood.
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Smaller neighbours and u itself point at the smallest neighbour.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        after = saved(small.where("u <> v").distinct())
        # Done when the links form stars: no node is both a root and below one, and each points at one root.
        stars = after.groupBy("u").agg(F.count("*").alias("n"))
        open_ = stars.where("n > 1").select("u").union(after.select("v").distinct().join(stars.select(F.col("u").alias("v")), "v", "left_semi"))
        discard(edges)
        edges = after
        if open_.isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))

"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is an aggregate and a join, so a hub with very many neighbours is a skewed join
that Spark splits (aggregates are dealt anew before a join, else their partitioning would pin it), never a list in one task. The edge table of each round is written below
the shared scratch folder, which keeps the plan short and survives lost executors.

A step's time is its number of tasks as long as there are few edges. Up to ``FEW`` of them (no step makes more) the aggregates are
broadcast, some ten MB, and merged by a few tasks, so that edges are not shuffled to be joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.session import scratch_dir


FEW = 100_000  # edges
_TASKS = 8  # that merge aggregates of few edges


def _merged(rows: DataFrame, few: bool) -> DataFrame:
    return rows.coalesce(_TASKS) if few else rows


def _least(rows: DataFrame, few: bool) -> DataFrame:
    """Least neighbours (u, m), ready to be joined."""
    return F.broadcast(_merged(rows, few)) if few else rows.repartition("u", "m")


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), few)
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(_least(least, few), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(_merged(least, few).select("u", F.col("m").alias("v")))


def components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """(node, component) of every node in ``edges`` (u, v); the component is its least node.
    Nodes may be of any orderable type; self-links and repeated edges are ignored."""
    spark = edges.sparkSession
    path = scratch_dir(spark, "components")
    edges.where("u <> v").select("u", "v").distinct().write.parquet(f"{path}/edges")
    current, step = spark.read.parquet(f"{path}/edges"), 0
    few = current.count() <= few
    while True:
        _merged(_small_star(_large_star(current, few), few).distinct(), few).write.parquet(f"{path}/{step}")
        current = spark.read.parquet(f"{path}/{step}")
        # Done when the rows are stars: no node has two parents, and no parent has one.
        parents = _merged(current.groupBy("u").agg(F.count("*").alias("n")), few)
        several = parents.where("n > 1").select("u")
        chained = current.select(F.col("v").alias("u")).join(F.broadcast(parents.select("u")) if few else parents.select("u"), "u", "left_semi")
        if several.unionAll(chained).isEmpty():
            break
        step += 1
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(_merged(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct(), few))

"""Tables of the driver's folder, intermediate tables, and connected components."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.scratch import new_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: lineage ends there."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Ids that are few enough to be broadcast.
BROADCAST_IDS = 500_000


def without(docs: DataFrame, keys: DataFrame, key: Column) -> DataFrame:
    """``docs`` but for rows whose ``key`` is in the one column of ``keys``; a null key never matches."""
    keys = stored(keys.toDF("_out_key").where("_out_key is not null").distinct(), "keys")
    side = F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys
    return docs.join(side, key == side["_out_key"], "left_anti")


class Forest:
    """Union-find over small integers; the root of a tree is its smallest member."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True


def _contracted(batches):
    """Each batch of edges as the stars of its components."""
    for batch in batches:
        ids, at = np.unique(batch[["u", "v"]].to_numpy().ravel(), return_inverse=True)
        forest = Forest(len(ids))
        for x, y in at.reshape(-1, 2).tolist():
            forest.union(x, y)
        roots = np.array([forest.find(x) for x in range(len(ids))])
        moved = np.flatnonzero(roots != np.arange(len(ids)))
        yield pd.DataFrame({"u": ids[moved], "v": ids[roots[moved]]})


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an edge table (u long, v long) that has an edge to another.

    Root is the smallest node of the component. Alternates large-star and
    small-star steps on tables until nothing changes; a hub's edges are a plain
    join, which adaptive execution splits, so no task holds a component.
    """
    schema = "u long, v long"
    edges = edges.select("u", "v").where("u <> v").mapInPandas(_contracted, schema)
    edges = stored(edges.distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        edges = stored(_small_star(_large_star(edges)), "edges")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
    return (
        both.join(lowest, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node is linked to the smallest neighbour below it, and so are the others below."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("low"))
    below = edges.join(lowest, "u")
    moved = below.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(lowest.select("u", F.col("low").alias("v"))).distinct()

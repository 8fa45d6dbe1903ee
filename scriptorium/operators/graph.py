"""Traversal of a directed acyclic graph of terms, by joins to a fixpoint.

``edges`` is (child, parent). A level's frontier joins the edges and loses what
was met before, so diamonds cost no path enumeration. Lineage is cut by
checkpoints where the session has a folder for them.
"""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..folders import remove_at_end


def _cut(df: DataFrame) -> DataFrame:
    """``df`` written to the folder that all executors share and read back, so that the next plan starts from
    a plain scan. Over checkpoints each step of a walk took the driver twice the time of the one before."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None and spark.sparkContext.master.startswith("local"):
        folder = f"/tmp/checkpoints/{os.getuid()}"
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{folder.rstrip('/')}/step-{uuid.uuid4().hex}"
    remove_at_end(spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _walk(edges: DataFrame, roots: DataFrame, source: str, target: str, most: int | None) -> DataFrame:
    """(root, node, distance) of everything reached, roots included at 0; shortest distances."""
    step = edges.select(F.col(source).alias("_from"), F.col(target).alias("_to")).distinct()
    front = _cut(roots.select("root", F.col("root").alias("node"), F.lit(0).alias("distance")).distinct())
    fronts = [front]  # each is written once; what was seen is all of them
    while most is None or len(fronts) <= most:
        reached = front.join(step, front["node"] == step["_from"]).select("root", F.col("_to").alias("node")).distinct()
        seen = reduce(DataFrame.union, (f.select("root", "node") for f in fronts))
        front = _cut(reached.join(seen, ["root", "node"], "left_anti").withColumn("distance", F.lit(len(fronts))))
        if front.isEmpty():
            break
        fronts.append(front)
    return reduce(DataFrame.unionByName, fronts)


def ancestors(edges: DataFrame, nodes: DataFrame, most: int | None = None) -> DataFrame:
    """(root, node, distance) from each of ``nodes`` (root) up to its ancestors, itself at 0."""
    return _walk(edges, nodes, "child", "parent", most)


def descendants(edges: DataFrame, roots: DataFrame, most: int | None = None) -> DataFrame:
    """Nodes reachable downward from any of ``roots``, these included."""
    one = roots.select(F.lit(0).alias("root"), F.col("root").alias("node"))
    step = edges.select(F.col("parent").alias("_from"), F.col("child").alias("_to")).distinct()
    front = _cut(one.withColumn("distance", F.lit(0)).distinct())
    fronts = [front]
    while most is None or len(fronts) <= most:
        reached = front.join(step, front["node"] == step["_from"]).select(F.lit(0).alias("root"), F.col("_to").alias("node")).distinct()
        seen = reduce(DataFrame.union, (f.select("node") for f in fronts))
        front = _cut(reached.join(seen, "node", "left_anti").select("root", "node", F.lit(len(fronts)).alias("distance")))
        if front.isEmpty():
            break
        fronts.append(front)
    return reduce(DataFrame.unionByName, fronts).select("node", "distance")


def levels(edges: DataFrame, root: DataFrame, eligible: DataFrame, depth: int = 3) -> DataFrame:
    """(root, node, level) below each root through eligible nodes only, least level, to ``depth``."""
    step = edges.join(eligible.select(F.col("node").alias("child")), "child", "left_semi")
    return _walk(step, root, "parent", "child", depth).where("distance > 0").withColumnRenamed("distance", "level")

"""Connected components by hooking, pointer jumping and contraction, in Spark tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm import common

#: So many edges at most are contracted in one task.
FEW = 10_000


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, least node reachable), one for each node but the least."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _contracted(t: pa.Table) -> pa.Table:
    u, root = forest(t.column("u").to_numpy(), t.column("v").to_numpy())
    return pa.table({"u": pa.array(u, pa.int64()), "root": pa.array(root, pa.int64())})


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """id, component (the least id reachable) of every id that ``edges`` names.

    Each round hooks every node to its least neighbour, jumps one pointer ahead and
    contracts the edges; edges within a node go. When FEW are left, one task contracts
    them. Tables between rounds are written to the shared folder. No edges give no rows; nulls and loops are dropped.
    """

    def ends(a, b) -> DataFrame:
        return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]

    e = common.stored(edges.where(F.col(u).isNotNull() & F.col(v).isNotNull()).select(*ends(F.col(u).cast("long"), F.col(v).cast("long"))).distinct())
    labels = e.select(F.col("u").alias("id"), F.col("u").alias("component")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
    e = e.where("u <> v")
    while (many := e.count()) > 0:
        if many <= FEW:
            hook = common.stored(e.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(_contracted, "u long, root long"))
            labels = labels.join(hook, F.col("component") == F.col("u"), "left").select("id", F.coalesce("root", "component").alias("component"))
            return common.stored(labels)
        both = e.union(e.select("v", "u"))
        hook = common.stored(both.groupBy("u").agg(F.min("v").alias("to")).select("u", F.least("u", "to").alias("to")))
        ahead = hook.select(F.col("u").alias("to"), F.col("to").alias("root"))
        hook = common.stored(hook.join(ahead, "to").select("u", "root"))
        labels = labels.join(hook, F.col("component") == F.col("u"), "left").select("id", F.coalesce("root", "component").alias("component"))
        labels = common.stored(labels)
        e = e.join(hook, "u").select("v", F.col("root").alias("a")).join(hook.select(F.col("u").alias("v"), F.col("root").alias("b")), "v")
        e = common.stored(e.where("a <> b").select(*ends(F.col("a"), F.col("b"))).distinct())
    return labels

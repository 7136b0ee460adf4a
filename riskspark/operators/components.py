"""Connected components by contraction: every round rewrites the edges and drops those inside a group."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.sources.session import written

#: edges up to which the rest of a graph is settled in one task
ONE_TASK = 200_000


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "node", label: str = "label", one_task: int = ONE_TASK) -> DataFrame:
    """Each node with the smallest label of its component.

    ``nodes``: (node, label) with distinct nodes; ``edges``: (src, dst), either direction; loops, repeats and
    nulls among them do no harm.
    """
    roots = component_roots(edges, one_task).withColumnRenamed("node", node)
    named = nodes.select(node, label).join(roots, node, "left").withColumn("_root", F.coalesce("root", F.col(node))).drop("root")
    least = named.groupBy("_root").agg(F.min(label).alias("_least"))
    return named.join(least, "_root").select(node, F.col("_least").alias(label))


def component_roots(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, root): one node of each component, for all nodes that have an edge to another one.

    A round hangs every node below its neighbour with the smallest hash (if that is smaller than
    its own), two steps at once, and the edges are rewritten to what their ends hang below: an
    edge whose ends agree is gone. Hashes order the nodes at random, so a chain loses at least
    half of its nodes in a round and a star all of its leaves within two. What is left once
    the edges number at most ``one_task`` is settled in a task of that bounded size. Each round
    is written to the shared folder; the rounds' tables shrink by a constant factor.
    """
    left = written(_simple(edges))
    rounds: list[DataFrame] = []
    while (n := left.count()) > one_task:
        rounds.append(written(_parents(left)))
        left = written(_rewritten(left, rounds[-1]))
    if n:
        kind = left.schema["src"].dataType.simpleString()
        one = left.withColumn("_one", F.lit(0)).groupBy("_one").applyInPandas(_settled, f"node {kind}, root {kind}")
        rounds.append(written(one))
    if not rounds:
        return left.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    roots = rounds.pop().toDF("node", "root")
    while rounds:
        later = roots.select(F.col("node").alias("parent"), F.col("root").alias("_root"))
        roots = rounds.pop().join(later, "parent", "left").select("node", F.coalesce("_root", "parent").alias("root"))
    return roots


def _simple(edges: DataFrame) -> DataFrame:
    return edges.filter(F.col("src") != F.col("dst")).select(
        F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()


def _parents(edges: DataFrame) -> DataFrame:
    """(node, parent) for all ends of edges; a chain of two hangings counts as one."""
    ends = F.explode(F.array(F.struct(F.col("src").alias("node"), F.col("dst").alias("to")), F.struct(F.col("dst").alias("node"), F.col("src").alias("to"))))
    own = F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("id"))
    to = F.struct(F.xxhash64("to").alias("h"), F.col("to").alias("id"))
    first = written(edges.select(ends.alias("e")).select("e.*").groupBy("node").agg(F.min(to).alias("_low")).select(
        "node", F.least(own, F.col("_low"))["id"].alias("parent")))
    above = first.select(F.col("node").alias("parent"), F.col("parent").alias("_above"))
    return first.join(above, "parent").select("node", F.col("_above").alias("parent"))


def _rewritten(edges: DataFrame, parents: DataFrame) -> DataFrame:
    a = parents.select(F.col("node").alias("src"), F.col("parent").alias("_a"))
    b = parents.select(F.col("node").alias("dst"), F.col("parent").alias("_b"))
    return _simple(edges.join(a, "src").join(b, "dst").select(F.col("_a").alias("src"), F.col("_b").alias("dst")))


def _settled(edges: pd.DataFrame) -> pd.DataFrame:
    """Smallest position of each component, by hanging and jumping over all edges at once."""
    at, names = pd.factorize(pd.concat([edges["src"], edges["dst"]], ignore_index=True), sort=False)
    a, b = at[: len(edges)], at[len(edges):]
    label = np.arange(len(names))
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        up = np.arange(len(names))
        np.minimum.at(up, high, low)
        while (up[up] != up).any():
            up = up[up]
        label = up[label]
    return pd.DataFrame({"node": names, "root": names[label]})

"""Density clustering and neighbour distances on standardised features, exact in any number of them.

Rows with the same values are one weighted point, so copies never pair with each other. Points
stand in cells around pivots, and a point looks only into cells that the triangle inequality
cannot rule out (``metric``). Distances are between the standardised values themselves.

Rows with a null or a NaN among the features have no distance: they are noise, and their
distance to a neighbour is null. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.components import component_roots
from riskspark.operators.metric import Cells, blocks
from riskspark.sources.session import ensure_checkpoint_dir

NOISE = -1


def standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    stats = df.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(c) for c in cols])).scalar()
    made = df.withColumn("_st", stats)
    spread = {c: F.when(F.coalesce(F.col(f"_st.{c}.s"), F.lit(0.0)) == 0, 1.0).otherwise(F.col(f"_st.{c}.s")) for c in cols}
    keep = [c for c in df.columns if c not in cols]
    return made.select(*keep, *[((F.col(c) - F.col(f"_st.{c}.m")) / spread[c]).alias(c) for c in cols])


def one_hot(col: str, values: Sequence[object]) -> list[Column]:
    return [F.when(F.col(col) == v, 1.0).otherwise(0.0).alias(f"{col}_{v}") for v in values]


def weighted_points(df: DataFrame, row_id: str, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows (_row, x), distinct points (id, x, w)); a point has the smallest row id and the number of its rows."""
    ensure_checkpoint_dir(df.sparkSession)
    values = df.select(F.col(row_id).alias("_row"), *[F.col(c).cast("double").alias(c) for c in cols])
    whole = F.lit(True)
    for c in cols:
        whole &= F.col(c).isNotNull() & ~F.isnan(c)
    # + 0.0: a negative zero is a zero
    rows = standardise(values.filter(whole), cols).select("_row", F.array(*[F.col(c) + F.lit(0.0) for c in cols]).alias("x")).checkpoint()
    return rows, rows.groupBy("x").agg(F.min("_row").alias("id"), F.count(F.lit(1)).alias("w")).select("id", "x", "w").checkpoint()


def near_weight(held: pd.DataFrame, visitors: pd.DataFrame) -> pd.DataFrame:
    """(id, near): rows within the reach of each visitor."""
    near, w, limit = np.zeros(len(visitors), np.int64), held["w"].to_numpy(np.int64), visitors["limit"].to_numpy()
    for a, b, d2 in blocks(held, visitors):
        near[a] += (d2 <= limit[a, None]) @ w[b]
    return pd.DataFrame({"id": visitors["id"], "near": near})


def near_links(held: pd.DataFrame, visitors: pd.DataFrame) -> pd.DataFrame:
    """(src, dst): enough links to join all that are within reach of each other."""
    names, at = np.unique(np.concatenate([held["id"].to_numpy(), visitors["id"].to_numpy()]), return_inverse=True)
    label, src, dst, limit = np.arange(len(names)), [], [], visitors["limit"].to_numpy()
    for a, b, d2 in blocks(held, visitors):
        row, col = np.nonzero(d2 <= limit[a, None])
        x, y = at[len(held) + a[row]], at[b[col]]
        while True:
            apart = label[x] != label[y]
            x, y = x[apart], y[apart]
            if not len(x):
                break
            high, first = np.unique(np.maximum(label[x], label[y]), return_index=True)
            src.append(names[x[first]])
            dst.append(names[y[first]])
            up = np.arange(len(names))
            up[high] = np.minimum(label[x], label[y])[first]
            while (up[up] != up).any():
                up = up[up]
            label = up[label]
    none = names[:0]
    return pd.DataFrame({"src": np.concatenate([none, *src]), "dst": np.concatenate([none, *dst])})


def least_label(held: pd.DataFrame, visitors: pd.DataFrame) -> pd.DataFrame:
    """(id, label): the smallest label within reach."""
    found, limit = np.full(len(visitors), -1, np.int64), visitors["limit"].to_numpy()
    names, rank = np.unique(held["label"].to_numpy(), return_inverse=True)
    for a, b, d2 in blocks(held, visitors):
        best = np.where(d2 <= limit[a, None], rank[b], len(names)).min(axis=1)
        old = np.where(found[a] < 0, len(names), found[a])
        best = np.minimum(best, old)
        found[a] = np.where(best == len(names), -1, best)
    seen = found >= 0
    return pd.DataFrame({"id": visitors["id"].to_numpy()[seen], "label": names[found[seen]]})


def density_cluster(df: DataFrame, row_id: str, cols: Sequence[str], eps: float, min_pts: int,
                    categories: Mapping[str, Sequence[object]] | None = None) -> DataFrame:
    """(row id, cluster): the smallest row id among the cluster's core rows, -1 for noise.

    A point is core with ``min_pts`` rows (itself included) within ``eps``. Core points within ``eps``
    of each other are of one cluster; a border point joins the smallest cluster it can reach.
    ``categories`` adds one-hot columns (column -> values), standardised like the numbers.
    """
    for c, values in (categories or {}).items():
        df = df.select("*", *one_hot(c, values))
        cols = [*cols, *[f"{c}_{v}" for v in values]]
    rows, points = weighted_points(df, row_id, cols)
    kind = points.schema["id"].dataType.simpleString()
    ids = df.select(row_id)
    if points.isEmpty():
        return ids.withColumn("cluster", F.lit(NOISE).cast(kind))
    cells = Cells(points)
    limit = F.lit(float(eps) * float(eps))
    looks = cells.visits(cells.points, reach=float(eps)).withColumn("limit", limit).checkpoint()
    near = cells.meet(cells.points, looks, near_weight, f"id {kind}, near long").groupBy("id").agg(F.sum("near").alias("near"))
    core = near.filter(F.col("near") >= min_pts).select("id").checkpoint()
    held = cells.points.join(core, "id", "left_semi")
    links = cells.meet(held, looks.join(core, "id", "left_semi"), near_links, f"src {kind}, dst {kind}")
    roots = core.join(component_roots(links).withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("root", "id").alias("root"))
    labels = roots.join(roots.groupBy("root").agg(F.min("id").alias("label")), "root").select("id", "label").checkpoint()
    reached = cells.meet(held.join(labels, "id"), looks.join(core, "id", "left_anti"), least_label, f"id {kind}, label {kind}")
    every = labels.unionByName(reached.groupBy("id").agg(F.min("label").alias("label")))
    of = rows.join(points.select("x", "id"), "x").join(every, "id").select(F.col("_row").alias(row_id), F.col("label").alias("cluster"))
    return ids.join(of, row_id, "left").select(row_id, F.coalesce("cluster", F.lit(NOISE)).alias("cluster"))


def nearest(held: pd.DataFrame, visitors: pd.DataFrame, k: int) -> pd.DataFrame:
    """(id, d2, w): of each visitor the nearest held points, as many as hold ``k`` rows at most needs."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    w, ids, limit = held["w"].to_numpy(np.int64), visitors["id"].to_numpy(), visitors["limit"].to_numpy()
    for a, b, d2 in blocks(held, visitors):
        m = min(k, d2.shape[1])
        first = np.argpartition(d2, m - 1, axis=1)[:, :m]
        found = np.take_along_axis(d2, first, 1)
        keep = found <= limit[a, None]
        out.append((np.repeat(ids[a], m)[keep.ravel()], found[keep], w[b][first][keep]))
    none = (ids[:0], np.zeros(0), w[:0])
    return pd.DataFrame(dict(zip(("id", "d2", "w"), (np.concatenate(x) for x in zip(none, *out, strict=True)), strict=True)))


def kth_distance(df: DataFrame, row_id: str, cols: Sequence[str], k: int) -> DataFrame:
    """(row id, d2): squared distance to the k-th nearest other row, null if there are fewer.

    A point looks into its own cell first: the distance found there bounds how far it has to look
    beyond. Each cell also tells the distances of its k + 1 points nearest to the pivot; they bound
    the points of cells with few rows. A second pass over the cells within the smaller bound is enough.
    """
    rows, points = weighted_points(df, row_id, cols)
    if rows.count() <= k:
        return df.select(row_id, F.lit(None).cast("double").alias("d2"))
    cells = Cells(points, first=k + 1)
    kind = cells.kind
    ahead = Window.partitionBy("id").orderBy("d2").rowsBetween(Window.unboundedPreceding, 0)

    def kth_of(looks: DataFrame) -> DataFrame:
        """(id, d2), at most k + 1 rows of each chunk of a cell that a point looks into."""
        found = cells.meet(cells.points, looks, lambda held, ask: nearest(held, ask, k + 1), f"id {kind}, d2 double, w long")
        return found.withColumn("seen", F.sum("w").over(ahead)).filter(F.col("seen") > k).groupBy("id").agg(F.min("d2").alias("d2"))

    everywhere = F.lit(float("inf"))
    at_home = kth_of(cells.points.select("id", "x", "cell", "dist", everywhere.alias("reach"), everywhere.alias("limit")))
    bounded = cells.points.join(at_home.select("id", F.sqrt("d2").alias("bound")), "id", "left")
    kth = kth_of(cells.visits(bounded, k=k + 1, bound="bound").withColumn("limit", F.col("reach") * F.col("reach")).checkpoint())
    of = rows.join(points.select("x", "id"), "x").join(kth, "id").select(F.col("_row").alias(row_id), "d2")
    return df.select(row_id).join(of, row_id, "left")

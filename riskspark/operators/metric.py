"""Points partitioned by pivots, and the pairs of cells that a distance bound cannot rule out.

A few points are pivots; every point stands in the cell of its nearest pivot and knows its
distance to it. By the triangle inequality a point can be within r of a member of a cell only if
its distance to the pivot is at most r beyond the cell's radius, and at most 2 r beyond the distance
to its own pivot; inside a cell only members whose distance to the pivot differs by at most r
are measured. So it holds in any number of dimensions, and nothing is rounded.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: points of a cell that are held, and that visit, at once; each chunk takes a copy of the visitors, each slice one of the held
CHUNK, SLICE = 32_768, 32_768
#: pairs that are measured at once, about
PAIRS = 1 << 20
#: points of a cell, about, and at most so many pivots
CELL, MOST_PIVOTS = 512, 256
#: room for the last digits of a distance
SLACK = 1e-9


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a and b, summed by axis in order."""
    out = np.zeros((len(a), len(b)))
    for k in range(a.shape[1]):
        gap = a[:, k, None] - b[None, :, k]
        out += gap * gap
    return out


def rows_of(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), -1)


def certain(d: np.ndarray, near: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """For points with distances ``d`` to the pivots: a distance within which k rows are certain, by the
    (distances, rows) of each cell's points nearest to its pivot."""
    far, weight = (np.concatenate([x[i] for x in near]) for i in (0, 1))
    reach = np.repeat(d, [len(x) for x, _ in near], axis=1) + far
    order = np.argsort(reach, axis=1, kind="stable")
    enough = np.cumsum(weight[order], axis=1) >= k
    found = np.take_along_axis(reach, order, 1)[np.arange(len(d)), enough.argmax(axis=1)]
    return np.where(enough.any(axis=1), found, np.inf)


class Cells:
    """Points (id, x, w) with the cell of each and its distance ``dist`` to the pivot; radius, and distances of the ``first`` nearest, by cell."""

    def __init__(self, points: DataFrame, first: int = 0):
        n = points.count()
        count = min(max(1, math.ceil(n / CELL)), MOST_PIVOTS)
        self.pivots = np.array([r.x for r in points.select("x", F.xxhash64("id").alias("h")).orderBy("h").limit(count).collect()], np.float64)
        pivots = self.pivots

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    d = np.sqrt(squared(rows_of(b["x"]), pivots))
                    yield b.assign(cell=d.argmin(axis=1).astype(np.int32), dist=d.min(axis=1))

        kind = points.schema["id"].dataType.simpleString()
        self.kind = kind
        self.points = points.select("id", "x", "w").mapInPandas(assign, f"id {kind}, x array<double>, w long, cell int, dist double").checkpoint()
        # a slice of a cell hands on its nearest points, the rest is a maximum: bounded by cells and parts
        stats = self.points.groupBy("cell").agg(F.max("dist").alias("r"), F.count(F.lit(1)).alias("n")).collect()
        self.radius = np.full(len(pivots), -np.inf)
        self.size = {r.cell: r.n for r in stats}
        for r in stats:
            self.radius[r.cell] = r.r
        self.near: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64))] * len(pivots)
        if first:
            part = F.pmod(F.xxhash64("id"), F.lit(64))
            few = self.points.select("cell", "dist", "w", part.alias("part")).groupBy("cell", "part").agg(
                F.slice(F.sort_array(F.collect_list(F.struct("dist", "w"))), 1, first).alias("d"))
            best = few.select("cell", F.explode("d").alias("d")).groupBy("cell").agg(F.slice(F.sort_array(F.collect_list("d")), 1, first).alias("d"))
            for r in best.collect():
                self.near[r.cell] = np.array([x.dist for x in r.d]), np.array([x.w for x in r.d], np.int64)

    def visits(self, points: DataFrame, reach: float | None = None, k: int = 0, bound: str | None = None) -> DataFrame:
        """(id, x, w, dist, cell, reach) for every cell that a point has to look into; ``dist`` is the distance to that cell's pivot.

        ``reach``: how far all points look; else each looks as far as ``k`` rows are certain, or
        as far as its column ``bound`` says if that is less.
        """
        pivots, radius, near = self.pivots, self.radius, self.near

        def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for whole in batches:
                for at in range(0, len(whole), 512):
                    b = whole.iloc[at : at + 512].reset_index(drop=True)
                    d = np.sqrt(squared(rows_of(b["x"]), pivots))
                    far = np.full(len(b), reach) if reach is not None else certain(d, near, k)
                    if bound:
                        far = np.fmin(far, b["bound"].to_numpy(np.float64))     # NaN: no bound
                    far = far * (1 + SLACK) + SLACK
                    inside = (d <= radius + far[:, None]) & (d - d.min(axis=1)[:, None] <= 2 * far[:, None])
                    row, cell = np.nonzero(inside)
                    yield pd.DataFrame({"id": b["id"].to_numpy()[row], "x": b["x"].to_numpy()[row], "cell": cell.astype(np.int32),
                                        "dist": d[row, cell], "reach": far[row]})

        known = [F.col(bound).cast("double").alias("bound")] if bound else []
        return points.select("id", "x", *known).mapInPandas(look, f"id {self.kind}, x array<double>, cell int, dist double, reach double")

    def meet(self, held: DataFrame, visitors: DataFrame, pairs: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
        """``pairs(held rows, visitors)`` for every chunk of a cell and every slice of those that look into it."""
        spark = held.sparkSession
        asked = {r.cell: r.n for r in visitors.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        sizes = F.broadcast(spark.createDataFrame(
            [(c, math.ceil(n / CHUNK), math.ceil(asked[c] / SLICE)) for c, n in self.size.items() if c in asked] or [(-1, 1, 1)], "cell int, chunks int, slices int"))
        left = held.join(sizes, "cell").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks"))).withColumn(
            "slice", F.explode(F.expr("sequence(0L, slices - 1L)"))).drop("chunks", "slices")
        right = visitors.join(sizes, "cell").withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices"))).withColumn(
            "chunk", F.explode(F.expr("sequence(0L, chunks - 1L)"))).drop("chunks", "slices")
        right = right.toDF(*right.columns)
        key = ["cell", "chunk", "slice"]
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(pairs, schema)


def blocks(held: pd.DataFrame, visitors: pd.DataFrame, rows: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions of visitors, of held rows, squared distances), visitors by distance to the pivot, a few at a
    time, with the held rows whose distance to the pivot allows their reach."""
    if not len(held) or not len(visitors):
        return
    a, b = np.argsort(visitors["dist"].to_numpy(), kind="stable"), np.argsort(held["dist"].to_numpy(), kind="stable")
    x, y = rows_of(visitors["x"])[a], rows_of(held["x"])[b]
    rows = max(16, min(rows, PAIRS // len(b)))
    from_pivot, reach, of = visitors["dist"].to_numpy()[a], visitors["reach"].to_numpy()[a], held["dist"].to_numpy()[b]
    for at in range(0, len(a), rows):
        part = slice(at, at + rows)
        low = np.searchsorted(of, (from_pivot[part] - reach[part]).min() - SLACK, "left")
        high = np.searchsorted(of, (from_pivot[part] + reach[part]).max() + SLACK, "right")
        if high > low:
            yield a[part], b[low:high], squared(x[part], y[low:high])

"""Exact global ranks without a global sort in one task.

Rows with equal sort values are first counted together (a *run*), so a value held by a
third of all rows becomes one row. Runs are cut into value ranges of similar size; the
ranges' totals (a few hundred rows) are summed up in order, and inside each range a
window adds the runs. Every step depends on values only, so a lost executor can be
recomputed without changing any rank.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, isfinite, sqrt

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST_RANGES, MOST_RANGES = 16, 1 << 16


def range_count(rows: int) -> int:
    """As many ranges as a range has thousands of rows: both grow with the root of the rows."""
    return min(MOST_RANGES, max(LEAST_RANGES, ceil(sqrt(rows / 1000))))


def ranked_values(df: DataFrame, cols: Sequence[str], tie: str | None = None, descending: bool = False,
                  ranges: int | None = None) -> DataFrame:
    """(feature, value[, tie], n, before, total) of several columns in one pass over the rows.

    ``n`` rows of the column hold the value (and tie), ``before`` rows rank ahead of them,
    out of ``total``. ``tie`` orders equal values, always from high to low. Null values take
    no part in a ranking."""
    ties = [tie] if tie else []
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in cols], *ties)
    ranges = ranges or range_count(wide.count())
    probs = [i / ranges for i in range(1, ranges)]
    cuts = wide.agg(*[F.percentile_approx(c, probs, 4 * ranges).alias(c) for c in cols]).first()
    # a column without values, or with infinities at its ends, has no finite cut there: one range then
    finite = [sorted({x for x in cuts[c] or [] if isfinite(x)}) or [0.0] for c in cols]
    split = Bucketizer(
        splitsArray=[[float("-inf"), *x, float("inf")] for x in finite],
        inputCols=list(cols), outputCols=[f"_r_{c}" for c in cols], handleInvalid="keep")
    items = F.explode(F.array(*[F.struct(
        F.lit(c).alias("feature"), F.col(c).alias("value"), F.col(f"_r_{c}").alias("_range")) for c in cols])).alias("i")
    runs = split.transform(wide).select(items, *ties).select("i.*", *ties).filter(F.col("value").isNotNull()).groupBy(
        "feature", "value", "_range", *ties).agg(F.count(F.lit(1)).alias("n"))

    def direction(c: str) -> Column:
        return F.col(c).desc() if descending else F.col(c).asc()

    # at most `ranges` rows per feature, so the window and the broadcast are bounded
    by_feature = Window.partitionBy("feature")
    ahead = by_feature.orderBy(direction("_range")).rowsBetween(Window.unboundedPreceding, -1)
    totals = runs.groupBy("feature", "_range").agg(F.sum("n").alias("_n")).select(
        "feature", "_range", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"), F.sum("_n").over(by_feature).alias("total"))
    inside = Window.partitionBy("feature", "_range").orderBy(direction("value"), *[F.col(c).desc() for c in ties]).rowsBetween(
        Window.unboundedPreceding, -1)
    return runs.join(F.broadcast(totals), ["feature", "_range"]).select(
        "feature", "value", *ties, "n", (F.col("_ahead") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("before"), "total")


def quantile_values(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(feature, prob, value): the smallest value whose rank reaches prob * rows."""
    def reached(p: float) -> Column:
        rank = F.ceil(F.col("total") * F.lit(p))
        return F.when((rank > F.col("before")) & (rank <= F.col("before") + F.col("n")), F.lit(float(p)))
    wanted = F.explode(F.array_compact(F.array(*[reached(p) for p in probs]))).alias("prob")
    return ranked_values(df, cols).select("feature", wanted, "value")


def quantile_lists(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """The same as numbers on the driver: one per column and probability, None for a column without values."""
    found = {(r["feature"], r["prob"]): r["value"] for r in quantile_values(df, cols, probs).collect()}
    return {c: [found.get((c, p)) for p in probs] for c in cols}

"""Decile charts and the cut-offs read from them.

Charts are computed from (score, label) runs: a run is split over the bins its ranks
cover, so neither ties nor hot scores gather rows. Several score columns are charted in one
pass; ``feature`` names the column. A chart has at most ``bins`` rows per feature, which
bounds the windows over it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.ranks import quantile_lists, ranked_values

DEFAULT_RECALL = 0.8
DEFAULT_MISCLASS = 0.05
HIGH_CONSERVATIVE = 0.10
LOW_CONSERVATIVE = 0.40


def _row_number_bins(bins: int) -> tuple[Column, Column, Column, Column]:
    """ceil(rank / (rows / bins)) in whole numbers: first and last bin of a run, and the
    last rank of bin ``_b`` and of the bin before it."""
    first = F.expr(f"((before + 1) * {bins} + total - 1) div total")
    last = F.expr(f"((before + n) * {bins} + total - 1) div total")
    return first, last, F.expr(f"(_b * total) div {bins}"), F.expr(f"((_b - 1) * total) div {bins}")


def _ntile_bins(bins: int) -> tuple[Column, Column, Column, Column]:
    """ntile: the first rows-mod-bins bins hold one row more."""
    def bin_of(rank: str) -> Column:
        return F.expr(
            f"CASE WHEN {rank} <= (total % {bins}) * (total div {bins} + 1) "
            f"THEN ({rank} + total div {bins}) div (total div {bins} + 1) "
            f"ELSE (total % {bins}) + ({rank} - (total % {bins}) * (total div {bins} + 1) + total div {bins} - 1) "
            f"div greatest(total div {bins}, 1) END")

    def end(b: str) -> Column:
        return F.expr(f"{b} * (total div {bins}) + least({b}, total % {bins})")
    return bin_of("(before + 1)"), bin_of("(before + n)"), end("_b"), end("(_b - 1)")


def _running(first: bool = False) -> Window:
    by = Window.partitionBy("feature").orderBy("decile")
    return by if first else by.rowsBetween(Window.unboundedPreceding, 0)


def decile_chart(df: DataFrame, bins: int, scores: Sequence[str] = ("score",), label: str | None = "label",
                 rule: str = "row_number", descending: bool = True) -> DataFrame:
    """Equal-count bins by score. Equal scores are ordered true alerts first."""
    runs = ranked_values(df, scores, label, descending)
    first, last, end, end_before = (_row_number_bins if rule == "row_number" else _ntile_bins)(bins)
    parts = runs.withColumn("_b", F.explode(F.sequence(first, last))).withColumn(
        "_k", F.least(F.col("before") + F.col("n"), end) - F.greatest(F.col("before"), end_before))
    aggs = [F.sum("_k").alias("total_rows"), F.min("value").alias("min_score"), F.max("value").alias("max_score")]
    if label:
        aggs += [F.sum(F.col("_k") * F.col(label)).alias("true_alerts"),
                 F.sum(F.when(F.col(label) == 0, F.col("_k")).otherwise(0)).alias("false_alerts")]
    chart = parts.groupBy("feature", F.col("_b").cast("int").alias("decile")).agg(*aggs)
    whole = Window.partitionBy("feature")

    def running(col: str, name: str) -> list[Column]:
        total = F.sum(col).over(_running())
        return [total.alias(f"cum_{name}"), (total / F.sum(col).over(whole)).alias(f"cum_{name}_share")]
    out = chart.select("*", *running("total_rows", "total"), *(running("true_alerts", "true") if label else []))
    return out.persist()      # at most `bins` rows per feature, read several times by the cut-offs


def quantile_chart(df: DataFrame, bins: int = 10, score: str = "score", label: str = "label") -> DataFrame:
    """Bins cut at score quantiles: recall, false-alert reduction and their running sums."""
    runs = df.filter(F.col(score).isNotNull()).groupBy(score, label).agg(F.count(F.lit(1)).alias("n"))
    cuts = sorted(set(quantile_lists(df, [score], [i / bins for i in range(1, bins)])[score]) - {None})
    bin_no = F.lit(1)
    for c in cuts:
        bin_no = bin_no + F.when(F.col(score) >= c, 1).otherwise(0)
    true_n, false_n = F.when(F.col(label) == 1, F.col("n")).otherwise(0), F.when(F.col(label) != 1, F.col("n")).otherwise(0)
    stats = runs.groupBy(bin_no.alias("ordered_bin")).agg(
        F.sum(true_n).alias("true_alerts"), F.sum(false_n).alias("false_alerts"),
        (F.sum(F.col(score) * F.col("n")) / F.sum("n")).alias("avg_score"),
        F.min(score).alias("min_score"), F.max(score).alias("max_score"))
    so_far = Window.orderBy("ordered_bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy("ordered_bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stats = stats.withColumn("recall", F.round(F.col("true_alerts") / F.sum("true_alerts").over(whole), 6)).withColumn(
        "reduction", F.round(F.col("false_alerts") / F.sum("false_alerts").over(whole), 3))
    return stats.withColumn("cum_recall", F.sum("recall").over(so_far)).withColumn("cum_reduction", F.sum("reduction").over(so_far))


def boundaries(chart: DataFrame, recall: float = DEFAULT_RECALL, misclass: float = DEFAULT_MISCLASS) -> DataFrame:
    """Per feature: high cut-off from the recall wanted above it, low cut-off from the true
    alerts tolerated below it (the running share *before* a bin decides)."""
    lagged = chart.withColumn("_lag", F.coalesce(F.lag("cum_true_share").over(_running(first=True)), F.lit(0.0)))
    hi, lo = F.col("cum_true_share") >= recall, F.col("_lag") >= 1 - misclass
    return lagged.groupBy("feature").agg(
        F.max(F.when(hi, F.col("min_score"))).alias("high"), F.min(F.when(hi, F.col("decile"))).alias("high_decile"),
        F.max(F.when(lo, F.col("max_score"))).alias("low"), F.min(F.when(lo, F.col("decile"))).alias("low_decile"))


def recall_thresholds(chart: DataFrame, min_recall: float, max_misclass: float) -> DataFrame:
    """From an ascending chart: lowest scores of the bins past 1 - recall, and past the misclassification."""
    share = F.col("cum_true_share")
    return chart.groupBy("feature").agg(
        F.coalesce(F.min(F.when(share > 1 - min_recall, F.col("min_score"))), F.lit(1.0)).alias("high"),
        F.coalesce(F.min(F.when(share > max_misclass, F.col("min_score"))), F.lit(0.0)).alias("low"))


def worst_case(chart: DataFrame, bins: int, high_share: float = HIGH_CONSERVATIVE, low_share: float = LOW_CONSERVATIVE) -> DataFrame:
    """Conservative cut-offs for when the tuned ones cross: top and bottom shares of a descending chart."""
    high_bin, low_bin = int(high_share * bins), bins - int(low_share * bins) + 1

    def cell(decile: int, col: str) -> Column:
        return F.max(F.when(F.col("decile") == decile, F.col(col)))
    return chart.groupBy("feature").agg(
        F.coalesce(cell(high_bin, "min_score"), F.lit(1.0)).alias("high"), cell(low_bin, "max_score").alias("low"),
        F.coalesce(cell(high_bin, "cum_true_share"), F.lit(0.0)).alias("recall"),
        (1 - cell(low_bin - 1, "cum_true_share")).alias("misclass"))


def tuned(chart: DataFrame, bins: int, recall: float = DEFAULT_RECALL, misclass: float = DEFAULT_MISCLASS) -> DataFrame:
    """Boundaries, replaced by the worst case where high falls below low or one is missing."""
    both = boundaries(chart, recall, misclass).join(
        worst_case(chart, bins).select("feature", F.col("high").alias("_wh"), F.col("low").alias("_wl")), "feature")
    crossed = F.coalesce(F.col("high") < F.col("low"), F.lit(True))
    return both.select("feature", F.when(crossed, F.col("_wh")).otherwise(F.col("high")).alias("high"),
                       F.when(crossed, F.col("_wl")).otherwise(F.col("low")).alias("low"), crossed.alias("conservative"))


def level_sizes(df: DataFrame, thresholds: DataFrame, scores: Sequence[str] = ("score",)) -> DataFrame:
    """Per feature: rows at or above its high cut-off, rows below its low one, all rows."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in scores]).unpivot([], list(scores), "feature", "value")
    return long.filter(F.col("value").isNotNull()).join(thresholds.select("feature", "high", "low"), "feature").groupBy("feature").agg(
        F.count(F.when(F.col("value") >= F.col("high"), True)).alias("n_high"),
        F.count(F.when(F.col("value") < F.col("low"), True)).alias("n_low"), F.count(F.lit(1)).alias("n"))


def adjust_to_population(chart: DataFrame, df: DataFrame, thresholds: DataFrame, max_high: float, min_low: float,
                         scores: Sequence[str] = ("score",)) -> DataFrame:
    """Re-cut on the population's ascending chart where %High is over, or %Low under, its bound."""
    share = F.col("cum_total_share")
    recut = chart.groupBy("feature").agg(
        F.coalesce(F.min(F.when(share > 1 - max_high, F.col("min_score"))), F.lit(1.0)).alias("_rh"),
        F.coalesce(F.min(F.when(share > min_low, F.col("min_score"))), F.lit(0.0)).alias("_rl"))
    sized = thresholds.join(level_sizes(df, thresholds, scores), "feature").join(recut, "feature")
    return sized.select(
        "feature", F.when(F.col("n_high") / F.col("n") > max_high, F.col("_rh")).otherwise(F.col("high")).alias("high"),
        F.when(F.col("n_low") / F.col("n") < min_low, F.col("_rl")).otherwise(F.col("low")).alias("low"))


def evaluate_cutoffs(df: DataFrame, high: float, low: float, score: str = "score", label: str = "label") -> DataFrame:
    above, below = F.col(score) >= high, F.col(score) <= low
    true_total = F.sum(label)
    return df.agg(
        (F.sum(F.when(above, F.col(label)).otherwise(0)) / true_total).alias("recall"),
        (F.sum(F.when(below, F.col(label)).otherwise(0)) / true_total).alias("misclass"),
        F.avg(F.when(above, 1.0).otherwise(0.0)).alias("high_share"),
        F.avg(F.when(below, 1.0).otherwise(0.0)).alias("low_share"))

"""Cluster statistics: moments, ranges, histograms, comparisons, quality.

Points are aggregated to one row per cluster (and bin) at once; everything after that works
on those few rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.ranks import quantile_lists, quantile_values

KL_EPSILON = 1e-4


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "feature", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(cols), name, value)


def cluster_stats(df: DataFrame, cluster: str, cols: Sequence[str]) -> DataFrame:
    """(cluster, feature): mean, spread (0 for a single row), min and max."""
    wide = df.groupBy(cluster).agg(*[F.struct(
        F.avg(c).alias("mean"), F.coalesce(F.stddev_samp(c), F.lit(0.0)).alias("sd"), F.min(c).alias("min"), F.max(c).alias("max")).alias(c) for c in cols])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("s")) for c in cols]))
    return wide.select(cluster, rows.alias("r")).select(cluster, "r.feature", "r.s.*")


def cluster_counts(df: DataFrame, cluster: str, alerts: str, true_alerts: str) -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"), F.sum(alerts).alias("alerts"), F.sum(true_alerts).alias("true_alerts"))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact population quantiles, one row per feature and probability."""
    return quantile_values(df, cols, probs)


def range_compare(df: DataFrame, cluster: str, cols: Sequence[str], low_share: float = 0.2, high_share: float = 0.2,
                  high_thr: float = 0.3, low_thr: float = 0.3) -> DataFrame:
    """Where a cluster sits in the population's range of each feature: shares in the low and
    high end and on both sides of the mean, a level H / M / L and a score."""
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    ends = quantile_lists(df, cols, [low_share, 1 - high_share])
    aggs = []
    for c in cols:
        lo, hi = ends[c]
        x = F.col(c)
        aggs.append(F.struct(*[F.avg(F.when(cond, 1.0).otherwise(0.0)).alias(n) for n, cond in (
            ("low_value", x <= lo), ("high_value", x >= hi), ("smaller_than_mean", x < means[c]), ("greater_than_mean", x > means[c]))]).alias(c))
    wide = df.groupBy(cluster).agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("s")) for c in cols]))
    long = wide.select(cluster, rows.alias("r")).select(cluster, "r.feature", "r.s.*")
    high, low = F.col("high_value") >= high_thr, F.col("low_value") < low_thr
    level = (F.when(high & low, "H").when(high & (F.col("greater_than_mean") > F.col("smaller_than_mean")), "H")
             .when(~high & low, "M").otherwise("L"))
    base = F.col("high_value") - F.col("low_value")
    up, down = (1 - high_thr) / low_thr, (1 - low_thr) / high_thr
    return long.withColumn("comparison", level).withColumn(
        "comparison_score", F.when(F.col("comparison") == "L", base).when(F.col("comparison") == "M", base + up - 1).otherwise(base + up + down))


def severity(compared: DataFrame, levels: Mapping[float, str], lowest: str, high_thr: float = 0.3, epsilon: float = KL_EPSILON) -> DataFrame:
    """Severity of features marked H: share in the high end over the threshold, on a ladder."""
    ratio = F.when(F.col("comparison") == "H", (F.col("high_value") + epsilon) / high_thr).otherwise(0.0)
    out = compared.withColumn("severity_ratio", ratio)
    step = None
    for bound, name in sorted(levels.items(), reverse=True):
        cond = F.col("severity_ratio") >= bound
        step = F.when(cond, name) if step is None else step.when(cond, name)
    return out.withColumn("severity_level", step.otherwise(lowest))


def equal_width_splits(df: DataFrame, cols: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Bin edges per feature: one aggregate, two numbers per feature on the driver; none for a feature without values."""
    row = df.agg(*[f(c).alias(f"{c}_{n}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))]).first()
    out = {}
    for c in cols:
        if row[f"{c}_lo"] is None:
            out[c] = []
            continue
        lo, hi = float(row[f"{c}_lo"]), float(row[f"{c}_hi"])
        if lo == hi:
            hi = lo + 10.0
        width = (hi - lo) / bins
        out[c] = [lo + i * width for i in range(bins)] + [hi]
    return out


def bin_of(value: Column, edges: Column) -> Column:
    """Bin number from 0: ``[x, y)``, the last one closed; null outside and without edges."""
    last = F.size(edges) - 1
    passed = F.size(F.filter(edges, lambda e, i: (i > 0) & (i < last) & (value >= e)))
    return F.when((value >= F.get(edges, F.lit(0))) & (value <= F.get(edges, last)), passed)


def bucket(col: Column, splits: Sequence[float]) -> Column:
    """Bin number of ``bin_of`` for edges known beforehand."""
    return bin_of(col, F.lit(list(splits))) if splits else F.lit(None).cast("int")


def long_values(df: DataFrame, keep: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """(keep, feature, value): one row for each of the columns."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols]))
    return df.select(*keep, each.alias("_v")).select(*keep, "_v.feature", "_v.value")


def edge_table(df: DataFrame, splits: Mapping[str, Sequence[float]]) -> DataFrame:
    """(feature, edges): one row for each column, so small whatever the data."""
    rows = [(c, [float(x) for x in s]) for c, s in splits.items()]
    return F.broadcast(df.sparkSession.createDataFrame(rows, "feature string, edges array<double>"))


def histogram(df: DataFrame, cluster: str, cols: Sequence[str], splits: Mapping[str, Sequence[float]]) -> DataFrame:
    """(cluster, feature, bin): count and density; empty bins included, a feature without edges has none.

    Every value becomes one (cluster, feature, bin), counted before the shuffle, so the plan does
    not grow with the number of columns and the shuffle not with the rows.
    """
    edges = edge_table(df, splits)
    counts = long_values(df, [cluster], cols).join(edges, "feature").groupBy(cluster, "feature", bin_of(F.col("value"), F.col("edges")).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    found = F.map_from_entries(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "n"))))
    per = counts.groupBy(cluster, "feature").agg(found.alias("found"), F.sum(F.when(F.col("bin").isNotNull(), F.col("n"))).alias("total"))
    bins = F.when(F.size("edges") > 1, F.sequence(F.lit(0), F.size("edges") - 2))
    every = F.transform(bins, lambda i: F.coalesce(F.try_element_at("found", i), F.lit(0)).cast("bigint"))
    return per.join(edges, "feature").select(cluster, "feature", F.coalesce("total", F.lit(0)).alias("total"), F.posexplode(every).alias("bin", "n")).withColumn(
        "density", F.try_divide("n", "total"))


def categorical_histogram(df: DataFrame, cluster: str, col: str) -> DataFrame:
    counts = df.groupBy(cluster, F.col(col).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(cluster))       # one row per category
    return counts.withColumn("total", total).withColumn("density", F.col("n") / F.col("total"))


def kl_compare(hist: DataFrame, cluster: str, epsilon: float = KL_EPSILON) -> DataFrame:
    """Divergence of each cluster's histogram from the rest of the population, scaled by the
    largest absolute value over all clusters and features."""
    per_bin = Window.partitionBy("feature", "bin")
    per_cluster = Window.partitionBy(cluster, "feature")
    rest = hist.withColumn("_bin_all", F.sum("n").over(per_bin)).withColumn("_total", F.sum("n").over(per_cluster))
    overall = hist.groupBy("feature").agg(F.sum("n").alias("_all"))
    n, total = F.col("n"), F.col("_total")
    term = n / total * F.log((n + epsilon) / total * (F.col("_all") - total) / (F.col("_bin_all") - n + epsilon))
    out = rest.join(overall, "feature").groupBy(cluster, "feature").agg(F.sum(term).alias("divergence"))
    top = F.max(F.abs("divergence")).over(Window.partitionBy())   # one row per cluster and feature
    return out.withColumn("scaled", F.col("divergence") / top)


def categorical_share(df: DataFrame, cluster: str, col: str) -> DataFrame:
    """Shares of every category per cluster as ``a(12.0%),b(88.0%)``, absent ones as 0.0%."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(cluster, col).agg(F.count(F.lit(1)).alias("n"))
    values = df.filter(F.col(col).isNotNull()).select(col).distinct().agg(F.array_sort(F.collect_list(col))).scalar()
    per = counts.groupBy(cluster).agg(F.map_from_entries(F.collect_list(F.struct(col, "n"))).alias("m"), F.sum("n").alias("total"))
    text = F.transform("values", lambda v: F.concat(
        v, F.lit("("), F.round(F.coalesce(F.element_at("m", v), F.lit(0)) / F.col("total") * 100).cast("string"), F.lit("%)")))
    return per.withColumn("values", values).select(cluster, F.array_join(text, ",").alias("shares"))


def named_clusters(df: DataFrame, cluster: str) -> DataFrame:
    """C1, C2 ... by cluster id; ranked on the distinct ids only."""
    names = df.select(cluster).distinct().select(cluster, F.concat(F.lit("C"), F.dense_rank().over(Window.orderBy(cluster))).alias("cluster_name"))
    return df.join(names, cluster)


def money_text(col: Column | str, digits: int = 4) -> Column:
    """A number as plain decimal text."""
    return F.col(col).cast(f"decimal(38,{digits})").cast("string") if isinstance(col, str) else col.cast(f"decimal(38,{digits})").cast("string")


def json_attributes(stats: DataFrame, cluster: str) -> DataFrame:
    """One row per cluster with its feature statistics as a JSON list, ordered by feature."""
    item = F.struct(F.col("feature").alias("name"), *[money_text(c).alias(c) for c in ("mean", "sd", "min", "max")], F.col("comparison"))
    return stats.groupBy(cluster).agg(F.to_json(F.array_sort(F.collect_list(item))).alias("attributes"))


def cluster_details(df: DataFrame, cluster: str, score: str, true_count: str, segment: str) -> DataFrame:
    """Size, mean score and true-alert yield of a cluster, with the same per segment as JSON."""
    part = df.groupBy(cluster, segment).agg(
        F.count(F.lit(1)).alias("n"), F.sum(score).alias("s"), F.count(F.when(F.col(true_count) > 0, True)).alias("t"))
    item = F.struct(F.col(segment).alias("segment"), F.col("n").alias("size"), money_text(F.col("s") / F.col("n")).alias("score"),
                    money_text(F.col("t") / F.col("n")).alias("yield"))
    return part.groupBy(cluster).agg(
        F.sum("n").alias("size"), (F.sum("s") / F.sum("n")).alias("severity_score"), (F.sum("t") / F.sum("n")).alias("yield_rate"),
        F.to_json(F.array_sort(F.collect_list(item))).alias("segments"))


def hist_percentile(edges: Column, density: Column, value: Column) -> Column:
    """Share of the histogram below a value, linear inside its bin, four decimals."""
    def part(i: Column) -> Column:
        lo, hi = F.element_at(edges, i), F.element_at(edges, i + 1)
        inside = F.least(F.greatest((value - lo) / (hi - lo), F.lit(0.0)), F.lit(1.0))
        return inside * F.element_at(density, i)
    total = F.aggregate(F.sequence(F.lit(1), F.size(density)), F.lit(0.0), lambda acc, i: acc + part(i))
    return F.when(value < F.element_at(edges, 1), 0.0).when(value >= F.element_at(edges, -1), 1.0).otherwise(F.round(total, 4))


def profile(df: DataFrame, series: Mapping[int, str], weights: Mapping[int, float], epsilon: float = KL_EPSILON) -> list[Column]:
    """Weighted mean of earlier windows, percent deviation of the current one, series as JSON."""
    mean = sum((F.col(series[d]) * w for d, w in weights.items()), F.lit(0.0)) / len(weights)
    now = F.col(series[0])
    items = F.array(*[F.struct(F.lit(str(d)).alias("range"), money_text(c, 2).alias("value")) for d, c in series.items()])
    return [mean.alias("profile_mean"), (100 * (now - mean) / (mean + epsilon)).alias("profile_deviation"), F.to_json(items).alias("amounts")]


BIN_SCHEMA = "array<struct<range:string, value:string>>"


def bins_to_json(edges: Column, density: Column, digits: int = 4) -> Column:
    """Histogram arrays as ``[{"range": "(lo, hi)", "value": "density"}, ...]``."""
    def item(d: Column, i: Column) -> Column:
        lo, hi = F.element_at(edges, i + 1), F.element_at(edges, i + 2)
        return F.struct(F.concat(F.lit("("), money_text(lo, digits), F.lit(", "), money_text(hi, digits), F.lit(")")).alias("range"),
                        money_text(d, digits).alias("value"))
    return F.to_json(F.transform(density, item))


def bins_from_json(text: Column) -> tuple[Column, Column]:
    """Edges and density back from that text."""
    bins = F.from_json(text, BIN_SCHEMA)
    pairs = F.transform(bins, lambda b: F.split(F.regexp_replace(b["range"], "[() ]", ""), ","))
    starts = F.transform(pairs, lambda p: p[0].cast("double"))
    last = F.element_at(F.element_at(pairs, -1), 2).cast("double")
    return F.concat(starts, F.array(last)), F.transform(bins, lambda b: b["value"].cast("double"))


def hist_arrays(hist: DataFrame, cluster: str, splits: Mapping[str, Sequence[float]]) -> DataFrame:
    """(cluster, feature) with edges and density arrays; a histogram has a handful of bins."""
    dens = F.transform(F.array_sort(F.collect_list(F.struct("bin", "density"))), lambda b: b["density"])
    return hist.groupBy(cluster, "feature").agg(dens.alias("density")).join(edge_table(hist, splits), "feature")


# ---- quality ---------------------------------------------------------------------------

def cluster_quality(df: DataFrame, cluster: str, cols: Sequence[str]) -> DataFrame:
    """Silhouette (squared Euclidean), Calinski-Harabasz and Davies-Bouldin.

    Rows without a cluster are left out; the columns hold no nulls. A measure that is not defined
    is null: all three below two clusters, Calinski-Harabasz if every cluster is a point,
    Davies-Bouldin if two clusters have one centre.
    """
    df = df.filter(F.col(cluster).isNotNull())
    if df.select(cluster).distinct().limit(2).count() < 2:
        names = ("silhouette", "calinski_harabasz", "davies_bouldin")
        return df.sparkSession.createDataFrame([(None,) * 3], ", ".join(f"{n} double" for n in names))
    vectors = VectorAssembler(inputCols=list(cols), outputCol="features").transform(df).select("features", F.col(cluster).cast("double").alias("prediction"))
    silhouette = ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(vectors)
    cents = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(f"_m_{c}") for c in cols])
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in cols])).scalar()
    sq = sum(((F.col(c) - F.col(f"_m_{c}")) ** 2 for c in cols), F.lit(0.0))
    per = df.join(cents, cluster).groupBy(cluster).agg(
        F.max("_n").alias("n"), F.sum(sq).alias("within"), F.avg(F.sqrt(sq)).alias("s"), *[F.max(f"_m_{c}").alias(c) for c in cols])
    off = sum(((F.col(c) - F.col(f"_g.{c}")) ** 2 for c in cols), F.lit(0.0))
    per = per.withColumn("_g", means).withColumn("between", F.col("n") * off).withColumn("center", F.array(*cols))
    # one array of centroids: as many entries as clusters
    packed = per.agg(F.sum("between").alias("b"), F.sum("within").alias("w"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
                     F.collect_list(F.struct(F.col(cluster).alias("id"), "s", "center")).alias("cs"))

    def distance(a: Column, b: Column) -> Column:
        return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) ** 2), F.lit(0.0), lambda acc, x: acc + x))

    def worst(a: Column) -> Column:
        others = F.filter("cs", lambda b: b["id"] != a["id"])
        each = F.transform(others, lambda b: F.try_divide(a["s"] + b["s"], distance(a["center"], b["center"])))
        # the greatest, NaN and so null in the end if two centres are one
        return F.array_max(F.transform(each, lambda x: F.coalesce(x, F.lit(float("nan")))))
    db = F.nullif(F.aggregate(F.transform("cs", worst), F.lit(0.0), lambda acc, x: acc + x) / F.col("k"), F.lit(float("nan")))
    ch = F.try_divide(F.col("b") / (F.col("k") - 1), F.try_divide(F.col("w"), F.col("n") - F.col("k")))
    return packed.select(F.lit(float(silhouette)).alias("silhouette"), ch.alias("calinski_harabasz"), db.alias("davies_bouldin"))


def rand_index(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs of rows two labelings agree on, from the contingency counts alone."""
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))

    def pairs(x: Column) -> Column:
        return F.sum(x.cast("double") * (x - 1) / 2)      # bigint products overflow at some billion rows
    both = cells.agg(pairs(F.col("n")).alias("in_both"), F.sum("n").alias("rows"))
    in_a = cells.groupBy(a).agg(F.sum("n").alias("n")).agg(pairs(F.col("n"))).scalar()
    in_b = cells.groupBy(b).agg(F.sum("n").alias("n")).agg(pairs(F.col("n"))).scalar()
    all_pairs = F.col("rows").cast("double") * (F.col("rows") - 1) / 2
    return both.withColumn("in_a", in_a).withColumn("in_b", in_b).select(
        "in_both", "in_a", "in_b", F.when(all_pairs > 0, (all_pairs + 2 * F.col("in_both") - F.col("in_a") - F.col("in_b")) / all_pairs).alias("rand_index"))

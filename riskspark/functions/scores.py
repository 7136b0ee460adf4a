"""Combining the scores of several flows into one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.levels import HIGH, LOW, MEDIUM


def _sum(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def rescale(score: Column, raw: bool = False) -> Column:
    """Rule scores lie in [-1, 1]; bring them to [0, 1] unless a raw mode is chosen."""
    return score if raw else 0.5 * (1.0 + score)


def weighted(scores: Sequence[Column], weights: Sequence[Column]) -> Column:
    """Weighted mean of the scores that are present; null without any."""
    total = _sum([F.when(s.isNotNull(), w).otherwise(0.0) for s, w in zip(scores, weights)])
    return F.when(total != 0, _sum([F.coalesce(s * w, F.lit(0.0)) for s, w in zip(scores, weights)]) / total)


def weighted_by_flow(scores: Sequence[Column], weights: Sequence[float]) -> Column:
    return weighted(scores, [F.lit(w) for w in weights]) * 100.0


def weighted_by_level(scores: Sequence[Column], levels: Sequence[Column], by_level: Mapping[str, float]) -> Column:
    weights = [F.when(x == HIGH, by_level[HIGH]).when(x == MEDIUM, by_level[MEDIUM]).when(x == LOW, by_level[LOW]) for x in levels]
    return weighted(scores, weights) * 100.0


def raw_mode(static: Column, regulatory: Column, mode: str) -> Column:
    if mode == "static":
        return static * 100.0
    if mode == "regulatory":
        return regulatory * 100.0
    if mode == "average":
        return (static + regulatory) * 0.5 * 100.0
    raise ValueError(f"unknown raw mode {mode}")


def mean_present(scores: Sequence[Column]) -> Column:
    n = _sum([F.when(s.isNotNull(), 1).otherwise(0) for s in scores])
    return F.when(n > 0, _sum([F.coalesce(s, F.lit(0.0)) for s in scores]) / n)


def override(mandatory_static: Column, mandatory_regulatory: Column, value, otherwise: Column) -> Column:
    """Mandatory rules set a fixed value before anything is combined."""
    return F.when(F.coalesce(mandatory_static, F.lit(False)) | F.coalesce(mandatory_regulatory, F.lit(False)), F.lit(value)).otherwise(otherwise)


def sigmoid_scores(df: DataFrame, cols: Sequence[str], suffix: str = "_score") -> DataFrame:
    """1 / (1 + exp(-(x - mean) / sd)) per column; a spread of 0 or none counts as 1."""
    stats = df.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(c) for c in cols]).alias("s"))
    out = df.withColumn("_s", stats.scalar())
    made = []
    for c in cols:
        s = F.col(f"_s.{c}.s")
        spread = F.when(s.isNull() | F.isnan(s) | (s == 0), 1.0).otherwise(s)
        made.append((1.0 / (1.0 + F.exp(-(F.col(c) - F.col(f"_s.{c}.m")) / spread))).alias(c + suffix))
    return out.select(*df.columns, *made)


def weight_product(score: Column, weights: Sequence[Column | float]) -> Column:
    return reduce(lambda a, b: a * b, [w if isinstance(w, Column) else F.lit(float(w)) for w in weights], score.cast("double"))


def component_attributes(cluster: Column, model: Column) -> Column:
    return F.to_json(F.struct(cluster.cast("string").alias("CLUSTER_ID"), model.cast("string").alias("MODEL_ID")))

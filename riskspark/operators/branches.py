"""Splitting rows by decision-tree branch, and keeping or dropping scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MIN_BRANCH_ROWS = 50
MAP_SCHEMA = "array<struct<model_id:int, rule:string, branch_id:int, to_cluster:int>>"


def branch_map(df: DataFrame, min_rows: int = MIN_BRANCH_ROWS, model: str = "model_id", rule: str = "rule") -> DataFrame:
    """One row per branch: id by size (smallest first, ties by rule), and whether it is
    large enough to be clustered. Branches are the leaves of one tree, hence few."""
    sizes = df.groupBy(model, rule).count()
    order = Window.orderBy("count", model, rule)
    return sizes.select(model, rule, F.row_number().over(order).alias("branch_id"),
                        F.when(F.col("count") >= min_rows, 1).otherwise(0).alias("to_cluster"))


def branch_split(df: DataFrame, min_rows: int = MIN_BRANCH_ROWS, model: str = "model_id", rule: str = "rule") -> DataFrame:
    return df.join(branch_map(df, min_rows, model, rule), [model, rule], "left")


def branch_apply(df: DataFrame, stored: DataFrame, params: str = "model_parameters") -> DataFrame:
    """Branch maps kept as JSON text, applied to new rows by model and rule."""
    rows = stored.select(F.explode(F.from_json(params, MAP_SCHEMA)).alias("m")).select("m.*")
    return df.join(rows, ["model_id", "rule"], "left")


def ensure_prob(df: DataFrame, negative: str = "Prediction_Prob_0_tree", positive: str = "Prediction_Prob_1_tree", filler: float = 0.1) -> DataFrame:
    """Both class probabilities: one that a model of a single class did not write becomes ``filler``."""
    absent = {negative, positive} - set(df.columns)
    if len(absent) == 2:
        raise ValueError(f"neither {negative} nor {positive} is there")
    return df.withColumns({name: F.lit(filler) for name in absent})


def anomaly_filter(df: DataFrame, top_n: int | None, score: str, tie: str, past_alerts: str | None = None,
                   past_true: str | None = None) -> DataFrame:
    """Parties without past (true) alerts, then the ``top_n`` highest scores."""
    for col in (past_alerts, past_true):
        if col and col in df.columns:
            df = df.filter(F.col(col) == 0)
    return df.orderBy(F.desc(score), F.asc(tie)).limit(top_n) if top_n else df

"""Explanations: contributions per feature, their groups, and how composite features break down."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.operators.features import split_two_level
from riskspark.operators.shape import stamp

EXPLANATION = "array<struct<node_str:string, feature_name:string, feature_weight:double>>"
RATIO_CAP = ">10"


def parse_explanations(df: DataFrame, key: str, col: str) -> DataFrame:
    """Model explanation text -> one row per feature."""
    rows = df.select(key, F.explode(F.from_json(col, EXPLANATION)).alias("e"))
    return rows.select(key, F.col("e.feature_name").alias("feature"), F.col("e.feature_weight").alias("contribution"))


def normalise_abs(df: DataFrame, key: str, col: str = "contribution") -> DataFrame:
    """Contribution over the sum of absolute contributions of the key."""
    total = df.groupBy(key).agg(F.sum(F.abs(col)).alias("_t"))
    return df.join(total, key).withColumn(col, F.when(F.col("_t") != 0, F.col(col) / F.col("_t"))).drop("_t")


def group_contrib(df: DataFrame, key: str, groups: DataFrame, typologies: DataFrame) -> DataFrame:
    """Adds typology and group of each feature, and the contribution summed over both."""
    named = (df.join(typologies.select("feature", "typology"), "feature", "left").join(groups.select("feature", "group"), "feature", "left")
             .withColumn("typology", F.coalesce("typology", F.lit("OTHERS"))).withColumn("group", F.coalesce("group", F.lit("-99"))))
    per_group = named.groupBy("group", key).agg(F.sum("contribution").alias("group_contribution"))
    per_typology = named.groupBy("typology", "group", key).agg(F.sum("contribution").alias("typology_contribution"))
    return named.join(per_typology, ["typology", "group", key]).join(per_group, ["group", key])


def needs_breakdown(name: str, categories: Mapping[str, Sequence[str]]) -> bool:
    """Two-level features, and features of a category that is a union of others."""
    unions = {c for c, members in categories.items() if len(members) > 1}
    return split_two_level(name) is not None or not unions.isdisjoint(name.split("_"))


def components(name: str, categories: Mapping[str, Sequence[str]]) -> list[tuple[str, list[tuple[str, str]]]]:
    """(component, [(channel, feature)]) of a composite feature."""
    two = split_two_level(name)
    out = []
    for part in (two[1:] if two else (name,)):
        cat = next((c for c in part.split("_") if c in categories), None)
        channels = categories.get(cat, ()) if cat else ()
        out.append((part, [(c, part.replace(cat, c)) for c in channels] if len(channels) > 1 else []))
    return out


def amount_text(col: Column) -> Column:
    """1234567 -> "1.235 Million"; smaller numbers with up to three decimals."""
    def text(x: Column) -> Column:
        return F.round(x, 3).cast("string")
    return F.when(col >= 1e9, F.concat(text(col / 1e9), F.lit(" Billion"))).when(
        col >= 1e6, F.concat(text(col / 1e6), F.lit(" Million"))).otherwise(text(col))


def channel_info(name: str, categories: Mapping[str, Sequence[str]]) -> Column:
    """The components of a feature and the channels of each, with their values, as JSON."""
    def value(feature: str) -> Column:
        return amount_text(F.col(f"`{feature}`").cast("double"))
    empty = F.array().cast("array<struct<channelType:string,value:string>>")
    items = [F.struct(F.lit(part).alias("componentName"), value(part).alias("value"), (F.array(*[
        F.struct(F.lit(c).alias("channelType"), value(f).alias("value")) for c, f in channels]) if channels else empty).alias("channelInfo"))
        for part, channels in components(name, categories)]
    return F.to_json(F.array(*items))


def ratio_text(ratio: Column, numerator: Column, denominator: Column) -> Column:
    """A ratio for display: with nothing to divide by, any amount is "more than ten times"."""
    endless = (denominator == 0) & (numerator > 0)
    return F.when(endless, RATIO_CAP).otherwise(F.round(ratio, 3).cast("string"))


def explain_table(contrib: DataFrame, key: str, category: str, names: Mapping[str, str], at: Column | None = None) -> DataFrame:
    """Final explanation rows: display name, category and creation stamps."""
    pairs = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    out = contrib.withColumn("explainability_category", F.lit(category)).withColumn(
        "display_name", F.coalesce(F.element_at(pairs, F.col("feature")), F.col("feature")))
    return stamp(out.select(key, "feature", "display_name", "contribution", "typology", "typology_contribution", "group",
                            "group_contribution", "explainability_category"), at=at)

"""Report tables built from scores, alerts and customers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.operators.enrich import outer_all
from riskspark.operators.shape import latest
from riskspark.operators.store import KeyedStore

TRUE_RESULTS = ("str", "true", "1")
LEVELS = ("High", "Medium", "Low")
# prediction bucket -> alert level; anything else is Low
BUCKET_LEVELS = {"l3": "High", "l2": "Medium"}


def latest_component(components: DataFrame, keys: Sequence[str] = ("party", "component"), order: Sequence[str] = ("created", "score_id")) -> DataFrame:
    """Newest score per customer and component, with the ids from its JSON attributes."""
    newest = latest(components, list(keys), list(order))
    return newest.select(
        *[c for c in newest.columns if c != "attributes"],
        F.get_json_object("attributes", "$.CLUSTER_ID").alias("cluster_id"), F.get_json_object("attributes", "$.MODEL_ID").alias("model_id"))


def product_list(products: DataFrame, codes: DataFrame) -> DataFrame:
    """Distinct product names per party, the description where the code has one."""
    named = products.join(codes, "code", "left").select("party", F.coalesce("description", "code").alias("name")).distinct()
    return named.groupBy("party").agg(F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("products"))


def true_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("party").agg(F.count(F.when(F.lower("result").isin(*TRUE_RESULTS), True)).alias("str_latest"))


def history_upsert(previous: DataFrame, kyc: DataFrame, components: Mapping[str, DataFrame], trues: DataFrame, products: DataFrame,
                   run_date: Column) -> DataFrame:
    """The customer history after a run.

    The newest previous row of each customer meets the run's deltas; a new value replaces
    the old one, true-alert counts add up, and the level moves from current to previous.
    ``components``: ctb / nla / scr -> (party, score, reason[, level])."""
    newest = latest(previous, ["party"], ["created", "history_id"])
    parts = [newest, kyc.select("party", F.col("kyc_score").alias("kyc_new"), F.col("segment").alias("segment_new"))]
    for name, df in components.items():
        extra = [F.col("level").alias("level_new")] if "level" in df.columns else []
        parts.append(df.select("party", F.col("score").alias(f"{name}_new"), F.col("reason").alias(f"{name}_reason"), *extra))
    parts += [trues, products]
    merged = outer_all(parts, "party")
    reason = F.concat_ws(",", *[f"{n}_reason" for n in components])
    scores = [F.coalesce(f"{n}_new", f"{n}_score").alias(f"{n}_score") for n in components]
    level = F.coalesce("level_new", "risk_level")
    return merged.select(
        "party", F.coalesce("kyc_new", "kyc_score").alias("kyc_score"), F.coalesce("segment_new", "segment").alias("segment"), *scores,
        (F.coalesce("str_latest", F.lit(0)) + F.coalesce("str_count", F.lit(0))).alias("str_count"),
        F.coalesce("products", "product").alias("product"), F.coalesce(F.when(reason != "", reason), F.col("reason")).alias("reason"),
        F.coalesce("ctb_new", "ctb_score").alias("overall_score"), F.col("risk_level").alias("previous_risk_level"), level.alias("risk_level"), run_date.alias("created"))


def history_keys(kyc: DataFrame, components: Mapping[str, DataFrame], trues: DataFrame, products: DataFrame) -> DataFrame:
    """The customers that a run's deltas name."""
    found = [df.select("party") for df in (kyc, *components.values(), trues, products)]
    return reduce(DataFrame.unionByName, found).distinct()


def store_upsert(store: KeyedStore, kyc: DataFrame, components: Mapping[str, DataFrame], trues: DataFrame, products: DataFrame,
                 run_date: Column) -> int:
    """``history_upsert`` on a stored history: customers without a delta keep their row, and only the
    buckets of the others are read and written. The store has the columns that ``history_upsert`` gives."""
    def merge(previous: DataFrame) -> DataFrame:
        return history_upsert(previous.withColumn("history_id", F.lit(0)), kyc, components, trues, products, run_date)
    return store.upsert(history_keys(kyc, components, trues, products), merge)


def customers_profile(customers: DataFrame, intervals: DataFrame) -> DataFrame:
    """Customers with the newest high-risk record as JSON."""
    newest = latest(intervals.withColumn("_until", F.coalesce("expiry_date", F.lit("9999-12-31").cast("date"))), ["party"], ["_until", "start_date", "interval_id"])
    info = newest.select("party", F.to_json(F.struct(
        F.col("interval_id").cast("string").alias("id"), F.date_format("start_date", "yyyy-MM-dd").alias("start"),
        F.coalesce(F.date_format("expiry_date", "yyyy-MM-dd"), F.lit("open")).alias("expiry"))).alias("high_risk_info"))
    return customers.join(info, "party", "left")


def alert_level(bucket: Column) -> Column:
    out = F
    for name, level in BUCKET_LEVELS.items():
        out = out.when(F.lower(bucket) == name, level)
    return out.otherwise("Low")


def active_latest_links(links: DataFrame, alerted: DataFrame) -> DataFrame:
    """The newest active link per (party, linked party, relation) of alerted customers; alerted
    customers without any keep a row. One reference date per party bounds the join."""
    refs = alerted.groupBy("party").agg(F.max("alert_date").alias("ref_date"))
    active = links.join(refs, "party").filter(F.col("end_date").isNull() | (F.col("end_date") > F.col("ref_date")))
    newest = active.withColumn("until", F.coalesce("end_date", F.lit("9999-12-31").cast("date"))).groupBy(
        "party", "linked_party", "relation").agg(F.max(F.struct("until", "link_id")).alias("_l"))
    return newest.select("party", "linked_party", "relation", F.col("_l.link_id").alias("link_id")).join(refs, "party", "right")


def alerted_accounts(accounts: DataFrame, alerted: DataFrame, products: Mapping[str, DataFrame]) -> DataFrame:
    """Accounts of alerted customers; the product is the first of loan, deposit, card present.
    ``products``: kind -> (account, <kind>_key), unique per account."""
    out = accounts.join(alerted.select("party").distinct(), "party", "left_semi")
    for df in products.values():
        out = out.join(df, "account", "left")
    keys = [f"{k}_key" for k in products]
    kind = F.coalesce(*[F.when(F.col(k).isNotNull(), F.lit(n)) for n, k in zip(products, keys)])
    return out.withColumn("product_id", F.coalesce(*keys)).withColumn("product_kind", kind).drop(*keys)


def level_counts(df: DataFrame, level: str, label: str, prefix: str) -> DataFrame:
    return df.groupBy(F.coalesce(level, F.lit("NaN")).alias("risk")).agg(
        F.count(F.lit(1)).alias(f"{prefix}_all"), F.count(F.when(F.col(label) == 1, True)).alias(f"{prefix}_true"),
        F.count(F.when(F.col(label) == 0, True)).alias(f"{prefix}_false"))


def overall(df: DataFrame, ours: str, theirs: str, label: str) -> DataFrame:
    """Counts, shares and true alerts per level in both systems."""
    both = level_counts(df, ours, label, "ours").join(level_counts(df, theirs, label, "bank"), "risk", "full").na.fill(0)
    total = df.agg(F.count(F.lit(1))).scalar()
    return both.select("risk", *[F.col(f"{p}_all").alias(p) for p in ("ours", "bank")],
                       *[F.round(F.col(f"{p}_all") * 100.0 / total, 2).alias(f"{p}_pct") for p in ("ours", "bank")], "ours_true", "bank_true")


def by_segment(df: DataFrame, segment: str, systems: Mapping[str, str]) -> DataFrame:
    """Level counts per segment, the systems stacked. Levels are fixed, so no pivot scan."""
    out = None
    for name, level in systems.items():
        part = df.groupBy(F.coalesce(segment, F.lit("not specified")).alias("segment")).agg(
            *[F.count(F.when(F.col(level) == x, True)).alias(x.lower()) for x in LEVELS], F.count(F.when(F.col(level).isNull(), True)).alias("none"))
        part = part.withColumn("system", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def level_vs_label(df: DataFrame, ours: str, theirs: str, label: str) -> DataFrame:
    return level_counts(df, theirs, label, "bank").drop("bank_all").join(level_counts(df, ours, label, "ours").drop("ours_all"), "risk", "full").na.fill(0)


def shifts(df: DataFrame, before: str, after: str, trues: str) -> DataFrame:
    """How many customers move between levels, with their past true alerts."""
    moved = df.filter(F.col(before).isNotNull() & F.col(after).isNotNull() & (F.col(before) != F.col(after)))
    return moved.groupBy(F.concat_ws("-", before, after).alias("shift")).agg(F.count(F.lit(1)).alias("number"), F.sum(F.coalesce(trues, F.lit(0))).alias("true_alerts"))


def history_counts(parties: DataFrame, history: DataFrame, label: Column) -> DataFrame:
    counts = history.withColumn("_l", label).groupBy("party").agg(
        F.count("_l").alias("past"), F.count(F.when(F.col("_l") == 0, True)).alias("past_false"), F.count(F.when(F.col("_l") == 1, True)).alias("past_true"))
    return parties.join(counts, "party", "left")


def next_version(versions: DataFrame, metadata: Mapping[str, Column]) -> DataFrame:
    """One row: the last version + 0.01 (1.0 for the first run) with the run's metadata."""
    last = F.max("version")
    return versions.agg(F.coalesce(F.round(last + 0.01, 2), F.lit(1.0)).alias("version")).select("version", *[c.alias(n) for n, c in metadata.items()])


def expand_codes(codes: DataFrame, limits: Mapping[str, Sequence[object]], cols: Sequence[str] = ("code", "description")) -> DataFrame:
    """``{}`` in a code is filled with the limits configured for the first token it holds."""
    def filled(col: str) -> Column:
        out = F
        for token, values in limits.items():
            text = F.col(col)
            for v in values:
                text = F.regexp_replace(text, r"^(.*?)\{\}", f"$1{v}")
            out = out.when(F.col(cols[0]).contains(token), text)
        return out.otherwise(F.col(col))
    return codes.select(*[c for c in codes.columns if c not in cols], *[filled(c).alias(c) for c in cols]).distinct()

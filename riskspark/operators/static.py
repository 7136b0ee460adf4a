"""Static features of parties, accounts and links at reference dates.

Everything that depends on both a link and a date is written as dated steps (see
``running_steps``): a link, an account or a risk interval switches a count on at one date
and off at another. Nothing joins reference dates to links, so a party with very many
links costs one row per link and step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.lookback import running_steps

ALWAYS = "1900-01-01"
NEVER = "9999-12-31"
YEAR_DAYS = 365.25


def _date(text: str) -> Column:
    return F.lit(text).cast("date")


def on_off(df: DataFrame, key: str, on: Column, off: Column, name: str, weight: Column | None = None) -> DataFrame:
    """Rows (key, day, step) that add ``weight`` from ``on`` until the day before ``off``."""
    w = F.lit(1) if weight is None else weight
    pair = F.array(F.struct(on.alias("day"), w.cast("bigint").alias(name)),
                   F.struct(off.alias("day"), (-w).cast("bigint").alias(name)))
    return df.filter(on < off).select(key, F.explode(pair).alias("m")).select(key, "m.day", f"m.{name}")


def _merge(parts: Sequence[DataFrame], names: Sequence[str], key: str) -> DataFrame:
    out = None
    for part in parts:
        full = part.select(key, "day", *[F.col(n) if n in part.columns else F.lit(0).cast("bigint").alias(n) for n in names])
        out = full if out is None else out.unionByName(full)
    return out


def account_counts(accounts: DataFrame) -> DataFrame:
    return accounts.groupBy("party").agg(F.count("account").alias("number_of_accounts"))


def accounts_opened(accounts: DataFrame, refs: DataFrame, year_days: float = YEAR_DAYS) -> DataFrame:
    """Accounts opened, and opened and closed again, within a year before the reference."""
    last = F.date_add("open_date", int(year_days) + 1)
    opened = on_off(accounts, "party", F.col("open_date"), last, "opened_360")
    closed = on_off(accounts.filter(F.col("open_date") < F.col("closed_date")), "party",
                    F.date_add("closed_date", 1), last, "opened_closed_360")
    names = ["opened_360", "opened_closed_360"]
    return running_steps(_merge([opened, closed], names, "party"), refs, names)


def link_pairs(links: DataFrame) -> DataFrame:
    """One row per (party, linked party) with the date its latest link ends."""
    return links.groupBy("party", "linked_party").agg(F.max(F.coalesce("end_date", _date(NEVER))).alias("until"))


def active_links(links: DataFrame, refs: DataFrame) -> DataFrame:
    moves = on_off(link_pairs(links), "party", _date(ALWAYS), F.col("until"), "active_links")
    return running_steps(moves, refs, ["active_links"])


def over_links(pairs: DataFrame, dated: DataFrame, refs: DataFrame, names: Sequence[str]) -> DataFrame:
    """Sum over the links active at each reference of what the linked parties hold on that day.

    ``dated`` (linked_party, on, off, names ...) adds its values from ``on`` until the day before
    ``off``. A link costs the smaller of two numbers: the dated rows of its linked party, as
    steps of the party, or the references of its party, each with one look-up of a running sum
    of the linked party. A hub on either side makes no product, and links of parties
    without reference, or to parties without dated rows, cost nothing."""
    asked = refs.groupBy("party").agg(F.count(F.lit(1)).alias("_refs"))
    held = dated.groupBy("linked_party").agg(F.count(F.lit(1)).alias("_rows"))
    sized = pairs.join(asked, "party").join(held, "linked_party").withColumn("_steps", F.col("_rows") <= F.col("_refs"))
    by_steps = sized.filter("_steps").select("party", "linked_party", "until").join(dated, "linked_party")
    stepped = running_steps(_steps(by_steps, "party", F.least("off", "until"), names), refs, names)
    looks = sized.filter("not _steps").select("party", "linked_party", "until").join(refs.select("party", "ref_date"), "party").filter("ref_date < until")
    values = running_steps(_steps(dated, "linked_party", F.col("off"), names), looks.select("linked_party", "ref_date").distinct(), names, "linked_party")
    looked = looks.join(values, ["linked_party", "ref_date"]).groupBy("party", "ref_date").agg(*[F.sum(n).alias(f"_{n}") for n in names])
    return stepped.join(looked, ["party", "ref_date"], "left").select(
        "party", "ref_date", *[(F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in names])


def _steps(rows: DataFrame, key: str, off: Column, names: Sequence[str]) -> DataFrame:
    both = F.array(F.struct(F.col("on").alias("day"), *names), F.struct(off.alias("day"), *[(-F.col(n)).alias(n) for n in names]))
    return rows.filter(F.col("on") < off).select(key, F.explode(both).alias("m")).select(key, "m.*")


def linked_alerts(links: DataFrame, alerts: DataFrame, refs: DataFrame, true_result: str = "F", days: int = 360) -> DataFrame:
    """Alerts and true alerts of actively linked parties in the look-back, and how many of
    those parties have at least one true alert."""
    daily = alerts.groupBy(F.col("party").alias("linked_party"), "alert_date").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("result") == true_result, True)).alias("t"))
    ahead = F.lead("alert_date").over(Window.partitionBy("linked_party").orderBy("alert_date"))
    off = F.date_add("alert_date", days)
    names = ["linked_alerts", "linked_true_alerts", "linked_with_true_alert"]
    zero = F.lit(0).cast("bigint")
    counts = daily.select("linked_party", F.col("alert_date").alias("on"), off.alias("off"), F.col("n").alias(names[0]), F.col("t").alias(names[1]), zero.alias(names[2]))
    flags = daily.filter("t > 0").withColumn("_next", ahead).select(
        "linked_party", F.col("alert_date").alias("on"), F.least(off, "_next").alias("off"), zero.alias(names[0]), zero.alias(names[1]), F.lit(1).cast("bigint").alias(names[2]))
    return over_links(link_pairs(links), counts.unionByName(flags), refs, names)


def disjoint_intervals(intervals: DataFrame, key: str, start: str = "start_date", expiry: str = "expiry_date") -> DataFrame:
    """Intervals of each key cut so that they cover the same days without overlapping;
    ``off`` is the first day after. One interval per start day survives, which bounds a key."""
    off = F.coalesce(F.date_add(F.col(expiry), 1), _date(NEVER))
    ends = intervals.groupBy(key, start).agg(F.max(off).alias("off"))
    before = Window.partitionBy(key).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    on = F.greatest(F.col(start), F.coalesce(F.max("off").over(before), F.col(start)))
    return ends.select(key, on.alias("on"), "off").filter("on < off")


def linked_risk(links: DataFrame, intervals: DataFrame, risky_country_parties: DataFrame, refs: DataFrame) -> DataFrame:
    """Actively linked parties that are high-risk on the date, or sit in a high-risk country."""
    names = ["linked_high_risk_party", "linked_high_risk_country"]
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    spans = disjoint_intervals(intervals, "party").select(F.col("party").alias("linked_party"), "on", "off", one.alias(names[0]), zero.alias(names[1]))
    seats = risky_country_parties.select(F.col("party").alias("linked_party")).distinct().select(
        "linked_party", _date(ALWAYS).alias("on"), _date(NEVER).alias("off"), zero.alias(names[0]), one.alias(names[1]))
    return over_links(link_pairs(links), spans.unionByName(seats), refs, names)


def account_age(rows: DataFrame, at: str, year_days: float = YEAR_DAYS) -> DataFrame:
    """Years from opening to closing, or to the given date while open."""
    end = F.coalesce(F.col("closed_date"), F.col(at))
    return rows.withColumn("account_age", (F.datediff(end, F.col("open_date")) / year_days).cast("int"))

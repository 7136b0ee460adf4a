"""Train / validation splits that come out the same on every run.

Rows are ordered by a hash of their id instead of a random number. Counts per hash prefix
tell where the wanted share ends, and rows are ranked only inside one prefix, so a stratum
with a third of all rows is spread over thousands of small groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date, timedelta
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: limits of the validation share, in percent
DEFAULT_VALID_PERC = 20.0
MIN_VALID_PERC = 5.0
MAX_VALID_PERC = 45.0
DEFAULT_OLD_VALID_PERC = 100.0
MODES = ("lookback_memory", "lookback", "stratified", "random")


def row_hash(row_id: str, purpose: str = "") -> Column:
    """Hash of the id and of what the draw is for: draws for two purposes are independent.
    The purpose may hold a seed."""
    return F.md5(F.concat(F.col(row_id).cast("string"), F.lit(purpose)))


def mark_share(df: DataFrame, row_id: str, pct: float, strata: Sequence[str] = (), rounding: str = "ceil",
               digits: int = 4, name: str = "is_valid", purpose: str = "") -> DataFrame:
    """Marks ``pct`` percent of the rows of each stratum, the first in hash order."""
    keyed = df.withColumn("_h", row_hash(row_id, purpose)).withColumn("_p", F.substring("_h", 1, digits))
    sizes = keyed.groupBy(*strata, "_p").agg(F.count(F.lit(1)).alias("_n"))
    # one row per stratum and prefix
    ordered = Window.partitionBy(*strata).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.sum("_n").over(Window.partitionBy(*strata))
    share = whole * F.lit(pct) / 100.0
    quota = F.ceil(share) if rounding == "ceil" else F.floor(share + 0.5)
    bounds = sizes.select(*[F.col(c).alias(f"_s_{c}") for c in strata], F.col("_p").alias("_s__p"), F.coalesce(F.sum("_n").over(ordered), F.lit(0)).alias("_before"), quota.alias("_quota"))
    rank = F.row_number().over(Window.partitionBy(*strata, "_p").orderBy("_h", row_id))
    same = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in [*strata, "_p"]]
    joined = keyed.join(bounds, same).drop(*[f"_s_{c}" for c in [*strata, "_p"]])
    return joined.withColumn(name, F.col("_before") + rank <= F.col("_quota")).drop("_h", "_p", "_before", "_quota")


def split_random(df: DataFrame, row_id: str, pct: float, seed: str = "") -> DataFrame:
    return mark_share(df, row_id, pct, purpose=seed)


def can_stratify(df: DataFrame, target: str) -> bool:
    """At least two target values with at least two rows each."""
    if target not in df.columns:
        return False
    row = df.groupBy(target).count().agg(F.count(F.lit(1)).alias("k"), F.min("count").alias("least")).first()
    return row["k"] > 1 and row["least"] > 1


def split_stratified(df: DataFrame, row_id: str, pct: float, target: str, seed: str = "") -> DataFrame:
    """Keeps the shares of the target; random when the target does not allow that."""
    if not can_stratify(df, target):
        return split_random(df, row_id, pct, seed)
    return mark_share(df, row_id, pct, [target], rounding="half_up", purpose=seed)


def hold_out(df: DataFrame, parts: Sequence[tuple[Column, float]], row_id: str, target: str, seed: str = "") -> DataFrame:
    """Every row once. Of the rows under the first condition that holds, its percentage is
    for validation; rows under none (or whose condition is unknown) are for training."""
    number = F.lit(len(parts))
    for i, (condition, _) in reversed(list(enumerate(parts))):
        number = F.when(condition, i).otherwise(number)
    tagged = df.withColumn("_part", number)
    out = tagged.filter(F.col("_part") == len(parts)).withColumn("is_valid", F.lit(False))
    for i, (_, pct) in enumerate(parts):
        rows = tagged.filter(F.col("_part") == i)
        out = out.unionByName(rows.withColumn("is_valid", F.lit(True)) if pct == 100.0 else split_stratified(rows, row_id, pct, target, seed))
    return out.drop("_part")


def split_lookback(df: DataFrame, row_id: str, pct: float, target: str, date_col: str, months: float, seed: str = "") -> DataFrame:
    """Validation rows from the newest months alone; a row without date trains."""
    newest = df.agg(F.max(date_col)).scalar()
    return hold_out(df, [(F.col(date_col) > F.date_sub(newest, int(months * 30)), pct)], row_id, target, seed)


def split_memory(df: DataFrame, row_id: str, pct: float, target: str, date_col: str, months: float,
                 previous: DataFrame, previous_max: date, old_pct: float = DEFAULT_OLD_VALID_PERC, seed: str = "") -> DataFrame:
    """Remembers former validation rows: those still in the look-back make up one part, of
    which ``old_pct`` percent stay, all of them if no newer row has come; other rows newer
    than the previous training date are split anew; the rest trains."""
    newest = F.lit(df.agg(F.max(F.to_date(date_col))).first()[0])
    known = previous.select(F.col(row_id).alias("_former")).distinct()
    marked = df.join(known, F.col(row_id) == F.col("_former"), "left")
    day = F.to_date(date_col)
    former = F.col("_former").isNotNull() & (day > F.date_sub(newest, int(months * 30)))
    grown = df.filter(day > F.lit(previous_max)).limit(1).count() > 0
    parts = [(former, old_pct if grown else DEFAULT_OLD_VALID_PERC), (day > F.lit(previous_max), pct)]
    return hold_out(marked, parts, row_id, target, seed).drop("_former")


@dataclass(frozen=True)
class SplitParams:
    row_id: str
    target: str
    date_col: str | None = None
    valid_pct: float | None = None
    months: float | None = None
    previous: DataFrame | None = None
    previous_max: date | None = None
    old_pct: float | None = None
    max_pct: float = MAX_VALID_PERC
    seed: str = ""                                  # splits with different seeds draw independently


def _pct(value: float | None, least: float, most: float) -> float:
    if value is None or value < least:
        return DEFAULT_VALID_PERC
    return min(float(value), most)


def resolve_mode(df: DataFrame, mode: str, p: SplitParams) -> tuple[str, SplitParams]:
    """The mode that can be run and its checked parameters: memory falls back to look-back,
    that to stratified, that to random. All facts come from one-row aggregates."""
    if mode not in MODES:
        raise ValueError(f"unknown sampling mode {mode}")
    dated = p.date_col in df.columns if p.date_col else False
    if mode in MODES[:2] and not dated:
        return resolve_mode(df, "stratified", p)
    if mode in MODES[:2]:
        first, last = df.agg(F.min(F.to_date(p.date_col)), F.max(F.to_date(p.date_col))).first()
        if last is None:
            return resolve_mode(df, "stratified", p)
        span = round((last - first).days / 30, 1)
        months = p.months
        if months is None or months <= 0 or (span > 3 and months < 0.5):
            months = round(span / 2, 1)
        months = min(months, span)
        if mode == "lookback_memory":
            usable = p.previous is not None and p.row_id in df.columns and p.previous.limit(1).count()
            if p.previous_max is not None and usable and last < p.previous_max:
                raise ValueError("the data ends before the previous training date")
            if not usable or p.previous_max is None or first > p.previous_max:
                return resolve_mode(df, "lookback", p)
        else:
            recent = df.filter(F.col(p.date_col) > F.lit(last - timedelta(days=int(months * 30) or 60)))
            if not can_stratify(recent, p.target):
                return resolve_mode(df, "stratified", p)
        months, pct = _lookback_share(df, p, months, last)
        old = p.old_pct if p.old_pct is not None and 0 <= p.old_pct <= 100 else DEFAULT_OLD_VALID_PERC
        return mode, replace(p, months=months, valid_pct=pct, old_pct=round(float(old), 1))
    if mode == "stratified" and not can_stratify(df, p.target):
        return resolve_mode(df, "random", p)
    return mode, replace(p, valid_pct=_pct(p.valid_pct, MIN_VALID_PERC, p.max_pct))


def _lookback_share(df: DataFrame, p: SplitParams, months: float, last: date) -> tuple[float, float]:
    """Months of look-back and percentage that give the least validation share.

    The look-back must hold that share of the dated rows: the day on which the newest rows
    add up to it tells how many whole months are to be added. The percentage must then take
    that share out of the look-back."""
    asked = p.valid_pct if p.valid_pct and p.valid_pct > 0 else DEFAULT_VALID_PERC
    pct = min(round(float(asked), 1), p.max_pct)
    # one row for each calendar day
    days = df.select(F.to_date(p.date_col).alias("d")).filter("d IS NOT NULL").groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    total = days.agg(F.sum("n")).first()[0]
    least = ceil(total * MIN_VALID_PERC / 100)
    newer = F.sum("n").over(Window.orderBy(F.desc("d")))
    reached = days.withColumn("newer", newer).filter(F.col("newer") >= least).agg(F.max("d")).first()[0]
    # the first day inside is the one after last - 30 x months
    months += max(0, ceil(((last - reached).days + 1) / 30 - months))
    inside = days.filter(F.col("d") > F.lit(last - timedelta(days=int(months * 30)))).agg(F.sum("n")).first()[0]
    return months, pct if inside * pct >= total * MIN_VALID_PERC else round(100 * least / inside, 1)


def split(df: DataFrame, mode: str, p: SplitParams) -> tuple[DataFrame, str, SplitParams]:
    mode, p = resolve_mode(df, mode, p)
    if mode == "random":
        return split_random(df, p.row_id, p.valid_pct, p.seed), mode, p
    if mode == "stratified":
        return split_stratified(df, p.row_id, p.valid_pct, p.target, p.seed), mode, p
    if mode == "lookback":
        return split_lookback(df, p.row_id, p.valid_pct, p.target, p.date_col, p.months, p.seed), mode, p
    return split_memory(df, p.row_id, p.valid_pct, p.target, p.date_col, p.months, p.previous, p.previous_max, p.old_pct, p.seed), mode, p


def sample_strata(df: DataFrame, row_id: str, stratum: str, divisor: float, keep_below: int = 1000,
                  purpose: str = "strata") -> DataFrame:
    """Keeps a row with probability (share of its stratum / divisor); strata with fewer rows
    than ``keep_below`` are kept whole. The draw is a hash of the id."""
    named = df.na.fill("None", [stratum])
    sizes = named.groupBy(stratum).agg(F.count(F.lit(1)).alias("_n"))
    total = named.agg(F.count(F.lit(1))).scalar()
    fraction = F.when(F.col("_n") < keep_below, 1.0).otherwise(F.col("_n") / total / divisor)
    draw = F.conv(F.substring(row_hash(row_id, purpose), 1, 8), 16, 10).cast("bigint") / F.lit(float(2 ** 32))
    return named.join(sizes.select(stratum, fraction.alias("_f")), stratum).filter(draw < F.col("_f")).select(*df.columns)


def apply_split(features: DataFrame, champion: DataFrame, valid_ids: DataFrame, row_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, challenger validation, champion validation)."""
    ids = valid_ids.select(row_id).distinct()
    return features.join(ids, row_id, "left_anti"), features.join(ids, row_id, "left_semi"), champion.join(ids, row_id, "left_semi")

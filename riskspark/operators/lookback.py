"""Look-back joins and aggregates.

A fact is inside look-back ``days`` with ``offset`` of a reference date iff
``offset <= datediff(ref, fact) < days``.

Scale: references are distinct (party, date) points and facts are first summed per
(party, day, ...), so one party holding a third of all rows costs at most
(days of history) x (days of look-back) joined rows. The join key carries a time
block as wide as the look-back, which spreads such a party over many tasks and lets
the equi-join discard everything that cannot be in range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from riskspark.sources.session import written

MAX_HISTORY = 360
EPOCH = "1970-01-01"
STEP = "decimal(32,6)"        # exact, so that what is added can be taken away again
#: from so many reference points on, facts are dealt out by key to tasks of about so many points
MANY_POINTS, POINTS_OF_A_TASK = 500_000, 10_000


def time_block(date: Column | str, days: int) -> Column:
    return F.floor(F.datediff(date, F.lit(EPOCH).cast("date")) / F.lit(days)).cast("int")


def lookback_join(facts: DataFrame, refs: DataFrame, fact_date: str, ref_date: str = "ref_date",
                  key: str = "party", days: int = MAX_HISTORY, how: str = "inner") -> DataFrame:
    """Facts in ``(ref - days, ref]`` of each reference point of the same key.

    ``how='right'`` keeps reference points without facts. Adds ``days_before``.
    """
    if how not in ("inner", "right"):
        raise ValueError(f"how must be inner or right, not {how}")
    block = time_block(ref_date, days)
    left = facts.withColumn("_block", time_block(fact_date, days))
    right = refs.withColumn("_block", F.explode(F.array(block, block - 1)))
    gap = F.datediff(F.col(ref_date), F.col(fact_date))
    joined = (
        left.join(right, [key, "_block"])
        .withColumn("days_before", gap)
        .filter((F.col("days_before") >= 0) & (F.col("days_before") < days))
        .drop("_block")
    )
    if how == "right":
        joined = refs.join(joined, refs.columns, "left")
    return joined


@dataclass(frozen=True)
class Spec:
    """One first-level feature. ``flags`` name boolean columns of the facts."""
    name: str
    op: str                                  # AMT VOL MAX SD
    days: int
    offset: int = 0
    categories: tuple[str, ...] | None = None
    flags: tuple[str, ...] = ()
    category_col: str = "direction"
    source: str = "transactions"
    level: str = "CUSTOMER"
    under: int | None = None                 # the counter-party is younger at the reference (column birth_date)

    def shifted(self, shift: int, name: str) -> Spec:
        return replace(self, name=name, days=self.days + shift, offset=self.offset + shift)


def days_under(years: int) -> int:
    """Days after birth on which somebody is no longer younger than ``years`` (of 365.25 days)."""
    return -(-years * 1461 // 4)


def ends_of(refs: DataFrame, ref_date: str = "ref_date") -> Row:
    """First and last date and number of the reference points."""
    return refs.agg(F.min(F.col(ref_date).cast("date")).alias("first"), F.max(F.col(ref_date).cast("date")).alias("last"), F.count(F.lit(1)).alias("n")).first()


def dealt(rows: DataFrame, points: int, key: str) -> DataFrame:
    """``rows`` by key in tasks whose number grows with the points, if they are many. What groups
    by key follows in these tasks, also below each other or beside rows dealt for as many points."""
    return rows.repartition(-(-points // POINTS_OF_A_TASK), key) if points > MANY_POINTS else rows


def referenced(facts: DataFrame, refs: DataFrame, days: int, key: str = "party", date: str = "txn_date",
               ref_date: str = "ref_date", ends: Row | None = None, stored: bool = False) -> DataFrame:
    """Facts of referenced keys, from the first day that any look-back holds to the last.

    The two ends are literals, so the filter reaches the scan and skips partitions and row
    groups; the semi join stands below every shuffle of the facts and Spark moves it below
    the join that adds the key. Aggregates and windows by key follow in the tasks of that join, so
    with many references their number grows with the references: tasks that are merged up to a
    size of shuffled bytes hold several times as much in memory. ``stored`` is for facts that are
    read several times: what joins and filters them runs once. ``ends``: of ``refs``, if known."""
    ends = ends or ends_of(refs, ref_date)
    if ends["first"] is None:
        return facts.filter(F.lit(False))
    near = F.col(date).cast("date").between(F.lit(ends["first"] - timedelta(days=days)), F.lit(ends["last"]))
    rows, keys = facts.filter(near), refs.select(key).distinct()
    if stored:
        return dealt(written(rows.join(keys, key, "left_semi")), ends["n"], key)
    return dealt(rows, ends["n"], key).join(dealt(keys, ends["n"], key), key, "left_semi")


def daily_totals(facts: DataFrame, specs: Sequence[Spec], key: str = "party", date: str = "txn_date",
                 amount: str = "amount") -> DataFrame:
    """Facts summed to (key, day, the categories and flags the specs ask for): the finest
    grain any look-back needs. Map-side partial sums carry the load of hot keys."""
    dims = sorted({s.category_col for s in specs if s.categories} | {f for s in specs for f in s.flags} | {"birth_date" for s in specs if s.under})
    ops = {s.op for s in specs}
    measures = [F.count(F.lit(1)).alias("_n")]
    if "AMT" in ops:
        measures.append(F.sum(amount).alias("_sum"))
    if "MAX" in ops:
        measures.append(F.max(amount).alias("_max"))
    if "SD" in ops:
        value = F.col(amount).cast("double")
        measures += [F.sum(value).alias("_s1"), F.sum(value * value).alias("_s2")]
    return facts.groupBy(key, F.col(date).cast("date").alias(date), *dims).agg(*measures)


def _inside(spec: Spec) -> Column:
    p = (F.col("days_before") >= spec.offset) & (F.col("days_before") < spec.days)
    if spec.categories:
        p &= F.col(spec.category_col).isin(*spec.categories)
    for flag in spec.flags:
        p &= F.col(flag)
    if spec.under:
        p &= F.datediff("ref_date", "birth_date") < days_under(spec.under)
    return p


def spec_column(spec: Spec, among: Column | None = None) -> Column:
    """``among`` holds for the rows that the feature may read at all."""
    p = _inside(spec) if among is None else among & _inside(spec)
    n = F.coalesce(F.sum(F.when(p, F.col("_n"))), F.lit(0))
    if spec.op == "VOL":
        out = n.cast("bigint")
    elif spec.op == "AMT":
        out = F.coalesce(F.sum(F.when(p, F.col("_sum"))), F.lit(0)).cast("double")
    elif spec.op == "MAX":
        out = F.max(F.when(p, F.col("_max"))).cast("double")
    elif spec.op == "SD":
        s1, s2 = F.sum(F.when(p, F.col("_s1"))), F.sum(F.when(p, F.col("_s2")))
        out = spread(n, s1, s2)
    else:
        raise ValueError(f"unknown operation {spec.op}")
    return out.alias(spec.name)


def spread(n: Column, s1: Column, s2: Column) -> Column:
    """Sample standard deviation from count, sum and sum of squares; null below two rows."""
    variance = (s2 - s1 * s1 / n) / F.when(n > 1, n - 1)
    return F.when(n > 1, F.sqrt(F.greatest(variance, F.lit(0.0))))


def lookback_features(facts: DataFrame, refs: DataFrame, specs: Sequence[Spec], key: str = "party",
                      date: str = "txn_date", amount: str = "amount") -> DataFrame:
    """All first-level features of every reference point from one join and one aggregate."""
    longest = max(s.days for s in specs)
    daily = daily_totals(referenced(facts, refs, longest, key, date), specs, key, date, amount)
    return near_facts(daily, refs, date, key, longest).groupBy(key, "ref_date").agg(*[spec_column(s) for s in specs])


def near_facts(facts: DataFrame, refs: DataFrame, date: str, key: str, days: int) -> DataFrame:
    """Every reference point with the facts of its look-back, for an aggregate by point:
    points without facts keep rows of nulls, so no join back is needed."""
    block = time_block("ref_date", days)
    points = refs.select(key, "ref_date", F.explode(F.array(block, block - 1)).alias("_block"))
    rows = facts.withColumn("_fact_block", time_block(date, days)).withColumnRenamed(key, "_fact_key")
    gap = F.datediff(F.col("ref_date"), F.col(date))
    inside = (F.col(key) == F.col("_fact_key")) & (F.col("_block") == F.col("_fact_block")) & (gap >= 0) & (gap < days)
    return points.join(rows, inside, "left").drop("_fact_key", "_fact_block", "_block").withColumn("days_before", gap)


@dataclass(frozen=True)
class DistinctSpec:
    """Distinct values seen in a window, optionally only in rows where ``where`` holds, of
    the column ``value`` if it is not the one common to all."""
    name: str
    days: int
    offset: int = 0
    where: str | None = None
    value: str | None = None
    under: int | None = None


def distinct_in_lookback(facts: DataFrame, refs: DataFrame, value: str, specs: Sequence[DistinctSpec],
                         key: str = "party", date: str = "txn_date") -> DataFrame:
    """Exact distinct counts over sliding windows without joining references to rows."""
    ends = ends_of(refs)
    facts = referenced(facts, refs, max(s.days for s in specs), key, date, ends=ends)
    return running_steps(distinct_steps(facts, value, specs, key, date), refs, [s.name for s in specs], key, points=ends["n"])


def distinct_steps(facts: DataFrame, value: str, specs: Sequence[DistinctSpec], key: str, date: str) -> DataFrame:
    """Steps (key, day, one column per spec) whose running sums are distinct counts.

    A value active on day d is in the window of every reference in ``[d + offset, d + days)``,
    or until its counter-party is too old if that comes first. What an earlier day already
    covers is cut off, so each stretch adds +1 and -1 at two dates; the work is linear in the
    rows, and the running window of a key holds one row per calendar day.
    """
    kinds = sorted({(s.where or "true", s.value or value, bool(s.under)) for s in specs})
    tags = [F.when(F.expr(w), F.struct(F.lit(i).alias("w"), F.col(v).cast("string").alias("v"),
                                       (F.col("birth_date") if u else F.lit(None)).cast("date").alias("b"))) for i, (w, v, u) in enumerate(kinds)]
    active = facts.select(key, F.col(date).cast("date").alias("_day"), F.explode(F.array_compact(F.array(*tags))).alias("_t")) \
        .groupBy(key, F.col("_t.w").alias("_w"), F.col("_t.v").alias("_v"), "_day").agg(F.max("_t.b").alias("_b")).filter("_v is not null")
    before = Window.partitionBy(key, "_w", "_v").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)

    def stretch(s: DistinctSpec) -> tuple[Column, Column]:
        until = F.date_add("_day", s.days)
        if s.under:            # unknown age: in no window; a null start or end makes no step
            until = F.when(F.col("_b").isNotNull(), F.least(until, F.date_add("_b", days_under(s.under))))
        mine = F.when(F.col("_w") == kinds.index((s.where or "true", s.value or value, bool(s.under))), until)
        covered = F.max(mine).over(before)
        start = F.date_add("_day", s.offset)
        return F.coalesce(F.greatest(start, covered), start), mine

    ends = active.select(key, *[F.struct(*(c.alias(n) for c, n in zip(stretch(s), ("on", "off")))).alias(f"_s{i}") for i, s in enumerate(specs)])
    moves = [F.when(F.col(f"_s{i}.on") < F.col(f"_s{i}.off"), F.struct(F.col(f"_s{i}.{end}").alias("day"), F.lit(i).alias("i"), F.lit(sign).cast("bigint").alias("x")))
             for i in range(len(specs)) for end, sign in (("on", 1), ("off", -1))]
    return ends.select(key, F.explode(F.array_compact(F.array(*moves))).alias("m")).select(
        key, "m.day", *[F.when(F.col("m.i") == i, F.col("m.x")).alias(s.name) for i, s in enumerate(specs)])


def sum_steps(facts: DataFrame, specs: Sequence[Spec], key: str, date: str, amount: str) -> DataFrame:
    """Steps (key, day, one column per spec) whose running sums are amounts (AMT) or counts
    (VOL) of rows that count until the look-back ends or the counter-party is too old,
    whichever comes first. No reference meets a row."""
    dims = sorted({s.category_col for s in specs if s.categories} | {f for s in specs for f in s.flags} | {"birth_date"})
    daily = facts.groupBy(key, F.col(date).cast("date").alias("_day"), *dims).agg(
        F.count(F.lit(1)).cast(STEP).alias("_n"), F.sum(F.col(amount)).cast(STEP).alias("_a"))
    moves = []
    for i, s in enumerate(specs):
        p = F.lit(True)
        if s.categories:
            p &= F.col(s.category_col).isin(*s.categories)
        for flag in s.flags:
            p &= F.col(flag)
        on, off = F.date_add("_day", s.offset), F.date_add("_day", s.days)
        if s.under:
            p &= F.col("birth_date").isNotNull()
            off = F.least(off, F.date_add("birth_date", days_under(s.under)))
        x = F.col("_n" if s.op == "VOL" else "_a")
        moves += [F.when(p & (on < off), F.struct(day.alias("day"), F.lit(i).alias("i"), v.alias("x"))) for day, v in ((on, x), (off, -x))]
    return daily.select(key, F.explode(F.array_compact(F.array(*moves))).alias("m")).select(
        key, "m.day", *[F.when(F.col("m.i") == i, F.col("m.x")).alias(s.name) for i, s in enumerate(specs)])


def running_steps(moves: DataFrame, refs: DataFrame, names: Sequence[str], key: str = "party",
                  ref_date: str = "ref_date", types: Mapping[str, str] | None = None, points: int = 0) -> DataFrame:
    """Sum of all steps dated on or before each reference point.

    ``moves`` holds rows (key, day, steps ...). They are summed per (key, day) first, so
    the running window of one key never exceeds its calendar days. Steps are long integers
    where ``types`` does not name another exact type. Steps of facts that were dealt out for so many
    ``points`` are summed where they are made and meet the points there: none is shuffled."""
    kind = {n: (types or {}).get(n, "bigint") for n in names}
    daily = moves.groupBy(key, "day").agg(*[F.sum(f"`{n}`").cast(kind[n]).alias(n) for n in names]).withColumn("_ref", F.lit(0))
    marks = refs.select(key, F.col(ref_date).alias("day"), *[F.lit(0).cast(kind[n]).alias(n) for n in names],
                        F.lit(1).alias("_ref"))
    marks = dealt(marks, points, key)
    running = Window.partitionBy(key).orderBy("day", "_ref").rowsBetween(Window.unboundedPreceding, 0)
    return (
        daily.unionByName(marks)
        .select(key, F.col("day").alias(ref_date), "_ref", *[F.sum(f"`{n}`").over(running).alias(n) for n in names])
        .filter("_ref = 1").drop("_ref")
    )


def gap_days(facts: DataFrame, key: str, date: str) -> DataFrame:
    """Activity days (key, _day) with the days since the one before as ``_gap``."""
    days = facts.select(key, F.col(date).cast("date").alias("_day")).distinct()
    return days.withColumn("_gap", F.datediff("_day", F.lag("_day").over(Window.partitionBy(key).orderBy("_day"))))


def gap_column(spec: Spec, among: Column | None = None) -> Column:
    """Mean (AVG) or spread (SD) of the gaps whose two days are inside the window."""
    p = (F.col("days_before") >= spec.offset) & (F.col("days_before") + F.col("_gap") < spec.days)
    gap = F.when(p if among is None else among & p, F.col("_gap"))
    return (F.avg(gap) if spec.op == "AVG" else F.stddev_samp(gap)).alias(spec.name)


def gap_features(facts: DataFrame, refs: DataFrame, windows: Sequence[int], key: str = "party",
                 date: str = "txn_date") -> DataFrame:
    """Mean and spread of the days between consecutive activity days inside each window."""
    joined = near_facts(gap_days(referenced(facts, refs, max(windows), key, date), key, date), refs, "_day", key, max(windows))
    return joined.groupBy(key, "ref_date").agg(*[gap_column(Spec(f"TXN-GAP_{w}DAY_{op}", op, w)) for w in windows for op in ("AVG", "SD")])


def skew_safe_agg(df: DataFrame, key: str, amount: str, distinct: str) -> DataFrame:
    """Count, sum, max, spread and distinct count per key.

    Summed by (key, value) first and by key then: both aggregates combine before their
    shuffle, so a hot key meets as one row per task, and n, sum and sum of squares merge
    exactly (a mean of part spreads would not).
    """
    value = F.col(amount).cast("double")
    parts = df.groupBy(key, distinct).agg(
        F.count(F.lit(1)).alias("n"), F.sum(amount).alias("s"), F.max(amount).alias("m"), F.sum(value).alias("s1"), F.sum(value * value).alias("s2"))
    return parts.groupBy(key).agg(
        F.sum("n").alias("vol"), F.sum("s").cast("double").alias("amt"), F.max("m").cast("double").alias("max"),
        spread(F.sum("n"), F.sum("s1"), F.sum("s2")).alias("sd"), F.count(distinct).alias("distinct_count"))

"""Feature names and what they need.

Transactions: ``<category>_<look-back>[_OFFSET_<n>DAY][_<flag>]_<op>[_<level>]`` with AMT, VOL,
AVG, MAX, SD or DISTINCT-COUNT, or TXN-GAP with AVG or SD. Past alerts:
``[CDD-]ALERT|STR|FSTR_<look-back>[_OFFSET_<n>DAY]_COUNT[_<level>]``. Two-level names put
``ratio``, ``net`` or ``flow-through-adj`` in front of two of them. A token that is none of
these raises.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.operators import lookback as lb
from riskspark.operators.lookback import DistinctSpec, Spec

# fixed values: tokens of feature names
LOOKBACKS = {"DAILY": 1, "7DAY": 7, "15DAY": 15, "30DAY": 30, "60DAY": 60, "90DAY": 90, "180DAY": 180, "360DAY": 360}
MONTHS = {"3MONTH": ("90DAY", 3), "6MONTH": ("180DAY", 6), "12MONTH": ("360DAY", 12)}
OPERATIONS = ("AMT", "VOL", "AVG", "MAX", "SD")
TWO_LEVEL = ("ratio", "net", "flow-through-adj")
LEVELS = ("CUSTOMER", "ACCOUNT")
FLAG_COLUMNS = {
    "TO-HIGH-RISK-COUNTRY": "to_high_risk_country",
    "TO-HIGH-RISK-PARTY": "to_high_risk_party",
    "SAME-PARTY": "same_party",
    "TO-FOREIGN": "to_foreign",
    "DIFF-ACCT-BU": "diff_account_unit",
    "DIFF-ACCT-TYPE": "diff_account_type",
    "DIFF-ACCT-SEGMENT": "diff_account_segment",
    "DIFF-PARTY-TYPE": "diff_party_type",
    "WITH-PEP": "with_pep",
    "WITH-ADVERSE-NEWS": "with_adverse_news",
    "WITH-NGO": "with_ngo",
    "WITH-TAX-HAVEN": "with_tax_haven",
}
# fixed values: past alerts, as (source, flag)
ALERTS = {"ALERT": ("alerts", None), "STR": ("alerts", "is_true"), "FSTR": ("alerts", "is_false"),
          "CDD-ALERT": ("cdd_alerts", None), "CDD-STR": ("cdd_alerts", "is_true"), "CDD-FSTR": ("cdd_alerts", "is_false")}
AMOUNT_RANGE, AMOUNT_OVER = re.compile(r"(\d+)kto(\d+)k"), re.compile(r"greater-than-(\d+)k")
AGE_UNDER = re.compile(r"OPP-PARTY-AGE-UNDER-(\d+)")
COUNTRY_FLAGS = {"to_foreign", "to_high_risk_country"}
#: what is counted: accounts, or with a flag the countries or parties that the flag is about
DISTINCT_VALUES = {"account": "opp_account", "country": "opp_country", "party": "opp_party"}


def flag_of(token: str) -> str | None:
    """Fact column that a flag token stands for; ranges of the amount may have any limits."""
    if found := AMOUNT_RANGE.fullmatch(token):
        return f"amount_{found[1]}k_{found[2]}k"
    if found := AMOUNT_OVER.fullmatch(token):
        return f"amount_over_{found[1]}k"
    return FLAG_COLUMNS.get(token)


def with_amount_flags(facts: DataFrame, names: Sequence[str], amount: str) -> DataFrame:
    """Adds the amount ranges that feature names ask for and the facts lack."""
    made = {}
    for token in {t for n in names for t in n.split("_")}:
        column = flag_of(token)
        if column in facts.columns or not column:
            continue
        if found := AMOUNT_RANGE.fullmatch(token):
            made[column] = (F.col(amount) > int(found[1]) * 1000) & (F.col(amount) < int(found[2]) * 1000)
        elif found := AMOUNT_OVER.fullmatch(token):
            made[column] = F.col(amount) > int(found[1]) * 1000
    return facts.withColumns(made) if made else facts


@dataclass
class Plan:
    """The least work that yields the requested names."""
    first: list[Spec] = field(default_factory=list)
    distinct: list[Spec] = field(default_factory=list)
    gaps: list[Spec] = field(default_factory=list)
    averages: list[str] = field(default_factory=list)
    monthly: list[str] = field(default_factory=list)
    second: list[tuple[str, str, str, str]] = field(default_factory=list)


def parse_first(name: str, categories: Mapping[str, Sequence[str]], category_col: str = "direction", level: str | None = None) -> Spec:
    """``level`` is that of the key the features are made for; a name of another level raises."""
    days, offset, ops, cats, flags, after_offset = 0, 0, [], None, [], False
    at, alert, under = level or LEVELS[0], None, None
    for token in name.split("_"):
        if token in categories:
            cats = tuple(categories[token]) or None
        elif token in ALERTS:
            alert = ALERTS[token]
        elif token == "OFFSET":
            after_offset = True
        elif token in LOOKBACKS and after_offset:
            offset, after_offset = LOOKBACKS[token], False
        elif token in LOOKBACKS:
            days = LOOKBACKS[token]
        elif flag_of(token):
            flags.append(flag_of(token))
        elif found := AGE_UNDER.fullmatch(token):
            under = int(found[1])
        elif token in OPERATIONS or token in ("COUNT", "DISTINCT-COUNT", "TXN-GAP"):
            ops.append(token)
        elif token in LEVELS:
            if level and token != level:
                raise ValueError(f"feature {name} is of level {token}, the key of level {level}")
            at = token
        else:
            raise ValueError(f"unknown token {token} in feature {name}")
    if not days or not ops or after_offset:
        raise ValueError(f"feature {name} lacks a look-back, an offset or an operation")
    if alert:
        if ops != ["COUNT"] or cats or flags or under:
            raise ValueError(f"feature {name}: past alerts are counted and have no categories or flags")
        return Spec(name, "VOL", days, offset, None, (alert[1],) if alert[1] else (), category_col, alert[0], at)
    gap = "TXN-GAP" in ops
    if gap:
        ops.remove("TXN-GAP")
    if len(ops) != 1 or ops == ["COUNT"] or (gap and (ops[0] not in ("AVG", "SD") or under)):
        raise ValueError(f"feature {name}: operations {ops} do not go together here")
    return Spec(name, ops[0], days, offset, cats, tuple(flags), category_col, "transactions", at, under)


def split_two_level(name: str) -> tuple[str, str, str] | None:
    """``ratio_A_B`` -> (ratio, A, B); the first operand ends at its operation token."""
    head, _, rest = name.partition("_")
    if head not in TWO_LEVEL:
        return None
    tokens = rest.split("_")
    for i, token in enumerate(tokens):
        if (token in OPERATIONS or token in ("COUNT", "DISTINCT-COUNT")) and i + 1 < len(tokens):
            end = i + 1
            while end < len(tokens) and tokens[end] in LEVELS:
                end += 1
            return head, "_".join(tokens[:end]), "_".join(tokens[end:])
    raise ValueError(f"feature {name} has no second operand")


def plan_features(names: Sequence[str], categories: Mapping[str, Sequence[str]],
                  category_col: str = "direction", level: str | None = None) -> Plan:
    plan = Plan()
    seen: dict[str, None] = {}

    def need(name: str) -> None:
        if name in seen:
            return
        seen[name] = None
        two = split_two_level(name)
        if two:
            need(two[1])
            need(two[2])
            plan.second.append((name, *two))
        elif "MONTHLY_AVG" in name:
            month = next(m for m in MONTHS if m in name.split("_"))
            need(monthly_source(name, month))
            plan.monthly.append(name)
        elif "TXN-GAP" in name.split("_"):
            plan.gaps.append(parse_first(name, categories, category_col, level))
        elif "DISTINCT-COUNT" in name.split("_"):
            plan.distinct.append(parse_first(name, categories, category_col, level))
        elif "AVG" in name.split("_"):
            need(with_op(name, "AMT"))
            need(with_op(name, "VOL"))
            plan.averages.append(name)
        else:
            plan.first.append(parse_first(name, categories, category_col, level))

    for n in names:
        need(n)
    return plan


def with_op(name: str, op: str) -> str:
    return "_".join(op if t == "AVG" else t for t in name.split("_"))


def monthly_source(name: str, month: str) -> str:
    return name.replace("MONTHLY_AVG", "AMT").replace(month, MONTHS[month][0])


def ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def net(a: Column, b: Column) -> Column:
    return a - b


def flow_through(a: Column, b: Column) -> Column:
    """How much of the larger flow is matched by the smaller one; 0 without any flow."""
    return F.when(F.greatest(a, b) == 0, 0.0).otherwise(F.least(a, b) / F.greatest(a, b))


SECOND_LEVEL = {"ratio": ratio, "net": net, "flow-through-adj": flow_through}


def derive(df: DataFrame, plan: Plan) -> DataFrame:
    """Averages, monthly averages and two-level features from first-level columns."""
    def q(name: str) -> Column:
        return F.col(f"`{name}`")

    avg = [ratio(q(with_op(n, "AMT")), q(with_op(n, "VOL"))).alias(n) for n in plan.averages]
    monthly = []
    for n in plan.monthly:
        month = next(m for m in MONTHS if m in n.split("_"))
        monthly.append((q(monthly_source(n, month)) / MONTHS[month][1]).alias(n))
    out = df.select("*", *avg, *monthly)
    return out.select("*", *[SECOND_LEVEL[op](q(a), q(b)).alias(n) for n, op, a, b in plan.second])


def where_of(spec: Spec) -> str | None:
    """Rows that a feature reads, as SQL text over columns of the facts."""
    listed = [repr(c) for c in spec.categories or ()]
    parts = [f"{spec.category_col} in ({', '.join(listed)})"] if listed else []
    return " and ".join([*parts, *spec.flags]) or None


def counted(spec: Spec) -> str:
    """Which kind of value a distinct count is about."""
    if not spec.flags and not spec.under:
        return "account"
    return "country" if COUNTRY_FLAGS & set(spec.flags) else "party"


@dataclass(frozen=True)
class Source:
    """Dated rows that features are made of. ``keys`` maps a level to the column of its key."""
    rows: DataFrame
    date: str
    keys: Mapping[str, str]
    amount: str | None = None


def mixed_matrix(sources: Mapping[str, Source], refs: DataFrame, names: Sequence[str], categories: Mapping[str, Sequence[str]],
                 keys: Mapping[str, str], category_col: str = "direction", values: Mapping[str, str] = DISTINCT_VALUES) -> DataFrame:
    """One mixed list of names over several sources, per distinct row of ``refs``.

    ``sources``: ``transactions``, ``alerts`` and ``cdd_alerts`` as far as names need them, past
    alerts with boolean columns ``is_true`` and ``is_false``. ``refs`` holds ``ref_date`` and for
    each level of ``keys`` its key; a null key has no rows. Daily totals of every source and
    level and the gaps stand below each other with a tag, so all of these features come from
    one join and one aggregate; distinct counts and amounts by age come from one running sum.
    Rows of a source that several of these read are stored in the shared folder first.
    """
    plan = plan_features(names, categories, category_col)
    every = [*plan.first, *plan.distinct, *plan.gaps]
    if not every:
        raise ValueError("no feature asked for")
    levels = [v for v in LEVELS if any(s.level == v for s in every)]
    for s in every:
        if s.source not in sources or s.level not in keys or s.level not in sources[s.source].keys:
            raise ValueError(f"feature {s.name} needs {s.source} with a key of level {s.level}")
    refs = refs.select(*dict.fromkeys([*(keys[v] for v in levels), "ref_date"])).distinct()
    ends = lb.ends_of(refs)
    by_steps = {s.name for s in plan.first if s.under and s.op in ("AMT", "VOL")}

    def point(level: str, key: str) -> Column:       # null for a null key
        return F.concat(F.lit(f"{level}:"), F.col(key).cast("string"))

    def pass_of(s: Spec) -> str:
        """What reads the rows for a feature."""
        if s in plan.distinct:
            return "distinct"
        if s in plan.gaps:
            return f"gap {where_of(s) or 'true'}"
        return "steps" if s.name in by_steps else "totals"

    views: dict[tuple[str, str], DataFrame] = {}

    def rows_of(specs: Sequence[Spec], level: str) -> tuple[DataFrame, Source]:
        """Rows of referenced keys and dates, with the key of the points. Rows that are read in
        several passes are joined and filtered once: the columns that features need are stored."""
        name = specs[0].source
        src = sources[name]
        if (level, name) not in views:
            mine = [s for s in every if (s.level, s.source) == (level, name)]
            rows = with_amount_flags(src.rows, [s.name for s in mine], src.amount)
            marks = refs.select(point(level, keys[level]).alias("_point"), "ref_date")
            rows = rows.withColumn("_point", point(level, src.keys[level]))
            several = len({pass_of(s) for s in mine}) > 1
            if several:
                asked = [src.date, *([src.amount] if src.amount else [])]
                for s in mine:
                    asked += [*([s.category_col] if s.categories else []), *s.flags, *(["birth_date"] if s.under else []),
                              *([values[counted(s)]] if s in plan.distinct else [])]
                rows = rows.select("_point", *dict.fromkeys(asked))
            views[level, name] = lb.referenced(rows, marks, max(s.days for s in mine), "_point", src.date, ends=ends, stored=several)
        return views[level, name], src

    tall = [(v, F.col(keys[v]).isNotNull()) for v in levels]
    points = reduce(DataFrame.unionByName, [refs.filter(p).select(point(v, keys[v]).alias("_point"), "ref_date").distinct() for v, p in tall])
    made, moves, types = points, [], {}
    parts, columns, among = [], [], F.col("_kind")
    for level in levels:
        for name in sources:
            specs = [s for s in plan.first if (s.level, s.source) == (level, name)]
            totals, steps = [s for s in specs if s.name not in by_steps], [s for s in specs if s.name in by_steps]
            if totals:
                rows, src = rows_of(totals, level)
                day = lb.daily_totals(rows, totals, "_point", src.date, src.amount).withColumnRenamed(src.date, "_day")
                parts.append(day.withColumn("_kind", F.lit(f"{level} {name}")))
                columns += [lb.spec_column(s, among == f"{level} {name}") for s in totals]
            if steps:
                rows, src = rows_of(steps, level)
                moves.append(lb.sum_steps(rows, steps, "_point", src.date, src.amount))
                types |= {s.name: lb.STEP for s in steps if s.op == "AMT"}
        gaps: dict[str, list[Spec]] = {}
        for s in plan.gaps:
            if s.level == level:
                gaps.setdefault(where_of(s) or "true", []).append(s)
        for where, specs in gaps.items():
            rows, src = rows_of(specs, level)
            parts.append(lb.gap_days(rows.filter(where), "_point", src.date).withColumn("_kind", F.lit(f"{level} gap {where}")))
            columns += [lb.gap_column(s, among == f"{level} gap {where}") for s in specs]
        specs = [s for s in plan.distinct if s.level == level]
        if specs:
            rows, src = rows_of(specs, level)
            asked = [DistinctSpec(s.name, s.days, s.offset, where_of(s), values[counted(s)], s.under) for s in specs]
            moves.append(lb.distinct_steps(rows, values["party"], asked, "_point", src.date))
    if parts:
        longest = max(s.days for s in [*plan.first, *plan.gaps])
        below = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        made = lb.near_facts(below, points, "_day", "_point", longest).groupBy("_point", "ref_date").agg(*columns)
    if moves:
        below = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), moves)
        stepped = [s.name for s in every if s.name in by_steps or s in plan.distinct]
        running = lb.running_steps(below, points, stepped, "_point", types=types, points=ends["n"])
        made = made.join(running, ["_point", "ref_date"])
    doubles = [F.coalesce(F.col(f"`{n}`"), F.lit(0)).cast("double" if n in types else "bigint").alias(n) for n in made.columns if n in by_steps]
    made = made.select(*[F.col(f"`{n}`") for n in made.columns if n not in by_steps], *doubles)
    ids = refs.columns
    # each row of refs takes the features of a level from the point of that level; counts and amounts of a null key are 0
    none_is_zero = {s.name for s in plan.distinct} | {s.name for s in plan.first if s.op in ("AMT", "VOL")}

    def filled(s: Spec, v: Column) -> Column:
        return (F.coalesce(v, F.lit(0).cast("double" if s.op == "AMT" else "bigint")) if s.name in none_is_zero else v).alias(s.name)

    if len(levels) == 1:
        wide = refs.withColumn("_point", point(levels[0], keys[levels[0]])).join(made, ["_point", "ref_date"], "left")
        out = wide.select(*ids, *[filled(s, F.col(f"`{s.name}`")) for s in every])
    else:
        at = F.array(*[F.struct(F.lit(v).alias("_level"), point(v, keys[v]).alias("_point")) for v in levels])
        wide = refs.select(*ids, F.explode(at).alias("_at")).select(*ids, "_at.*").join(made, ["_point", "ref_date"], "left")
        out = wide.groupBy(*ids).agg(*[filled(s, F.max(F.when(F.col("_level") == s.level, F.col(f"`{s.name}`")))) for s in every])
    return derive(out, plan).select(*ids, *[F.col(f"`{n}`") for n in names])


def feature_matrix(facts: DataFrame, refs: DataFrame, names: Sequence[str], categories: Mapping[str, Sequence[str]],
                   key: str = "party", date: str = "txn_date", amount: str = "amount",
                   distinct_value: str = "opp_party", category_col: str = "direction", level: str = "CUSTOMER") -> DataFrame:
    """Every requested transaction feature per reference point, in the order asked for.

    ``key`` holds parties for level CUSTOMER and accounts for level ACCOUNT. One source and one
    level need neither tags nor points of their own; names of past alerts, gaps, ages or of a
    second level go through ``mixed_matrix``."""
    plan = plan_features(names, categories, category_col, level)
    if plan.gaps or any(s.under or s.source != "transactions" for s in [*plan.first, *plan.distinct]):
        source = Source(facts, date, {level: key}, amount)
        return mixed_matrix({"transactions": source}, refs, names, categories, {level: key}, category_col, dict.fromkeys(DISTINCT_VALUES, distinct_value))
    facts = with_amount_flags(facts, names, amount)
    out = refs
    if plan.first:
        out = lb.lookback_features(facts, refs, plan.first, key, date, amount)
    if plan.distinct:
        specs = [DistinctSpec(s.name, s.days, s.offset, where_of(s)) for s in plan.distinct]
        out = out.join(lb.distinct_in_lookback(facts, refs, distinct_value, specs, key, date), [key, "ref_date"], "left")
    return derive(out, plan).select(key, "ref_date", *[F.col(f"`{n}`") for n in names])

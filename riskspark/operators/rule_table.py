"""Rules kept as rows of a table, from the text of an indicator to scores and hits.

A rules table (rule_id, category, indicator, condition, value, features, norm_weight,
additional_filters) is configuration: it is read to the driver up to ``MAX_RULES`` rows, more
is an error. A rule with features tests those. A rule without features names a look-back in
its indicator ("Sum of Incoming transactions over past 30 Days"); its additional filters, an
object like ``{"TRANSACTION_TYPE": ["cash", "wire"]}``, replace the direction by these
categories. Equal indicators with equal filters share one feature.

Rules never become columns. Conditions form an index with one row for each feature, its
ranges sorted by their lower ends; a feature value finds by binary search which ranges begin
at or below it and tests only those. So 1,000 rules cost rows of hits, not 1,000 expressions.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.operators import lookback as lb
from riskspark.operators.rules import COMPARE, OPEN_MARGIN, Rule, RuleError, _number, parse_indicator

MAX_RULES = 10_000
FILTER_KEY = "TRANSACTION_TYPE"
COLUMNS = ("rule_id", "category", "indicator", "condition", "value", "features", "norm_weight", "additional_filters")
_CONDITION = ("feature string, rule_id string, category string, indicator string, weight double, need int, lo double, lo_open boolean, hi double, hi_open boolean, "
              "compare string, other string, texts array<string>, upper boolean")
LOWEST = float("-inf")


@dataclass
class RuleSet:
    """What a rules table asks for."""
    conditions: list[tuple]
    specs: list[lb.Spec]
    errors: list[tuple[str, str]]


def filters_of(text: str | None) -> list[str] | None:
    """Categories that additional filters name; None without filters."""
    if text is None or not text.strip():
        return None
    try:
        found = json.loads(text)[FILTER_KEY]
    except (ValueError, KeyError, TypeError) as exc:
        raise RuleError(f"additional filters {text!r} name no {FILTER_KEY}") from exc
    if not isinstance(found, list) or not found or not all(isinstance(v, str) for v in found):
        raise RuleError(f"additional filters {text!r} hold no list of categories")
    return found


def test_of(condition: str, value: str, known: Sequence[str]) -> tuple:
    """(lo, lo_open, hi, hi_open, compare, other, texts, upper) of one condition."""
    number, truth = _number(value), value.strip().upper() in ("TRUE", "FALSE")
    if condition == "IN BETWEEN":
        ends = [_number(v) for v in value.strip("[]() ").split(",")]
        if len(ends) != 2 or None in ends:
            raise RuleError(f"IN BETWEEN needs two numbers, got {value!r}")
        return ends[0] + OPEN_MARGIN, False, ends[1] - OPEN_MARGIN, False, None, None, None, False
    if condition == "==" and number is not None and not truth:
        return number, False, number, False, None, None, None, False
    if condition == "==":
        return LOWEST, False, None, False, None, None, [value.strip().upper()], True
    if condition == "IN":
        parts = [v.strip() for v in value.split(",")]
        return LOWEST, False, None, False, None, None, [p.upper() for p in parts] if truth else parts, truth
    if condition not in COMPARE:
        raise RuleError(f"unknown condition {condition!r}")
    if number is None:
        if value not in known:
            raise RuleError(f"{value!r} is neither a number nor a column")
        return LOWEST, False, None, False, condition, value, None, False
    if condition.startswith(">"):
        return number, condition == ">", None, False, None, None, None, False
    return LOWEST, False, number, condition == "<", None, None, None, False


def read_rules(rules: DataFrame, known: Sequence[str]) -> RuleSet:
    """``known``: features that exist already. A rule that cannot be read is an error row, the rest go on."""
    rows = rules.select(*COLUMNS).orderBy("rule_id").limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise RuleError(f"more than {MAX_RULES} rules")
    out, made = RuleSet([], [], []), {}
    for r in rows:
        try:
            rule = Rule(r.rule_id, r.category, r.indicator or "", r.condition or "", r.value or "", r.features or "", r.norm_weight or 0.0)
            names, every = rule.feature_list()
            if not names:
                wanted = filters_of(r.additional_filters)
                shared = (rule.indicator, tuple(wanted or ()))
                spec = made.get(shared) or parse_indicator(rule.indicator, f"indicator_{len(made)}", wanted)
                names = [spec.name]
            else:
                filters_of(r.additional_filters)
                spec = shared = None
            missing = [n for n in names if n not in known and not spec]
            if missing:
                raise RuleError(f"unknown features {missing}")
            test = test_of(rule.condition, rule.value, known)
        except RuleError as exc:
            out.errors.append((r.rule_id, str(exc)))
            continue
        if spec:
            made[shared] = spec
        need = len(set(names)) if every else 1
        out.conditions += [(n, rule.rule_id, rule.category, rule.indicator, float(rule.norm_weight), need, *test) for n in dict.fromkeys(names)]
    out.specs = list(made.values())
    return out


def indicator_features(found: RuleSet, features: DataFrame, transactions: DataFrame, refs: DataFrame) -> DataFrame:
    """``features`` (party, ...) with the look-backs that rules name, at the reference of each party."""
    if not found.specs:
        return features
    made = lb.lookback_features(transactions, refs, found.specs)
    made = made.select("party", *[s.name for s in found.specs])
    return features.join(made, "party", "left").na.fill(0, [s.name for s in found.specs if s.op != "MAX"])


def _begun(ranges: Column, v: Column) -> Column:
    """How many of the ranges, sorted by lower end, begin at or below ``v``: a binary search."""
    rounds = F.sequence(F.lit(1), F.ceil(F.log2(F.size(ranges) + F.lit(1))).cast("int") + 1)
    first = F.struct(F.lit(0).alias("a"), F.size(ranges).alias("b"))

    def halve(s: Column, _: Column) -> Column:
        m = F.floor((s["a"] + s["b"]) / 2).cast("int")
        low = F.get(ranges, m)["lo"] <= v
        return F.when(s["a"] >= s["b"], s).when(low, F.struct((m + 1).alias("a"), s["b"].alias("b"))).otherwise(F.struct(s["a"].alias("a"), m.alias("b")))

    return F.aggregate(rounds, first, halve)["a"]


def rule_hits(features: DataFrame, found: RuleSet, key: str) -> DataFrame:
    """One row for each key and rule that holds: rule_id, category, indicator, weight and the
    value (as text) of its first feature that holds, in the order of names. A null value fails every test."""
    spark = features.sparkSession
    if not found.conditions:
        text = F.lit(None).cast("string")
        return features.select(key, *[text.alias(n) for n in ("rule_id", "category", "indicator")], F.lit(None).cast("double").alias("weight"), text.alias("feature_value")).filter(F.lit(False))
    cond = spark.createDataFrame(found.conditions, _CONDITION)
    names = list(dict.fromkeys(c[0] for c in found.conditions))
    others = list(dict.fromkeys(c[11] for c in found.conditions if c[11]))
    body = F.struct(*[c for c in cond.columns if c != "feature"])
    ranges = F.sort_array(F.collect_list(F.when(F.col("texts").isNull() & F.col("other").isNull(), F.struct(F.col("lo").alias("lo"), F.col("rule_id").alias("_id"), body.alias("c")))))
    rest = F.collect_list(F.when(F.col("texts").isNotNull() | F.col("other").isNotNull(), body))
    index = cond.groupBy("feature").agg(ranges.alias("ranges"), rest.alias("rest"))
    col = lambda n: F.col(f"`{n}`")
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), col(n).try_cast("double").alias("v"), col(n).cast("string").alias("text")) for n in names])
    against = F.create_map(*[x for n in others for x in (F.lit(n), col(n).try_cast("double"))]) if others else F.lit(None).cast("map<string,double>")
    tall = features.select(key, against.alias("others"), F.explode(cells).alias("x")).select(key, "others", "x.*").filter("text is not null").join(index, "feature")

    def in_range(c: Column) -> Column:
        v = F.col("v")
        return ((v > c["lo"]) | ((v == c["lo"]) & ~c["lo_open"])) & (c["hi"].isNull() | (v < c["hi"]) | ((v == c["hi"]) & ~c["hi_open"]))

    def holds(c: Column) -> Column:
        v, w = F.col("v"), F.try_element_at("others", c["other"])
        said = F.array_contains(c["texts"], F.when(c["upper"], F.upper("text")).otherwise(F.col("text")))
        compared = F.lit(False)
        for name, test in COMPARE.items():
            compared = compared | ((c["compare"] == name) & test(v, w))
        return F.coalesce(F.when(c["other"].isNotNull(), compared).otherwise(said), F.lit(False))

    near = F.when(F.col("v").isNotNull() & ~F.isnan("v"), F.transform(F.slice("ranges", F.lit(1), _begun(F.col("ranges"), F.col("v"))), lambda r: r["c"]))
    hit = F.concat(F.filter(F.coalesce(near, F.slice("rest", 1, 0)), in_range), F.filter("rest", holds))
    hits = tall.select(key, "feature", "text", F.explode(hit).alias("c"))
    return hits.groupBy(key, F.col("c.rule_id").alias("rule_id")).agg(
        F.count(F.lit(1)).alias("_n"), F.first("c.need").alias("_need"), F.first("c.category").alias("category"), F.first("c.indicator").alias("indicator"),
        F.first("c.weight").alias("weight"), F.min(F.struct("feature", "text"))["text"].alias("feature_value")).filter("_n >= _need").drop("_n", "_need")


def rule_scores(features: DataFrame, found: RuleSet, key: str, categories: Mapping[str, str]) -> DataFrame:
    """Sum of the weights of the rules that hold, one column for each category; 0 without any."""
    sums = rule_hits(features, found, key).groupBy(key).agg(*[F.sum(F.when(F.col("category") == c, F.col("weight"))).alias(n) for c, n in categories.items()])
    return features.select(key).join(sums, key, "left").na.fill(0.0, list(categories.values()))

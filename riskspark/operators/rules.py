"""Rules: rows of (features, condition, value, weight) turned into columns.

A rule compiles to a boolean ``Column``; all rules are evaluated in one projection over
the feature table, so the number of rules adds no pass over the data.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.lookback import Spec

OPEN_MARGIN = 0.00001
COMPARE = {"<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__}
LEVELS = ("High", "Medium", "Low")
MISSED = "missed"


class RuleError(ValueError):
    """A rule whose text cannot be turned into a predicate."""


@dataclass(frozen=True)
class Rule:
    rule_id: str
    category: str                 # Static, Regulatory
    indicator: str
    condition: str                # == IN "IN BETWEEN" < <= > >=
    value: str
    features: str                 # comma list, may hold ANY or ALL
    norm_weight: float
    weight: float = 0.0

    def feature_list(self) -> tuple[list[str], bool]:
        """Feature names, and whether all of them must hold."""
        tokens = [f for f in self.features.replace(" ", "").split(",") if f]
        return [f for f in tokens if f not in ("ANY", "ALL")], "ALL" in tokens


def _number(text: str) -> float | None:
    try:
        return float(text)
    except ValueError:
        return None


def _as_number(col: Column) -> Column:
    """The number in a column; null, hence a miss, where a text holds none."""
    return col.try_cast("double")


def _single(col: Column, condition: str, value: str, columns: Sequence[str]) -> Column:
    text = F.upper(col.cast("string"))
    truth = value.strip().upper() in ("TRUE", "FALSE")
    number = _number(value)
    if condition == "IN BETWEEN":
        ends = [_number(v) for v in value.split(",")]
        if len(ends) != 2 or None in ends:
            raise RuleError(f"IN BETWEEN needs two numbers, got {value!r}")
        return _as_number(col).between(ends[0] + OPEN_MARGIN, ends[1] - OPEN_MARGIN)
    if condition == "==":
        return text == value.strip().upper() if truth or number is None else _as_number(col) == number
    if condition == "IN":
        parts = [v.strip() for v in value.split(",")]
        return text.isin(*[p.upper() for p in parts]) if truth else col.cast("string").isin(*parts)
    if condition in COMPARE:
        if number is not None:
            return COMPARE[condition](_as_number(col), F.lit(number))
        if value in columns:
            return COMPARE[condition](col, F.col(value))
        raise RuleError(f"{value!r} is neither a number nor a column")
    raise RuleError(f"unknown condition {condition!r}")


def rule_predicate(rule: Rule, columns: Sequence[str]) -> Column:
    names, all_needed = rule.feature_list()
    missing = [n for n in names if n not in columns]
    if missing or not names:
        raise RuleError(f"unknown features {missing or rule.features!r}")
    tests = [_single(F.col(n), rule.condition, rule.value, columns) for n in names]
    return reduce((lambda a, b: a & b) if all_needed else (lambda a, b: a | b), tests)


def check_rules(rules: Sequence[Rule], columns: Sequence[str]) -> tuple[list[Rule], list[tuple[Rule, str]]]:
    """Rules that compile, and those that do not with the reason."""
    ok, bad = [], []
    for r in rules:
        try:
            rule_predicate(r, columns)
            ok.append(r)
        except RuleError as exc:
            bad.append((r, str(exc)))
    return ok, bad


def split_rules(rules: Sequence[Rule], behaviour: str = "Regulatory") -> tuple[list[Rule], list[Rule]]:
    return [r for r in rules if r.category == behaviour], [r for r in rules if r.category != behaviour]


def number_rules(rules: Sequence[Rule]) -> dict[str, int]:
    """Rule number by normalised weight, ties by id."""
    order = sorted(rules, key=lambda r: (r.norm_weight, r.rule_id))
    return {r.rule_id: i + 1 for i, r in enumerate(order)}


def hit(rule: Rule, columns: Sequence[str]) -> Column:
    return F.coalesce(rule_predicate(rule, columns), F.lit(False))


def eval_rules(df: DataFrame, rules: Sequence[Rule], keep: Sequence[str]) -> DataFrame:
    """Per rule a hit flag and the weight if hit, else 0."""
    out = []
    for r in rules:
        p = hit(r, df.columns)
        out += [p.alias(r.rule_id), F.when(p, F.lit(r.norm_weight)).otherwise(0.0).alias(f"{r.rule_id}_score")]
    return df.select(*keep, *out)


def rule_score(evaluated: DataFrame, rules: Sequence[Rule], name: str) -> DataFrame:
    total = reduce(lambda a, b: a + b, [F.col(f"{r.rule_id}_score") for r in rules])
    return evaluated.withColumn(name, total)


def explain_rules(df: DataFrame, rules: Sequence[Rule], key: str) -> DataFrame:
    """One row per key and rule hit: rule, feature value as text, weight, category."""
    parts = []
    for r in rules:
        names, _ = r.feature_list()
        seen = F.coalesce(*[F.when(_single(F.col(n), r.condition, r.value, df.columns), F.col(n).cast("string")) for n in names])
        parts.append(F.when(hit(r, df.columns), F.struct(
            F.lit(r.rule_id).alias("rule_id"), F.lit(r.indicator).alias("indicator"), seen.alias("feature_value"),
            F.lit(r.norm_weight).alias("weight"), F.lit(r.category).alias("category"))))
    return df.select(key, F.explode(F.array_compact(F.array(*parts))).alias("e")).select(key, "e.*")


def normalise_contrib(df: DataFrame, key: str, weight: str = "weight", name: str = "contribution") -> DataFrame:
    """Share of each row in the total of its key (at most one row per rule and key)."""
    total = F.sum(weight).over(Window.partitionBy(key))
    return df.withColumn(name, F.col(weight) / total)


def mandatory_level(config: Mapping[str, Sequence[Sequence[Rule]]], columns: Sequence[str]) -> Column:
    """``level -> rules -> alternatives``: the alternatives of a rule are OR-ed, the rules
    of a level AND-ed, and the first of High, Medium, Low that holds wins."""
    chosen = []
    for level in LEVELS:
        rules = config.get(level)
        if rules:
            every = reduce(lambda a, b: a & b, [
                reduce(lambda a, b: a | b, [hit(alt, columns) for alt in alts]) for alts in rules])
            chosen.append(F.when(every, level))
    return F.coalesce(*chosen, F.lit(MISSED))


_DIRECTIONS = {"Incoming": "incoming-all", "Outgoing": "outgoing-all"}
_FUNCTIONS = {"Maximum": "MAX", "Volume": "VOL", "Sum": "AMT"}


def parse_indicator(text: str, name: str, categories: Sequence[str] | None = None) -> Spec:
    """"Sum of Incoming transactions over past 30 Days" -> look-back spec; given
    categories replace the direction."""
    days = re.search(r"(\d+)\s*Days?\b", text)
    op = next((o for w, o in _FUNCTIONS.items() if w in text), None)
    if days is None or op is None:
        raise RuleError(f"cannot infer a feature from {text!r}")
    if categories:
        return Spec(name, op, int(days.group(1)), categories=tuple(categories), category_col="category")
    direction = next((d for w, d in _DIRECTIONS.items() if w in text), None)
    if direction is None and "All" not in text:
        raise RuleError(f"no direction in {text!r}")
    return Spec(name, op, int(days.group(1)), categories=(direction,) if direction else None)


def rule_names(rules: Sequence[Rule]) -> Column:
    """Map column: rule id -> indicator, condition and value as one text."""
    return F.create_map(*[F.lit(x) for r in rules for x in (r.rule_id, f"{r.indicator} {r.condition} {r.value}")])

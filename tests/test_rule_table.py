"""Rules as rows of a table against a plain evaluation."""

import operator
import random

import pytest

from riskspark.operators import rule_table as rt

SCHEMA = "rule_id string, category string, indicator string, condition string, value string, features string, norm_weight double, additional_filters string"
OPS = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def rule(n, condition, value, features, weight=1.0, category="Static", indicator="i", filters=None):
    return (n, category, indicator, condition, value, features, weight, filters)


def holds(condition, value, x, row):
    if x is None:
        return False
    if condition in OPS:
        other = row[value] if value in row else float(value)
        return other is not None and OPS[condition](x, other)
    if condition == "IN BETWEEN":
        a, b = map(float, value.split(","))
        return a + 1e-5 <= x <= b - 1e-5
    if condition == "IN":
        return str(x) in [v.strip() for v in value.split(",")]
    return str(x).upper() == value.upper() if isinstance(x, (str, bool)) else x == float(value)


def test_a_thousand_rules_against_plain_evaluation(spark):
    rnd = random.Random(4)
    rows = [{"party": i, "a": rnd.choice([None, rnd.randint(0, 60)]), "b": rnd.randint(0, 60), "s": rnd.choice(["x", "Y", None]), "t": rnd.choice([True, False])} for i in range(60)]
    rules = []
    for i in range(1000):
        c = rnd.choice([*OPS, "==", "IN BETWEEN"])
        lo = rnd.randint(0, 60)
        f = rnd.choice(["a", "b", "a, b, ANY", "a, b, ALL"])
        rules.append(rule(f"r{i}", c, f"{lo},{lo + rnd.randint(0, 20)}" if c == "IN BETWEEN" else str(lo), f, round(rnd.random(), 3), rnd.choice(["Static", "Regulatory"])))
    rules += [rule("s1", "==", "y", "s"), rule("s2", "IN", "x, z", "s"), rule("s3", "==", "TRUE", "t"), rule("s4", ">=", "b", "a")]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "party int, a int, b int, s string, t boolean")
    found = rt.read_rules(spark.createDataFrame(rules, SCHEMA), df.columns)
    assert not found.errors and not found.specs
    hits = rt.rule_hits(df, found, "party")
    assert len(hits.columns) == 6
    got = {(r.party, r.rule_id) for r in hits.collect()}
    want, sums = set(), {r["party"]: [0.0, 0.0] for r in rows}
    for row in rows:
        for rid, cat, _, c, v, fs, w, _ in rules:
            names = [f.strip() for f in fs.split(",")]
            test = (all if "ALL" in names else any)(holds(c, v, row[f], row) for f in names if f not in ("ANY", "ALL"))
            if test:
                want.add((row["party"], rid))
                sums[row["party"]][cat == "Regulatory"] += w
    assert got == want
    for r in rt.rule_scores(df, found, "party", {"Static": "s", "Regulatory": "g"}).collect():
        assert [r.s, r.g] == pytest.approx(sums[r.party])


def test_texts_and_filters(spark):
    text = "Sum of Incoming transactions over past 30 Days"
    rows = [rule("a", ">", "1", None, indicator=text), rule("b", "<", "9", "", indicator=text), rule("c", ">", "1", None, indicator=text, filters='{"TRANSACTION_TYPE": ["x", "y"]}'),
            rule("d", ">", "1", None, indicator="nothing"), rule("e", ">", "1", None, indicator=text, filters="{no"), rule("f", "~", "1", "a"), rule("g", ">", "1", "zz"), rule("h", ">", None, "a")]
    found = rt.read_rules(spark.createDataFrame(rows, SCHEMA), ["a"])
    assert [(s.op, s.days, s.categories, s.category_col) for s in found.specs] == [("AMT", 30, ("incoming-all",), "direction"), ("AMT", 30, ("x", "y"), "category")]
    assert [c[:2] for c in found.conditions] == [("indicator_0", "a"), ("indicator_0", "b"), ("indicator_1", "c")]
    assert [e[0] for e in found.errors] == ["d", "e", "f", "g", "h"]


def test_no_rules_and_no_rows(spark):
    none = rt.read_rules(spark.createDataFrame([], SCHEMA), ["a"])
    df = spark.createDataFrame([(1, None), (2, float("nan"))], "party int, a double")
    assert {(r.party, r.s) for r in rt.rule_scores(df, none, "party", {"Static": "s"}).collect()} == {(1, 0.0), (2, 0.0)}
    some = rt.read_rules(spark.createDataFrame([rule("a", ">", "1", "a"), rule("b", "<", "1", "a")], SCHEMA), ["a"])
    assert rt.rule_hits(df, some, "party").count() == 0
    assert rt.rule_hits(df.limit(0), some, "party").count() == 0

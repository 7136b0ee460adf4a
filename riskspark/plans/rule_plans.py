"""Queries over the rules engine, evaluated for every customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators import enrich, lookback as lb, rule_table as rt, rules as ru
from riskspark.operators.rules import Rule
from riskspark.plans.base_sql import with_tables
from riskspark.plans.registry import query
from riskspark.plans.shape_plans import BIRTH, birth_date
from riskspark.sources import tables as t

RULES = [
    Rule("r_segment", "Static", "Business segment", "==", "building", "segment", 0.30, 30),
    Rule("r_region", "Static", "Region", "IN", "AFRICA, ASIA", "region", 0.20, 20),
    Rule("r_age", "Static", "Age", "IN BETWEEN", "30,50", "age", 0.10, 10),
    Rule("r_pep", "Static", "Exposed person", "==", "TRUE", "pep", 0.25, 25),
    Rule("r_balance", "Static", "Balance", "<", "0", "balance", 0.15, 15),
    Rule("r_in", "Regulatory", "Sum of Incoming over past 360 Days", ">=", "150000", "in_360", 0.35, 35),
    Rule("r_vol", "Regulatory", "Volume of All over past 360 Days", ">", "6", "vol_360", 0.20, 20),
    Rule("r_any", "Regulatory", "Large flow", ">", "250000", "in_360, out_360, ANY", 0.25, 25),
    Rule("r_all", "Regulatory", "Even flow", "IN BETWEEN", "50000,200000", "in_360, out_360, ALL", 0.12, 12),
    Rule("r_col", "Regulatory", "More out than in", ">", "in_360", "out_360", 0.08, 8),
]
BROKEN = [
    Rule("b_value", "Static", "No value", ">", "[]", "age", 0.1),
    Rule("b_feature", "Static", "No feature", "==", "1", "no_such_feature", 0.1),
    Rule("b_range", "Static", "Half a range", "IN BETWEEN", "5", "age", 0.1),
]
MANDATORY = {
    "High": [[RULES[3]], [RULES[1], RULES[0]]],
    "Medium": [[RULES[4], RULES[5]]],
    "Low": [[RULES[2]]],
}
BEHAVIOUR, STATIC = ru.split_rules(RULES)

FEATURES_SQL = with_tables("cust txn", f""", feat AS (SELECT c.party, c.segment, c.region, CAST(c.balance AS DOUBLE) AS balance,
    CAST(trunc(date_diff('day', {BIRTH.format(k='(c.party * 17)')}, DATE '2001-11-04') / 365.25) AS INT) AS age, c.party % 13 = 0 AS pep,
    CAST(COALESCE(x.i, 0) AS DOUBLE) AS in_360, CAST(COALESCE(x.o, 0) AS DOUBLE) AS out_360, CAST(COALESCE(x.n, 0) AS BIGINT) AS vol_360
    FROM cust c LEFT JOIN (SELECT party, SUM(CASE direction WHEN 'incoming-all' THEN amount END) AS i,
        SUM(CASE direction WHEN 'outgoing-all' THEN amount END) AS o, COUNT(*) AS n FROM txn
        WHERE txn_date > (SELECT MAX(txn_date) FROM txn) - 360 GROUP BY 1) x USING (party))""")

P = {
    "r_segment": "upper(segment) = 'BUILDING'", "r_region": "region IN ('AFRICA', 'ASIA')",
    "r_age": "age > 30 AND age < 50", "r_pep": "pep", "r_balance": "balance < 0", "r_in": "in_360 >= 150000",
    "r_vol": "vol_360 > 6", "r_any": "(in_360 > 250000 OR out_360 > 250000)",
    "r_all": "(in_360 BETWEEN 50000.00001 AND 199999.99999 AND out_360 BETWEEN 50000.00001 AND 199999.99999)",
    "r_col": "out_360 > in_360",
}
W = {r.rule_id: r.norm_weight for r in RULES}


def rule_features(spark, sf):
    txn = t.transactions(spark, sf)
    last = t.last_transaction_date(spark, sf)
    sums = txn.filter(F.col("txn_date") > F.date_sub(last, 360)).groupBy("party").agg(
        F.sum(F.when(F.col("direction") == "incoming-all", F.col("amount"))).cast("double").alias("in_360"),
        F.sum(F.when(F.col("direction") == "outgoing-all", F.col("amount"))).cast("double").alias("out_360"),
        F.count(F.lit(1)).alias("vol_360"))
    cust = t.customers(spark, sf).withColumn("k", F.col("party") * 17).select(
        "party", "segment", "region", F.col("balance").cast("double").alias("balance"),
        enrich.age_years(birth_date("k"), F.lit("2001-11-04").cast("date")).alias("age"),
        (F.col("party") % 13 == 0).alias("pep"))
    return cust.join(sums, "party", "left").na.fill(0, ["in_360", "out_360", "vol_360"])


def flags_sql(names) -> str:
    return ", ".join(f"COALESCE({P[n]}, FALSE) AS {n}" for n in names)


def eval_sql(names) -> str:
    return ", ".join(f"COALESCE({P[n]}, FALSE) AS {n}, CASE WHEN {P[n]} THEN {W[n]}::DOUBLE ELSE 0 END AS {n}_score" for n in names)


def score_sql(names) -> str:
    return "ROUND(" + " + ".join(f"CASE WHEN {P[n]} THEN {W[n]}::DOUBLE ELSE 0 END" for n in names) + ", 6)"


ids = lambda rules: [r.rule_id for r in rules]


@query("rule_parse", FEATURES_SQL + f" SELECT party, {flags_sql(ids(RULES))} FROM feat")
def rule_parse(spark, sf):
    df = rule_features(spark, sf)
    return df.select("party", *[ru.hit(r, df.columns).alias(r.rule_id) for r in RULES])


@query("rule_multi_feature", FEATURES_SQL + f" SELECT party, {flags_sql(['r_any', 'r_all'])} FROM feat")
def rule_multi_feature(spark, sf):
    df = rule_features(spark, sf)
    return df.select("party", *[ru.hit(r, df.columns).alias(r.rule_id) for r in RULES if r.rule_id in ("r_any", "r_all")])


@query("rule_eval_static", FEATURES_SQL + f" SELECT party, {eval_sql(ids(STATIC))} FROM feat")
def rule_eval_static(spark, sf):
    return ru.eval_rules(rule_features(spark, sf), STATIC, ["party"])


@query("rule_eval_behaviour", FEATURES_SQL + f" SELECT party, {eval_sql(ids(BEHAVIOUR))} FROM feat")
def rule_eval_behaviour(spark, sf):
    return ru.eval_rules(rule_features(spark, sf), BEHAVIOUR, ["party"])


def hit_counts(df, rules, labels):
    """Long table of hits per rule: one aggregate over all customers."""
    counts = df.agg(*[F.count(F.when(ru.hit(r, df.columns), True)).alias(r.rule_id) for r in rules])
    rows = F.explode(F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in labels(r).items()], F.col(r.rule_id).alias("hits")) for r in rules]))
    return counts.select(rows.alias("x")).select("x.*")


NUMBERS = ru.number_rules(RULES)


@query("rule_number", FEATURES_SQL + """, n AS (SELECT rule_id, CAST(row_number() OVER (ORDER BY w, rule_id) AS INT) AS rule_no, p FROM (VALUES """ + ", ".join(
    f"('{n}', {W[n]}, (SELECT COUNT(*) FROM feat WHERE {P[n]}))" for n in P) + """) v(rule_id, w, p))
    SELECT rule_id, rule_no, CAST(p AS BIGINT) AS hits FROM n""")
def rule_number(spark, sf):
    return hit_counts(rule_features(spark, sf), RULES, lambda r: {"rule_id": r.rule_id, "rule_no": NUMBERS[r.rule_id]})


@query("rule_category_split", FEATURES_SQL + f""" SELECT 'behaviour' AS kind, CAST(COUNT(CASE WHEN {' OR '.join(P[i] for i in ids(BEHAVIOUR))} THEN 1 END) AS BIGINT) AS customers FROM feat
    UNION ALL SELECT 'other', CAST(COUNT(CASE WHEN {' OR '.join(P[i] for i in ids(STATIC))} THEN 1 END) AS BIGINT) FROM feat""")
def rule_category_split(spark, sf):
    df = rule_features(spark, sf)
    def any_hit(rules):
        return F.exists(F.array(*[ru.hit(r, df.columns) for r in rules]), lambda x: x)
    counts = df.agg(F.count(F.when(any_hit(BEHAVIOUR), True)).alias("b"), F.count(F.when(any_hit(STATIC), True)).alias("s"))
    return counts.select(F.explode(F.array(
        F.struct(F.lit("behaviour").alias("kind"), F.col("b").alias("customers")),
        F.struct(F.lit("other").alias("kind"), F.col("s").alias("customers")))).alias("x")).select("x.*")


@query("rule_indicator_text", with_tables("txn refs", """SELECT r.party, r.ref_date,
    CAST(COALESCE(SUM(CASE WHEN direction = 'incoming-all' AND d < 30 THEN amount END), 0) AS DOUBLE) AS sum_in_30,
    CAST(COUNT(CASE WHEN d < 90 THEN 1 END) AS BIGINT) AS vol_all_90,
    CAST(MAX(CASE WHEN direction = 'outgoing-all' AND d < 180 THEN amount END) AS DOUBLE) AS max_out_180,
    CAST(COALESCE(SUM(CASE WHEN category IN ('R-O', 'A-F') AND d < 1 THEN amount END), 0) AS DOUBLE) AS sum_mixed_1
    FROM refs r LEFT JOIN (SELECT * FROM txn) t ON t.party = r.party AND t.txn_date <= r.ref_date AND t.txn_date > r.ref_date - 360
    LEFT JOIN LATERAL (SELECT date_diff('day', t.txn_date, r.ref_date) AS d) z ON TRUE GROUP BY 1, 2"""))
def rule_indicator_text(spark, sf):
    specs = [
        ru.parse_indicator("Sum of Incoming transactions over past 30 Days", "sum_in_30"),
        ru.parse_indicator("Volume of All transactions over past 90 Days", "vol_all_90"),
        ru.parse_indicator("Maximum Outgoing transaction over past 180 Days", "max_out_180"),
        ru.parse_indicator("Sum of All transactions over past 1 Day", "sum_mixed_1", ["R-O", "A-F"]),
    ]
    return lb.lookback_features(t.transactions(spark, sf), t.reference_points(t.alerts(spark, sf)), specs)


@query("rule_score", FEATURES_SQL + f" SELECT party, {score_sql(ids(STATIC))} AS static_score, {score_sql(ids(BEHAVIOUR))} AS regulatory_score FROM feat")
def rule_score(spark, sf):
    made = ru.eval_rules(rule_features(spark, sf), RULES, ["party"])
    made = ru.rule_score(ru.rule_score(made, STATIC, "static_score"), BEHAVIOUR, "regulatory_score")
    return made.select("party", F.round("static_score", 6).alias("static_score"), F.round("regulatory_score", 6).alias("regulatory_score"))


@query("rule_errors", FEATURES_SQL + " SELECT rule_id, status, hits FROM (VALUES " + ", ".join(
    f"('{n}', 'ok', (SELECT CAST(COUNT(*) AS BIGINT) FROM feat WHERE {P[n]}))" for n in P) + ", " + ", ".join(
    f"('{r.rule_id}', 'error', NULL)" for r in BROKEN) + ") v(rule_id, status, hits)")
def rule_errors(spark, sf):
    df = rule_features(spark, sf)
    ok, bad = ru.check_rules(RULES + BROKEN, df.columns)
    errors = spark.createDataFrame([(r.rule_id, "error", None) for r, _ in bad], "rule_id string, status string, hits bigint")
    return hit_counts(df, ok, lambda r: {"rule_id": r.rule_id, "status": "ok"}).unionByName(errors)


MANDATORY_SQL = f"""CASE WHEN pep AND ({P['r_region']} OR {P['r_segment']}) THEN 'High' WHEN balance < 0 OR in_360 >= 150000 THEN 'Medium'
    WHEN {P['r_age']} THEN 'Low' ELSE 'missed' END"""


@query("rule_mandatory", FEATURES_SQL + f" SELECT party, {MANDATORY_SQL} AS risk_level FROM feat")
def rule_mandatory(spark, sf):
    df = rule_features(spark, sf)
    return df.select("party", ru.mandatory_level(MANDATORY, df.columns).alias("risk_level"))


@query("rule_mandatory_exclude", FEATURES_SQL + f" SELECT party, segment FROM feat WHERE {MANDATORY_SQL} = 'missed'")
def rule_mandatory_exclude(spark, sf):
    """One pass: parties any mandatory rule catches leave the normal flow."""
    df = rule_features(spark, sf)
    return df.filter(ru.mandatory_level(MANDATORY, df.columns) == ru.MISSED).select("party", "segment")


_VALUE = {"r_segment": "segment", "r_region": "region", "r_age": "CAST(age AS VARCHAR)", "r_pep": "CAST(pep AS VARCHAR)", "r_vol": "CAST(vol_360 AS VARCHAR)"}
EXPLAIN_IDS = list(_VALUE)
EXPLAIN_SQL = " UNION ALL ".join(
    f"SELECT party, '{n}' AS rule_id, {_VALUE[n]} AS feature_value, {W[n]}::DOUBLE AS weight, "
    f"'{next(r.category for r in RULES if r.rule_id == n)}' AS category FROM feat WHERE {P[n]}" for n in EXPLAIN_IDS)


def explained(spark, sf):
    return ru.explain_rules(rule_features(spark, sf), [r for r in RULES if r.rule_id in EXPLAIN_IDS], "party").drop("indicator")


@query("rule_explain", FEATURES_SQL + f" {EXPLAIN_SQL}")
def rule_explain(spark, sf):
    return explained(spark, sf)


@query("rule_explain_norm", FEATURES_SQL + f" SELECT party, rule_id, ROUND(weight / SUM(weight) OVER (PARTITION BY party), 6) AS contribution FROM ({EXPLAIN_SQL})")
def rule_explain_norm(spark, sf):
    return ru.normalise_contrib(explained(spark, sf), "party").select("party", "rule_id", F.round("contribution", 6).alias("contribution"))


@query("rule_name_map", FEATURES_SQL + """ SELECT party, '{' || concat_ws(',', CASE WHEN upper(segment) = 'BUILDING' THEN '"r_segment":"Business segment == building"' END,
    CASE WHEN region IN ('AFRICA', 'ASIA') THEN '"r_region":"Region IN AFRICA, ASIA"' END, CASE WHEN pep THEN '"r_pep":"Exposed person == TRUE"' END) || '}' AS rules FROM feat""")
def rule_name_map(spark, sf):
    df = rule_features(spark, sf)
    picked = [r for r in RULES if r.rule_id in ("r_segment", "r_region", "r_pep")]
    hits = F.create_map(*[x for r in picked for x in (F.lit(r.rule_id), ru.hit(r, df.columns))])
    names = F.map_filter(ru.rule_names(picked), lambda k, _: hits[k])
    return df.select("party", F.to_json(names).alias("rules"))


# ---- rules from a table ----------------------------------------------------------------

#: the static rules, and behaviour named by indicator texts, some with categories of their own
TABLE_ROWS = [(r.rule_id, r.category, r.indicator, r.condition, r.value, r.features, r.norm_weight, None) for r in STATIC] + [
    ("t_in", "Regulatory", "Sum of Incoming transactions over past 360 Days", ">=", "150000", None, 0.35, None),
    ("t_in_top", "Regulatory", "Sum of Incoming transactions over past 360 Days", ">", "400000", None, 0.15, None),
    ("t_in_mid", "Regulatory", "Sum of Incoming transactions over past 360 Days", "IN BETWEEN", "[50000, 150000]", None, 0.1, None),
    ("t_vol", "Regulatory", "Volume of All transactions over past 360 Days", ">", "6", None, 0.2, ""),
    ("t_kinds", "Regulatory", "Volume of All transactions over past 360 Days", ">=", "2", None, 0.12, '{"TRANSACTION_TYPE": ["R-F", "N-O"]}'),
    ("t_max", "Regulatory", "Maximum Outgoing transactions over past 90 Days", "<", "30000", None, 0.08, None),
    ("t_day", "Regulatory", "Sum of All transactions over past 1 Day", "==", "0", None, 0.02, None),
    ("b_text", "Regulatory", "Something of Incoming transactions", ">", "1", None, 0.5, None),
    ("b_filter", "Regulatory", "Sum of All transactions over past 30 Days", ">", "1", None, 0.5, "{}"),
    ("b_value", "Static", "Age", ">", "[]", "age", 0.5, None)]
TABLE_SCHEMA = "rule_id string, category string, indicator string, condition string, value string, features string, norm_weight double, additional_filters string"

TABLE_SQL = FEATURES_SQL + """, last AS (SELECT MAX(txn_date) AS d FROM txn), feat2 AS (SELECT f.*, y.kinds, y.max_out, y.day1 FROM feat f LEFT JOIN (SELECT c.party,
    COUNT(CASE WHEN category IN ('R-F', 'N-O') AND txn_date > last.d - 360 THEN 1 END) AS kinds, MAX(CASE WHEN direction = 'outgoing-all' AND txn_date > last.d - 90 THEN amount END) AS max_out,
    COALESCE(SUM(CASE WHEN txn_date > last.d - 1 THEN amount END), 0) AS day1 FROM cust c CROSS JOIN last LEFT JOIN txn t ON t.party = c.party GROUP BY 1) y USING (party))"""
TABLE_P = {k: P[k] for k in ids(STATIC)} | {
    "t_in": "in_360 >= 150000", "t_in_top": "in_360 > 400000", "t_in_mid": "in_360 BETWEEN 50000.00001 AND 149999.99999", "t_vol": "vol_360 > 6", "t_kinds": "kinds >= 2",
    "t_max": "max_out < 30000", "t_day": "day1 = 0"}
TABLE_W = {r[0]: r[6] for r in TABLE_ROWS}


def table_rules(spark, sf):
    """(features of each customer, rules read) for the rules as a table."""
    base = t.customers(spark, sf).withColumn("k", F.col("party") * 17).select(
        "party", "segment", "region", F.col("balance").cast("double").alias("balance"),
        enrich.age_years(birth_date("k"), F.lit("2001-11-04").cast("date")).alias("age"), (F.col("party") % 13 == 0).alias("pep"))
    found = rt.read_rules(spark.createDataFrame(TABLE_ROWS, TABLE_SCHEMA), base.columns)
    refs = base.select("party", t.last_transaction_date(spark, sf).alias("ref_date"))
    return rt.indicator_features(found, base, t.transactions(spark, sf), refs), found


def table_sum(names) -> str:
    return "ROUND(" + " + ".join(f"CASE WHEN {TABLE_P[n]} THEN {TABLE_W[n]}::DOUBLE ELSE 0 END" for n in names) + ", 6)"


@query("rule_table_score", TABLE_SQL + f" SELECT party, {table_sum(ids(STATIC))} AS static_score, {table_sum([n for n in TABLE_P if n.startswith('t_')])} AS regulatory_score FROM feat2")
def rule_table_score(spark, sf):
    features, found = table_rules(spark, sf)
    made = rt.rule_scores(features, found, "party", {"Static": "static_score", "Regulatory": "regulatory_score"})
    return made.select("party", F.round("static_score", 6).alias("static_score"), F.round("regulatory_score", 6).alias("regulatory_score"))


@query("rule_table_hits", TABLE_SQL + " " + " UNION ALL ".join(f"SELECT party, '{n}' AS rule_id, {TABLE_W[n]}::DOUBLE AS weight FROM feat2 WHERE {p}" for n, p in TABLE_P.items()))
def rule_table_hits(spark, sf):
    features, found = table_rules(spark, sf)
    return rt.rule_hits(features, found, "party").select("party", "rule_id", "weight")

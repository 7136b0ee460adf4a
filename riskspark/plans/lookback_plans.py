"""Queries over look-back features (per alerted party and reference date)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators import enrich, features as ft, lookback as lb
from riskspark.operators.lookback import Spec
from riskspark.plans.base_sql import with_tables
from riskspark.plans.registry import query
from riskspark.sources import tables as t

CATEGORIES = {
    "all": [], "incoming-all": ["incoming-all"], "outgoing-all": ["outgoing-all"],
}

def sql_features(columns: str, days: int = 360, extra: str = "", source: str = "txn_refs") -> str:
    """A grouped query over every reference point joined to its transactions."""
    joined = f"""txn_refs AS (SELECT r.party, r.ref_date, t.opp_party, t.amount, t.direction,
        date_diff('day', t.txn_date, r.ref_date) AS dd FROM refs r LEFT JOIN txn t ON t.party = r.party
        AND t.txn_date <= r.ref_date AND t.txn_date > r.ref_date - {days})"""
    body = f", {joined}{', ' + extra if extra else ''} SELECT party, ref_date, {columns} FROM {source} GROUP BY party, ref_date"
    return with_tables("txn refs opp cust", body)


def rounded(df, digits: int = 4):
    return df.select(*[F.round(f.name if "." not in f.name and "-" not in f.name else F.col(f"`{f.name}`"), digits).alias(f.name)
                       if f.dataType.typeName() == "double" else F.col(f"`{f.name}`") for f in df.schema.fields])


def txn_and_refs(spark, sf):
    return t.transactions(spark, sf), t.reference_points(t.alerts(spark, sf))


def amt(pred: str, name: str) -> str:
    return f"CAST(COALESCE(SUM(CASE WHEN {pred} THEN amount END), 0) AS DOUBLE) AS {name}"


def vol(pred: str, name: str) -> str:
    return f"CAST(COUNT(CASE WHEN {pred} THEN 1 END) AS BIGINT) AS {name}"


def mx(pred: str, name: str) -> str:
    return f"CAST(MAX(CASE WHEN {pred} THEN amount END) AS DOUBLE) AS {name}"


def sd(pred: str, name: str) -> str:
    return f"ROUND(STDDEV_SAMP(CASE WHEN {pred} THEN CAST(amount AS DOUBLE) END), 2) AS {name}"


ASOF_SQL = """
    SELECT a.alert_id, a.{key}, a.alert_date AS ref_date, t.opp_party, t.txn_date, CAST(t.amount AS DOUBLE) AS amount, t.category,
        t.direction, date_diff('day', t.txn_date, a.alert_date)::INT AS days_before
    FROM {alerts} a {how} JOIN txn t ON t.{key} = a.{key} AND t.txn_date <= a.alert_date AND t.txn_date > a.alert_date - 360"""


def alert_transactions(spark, sf, key: str, how: str):
    """Alerts with the transactions of their look-back."""
    refs = t.alerts(spark, sf).withColumn("account", F.col("alert_id")).select("alert_id", key, F.col("alert_date").alias("ref_date"))
    facts = lb.referenced(t.transactions(spark, sf), refs, lb.MAX_HISTORY, key).select(key, "opp_party", "txn_date", "amount", "category", "direction")
    return lb.lookback_join(facts, refs, "txn_date", key=key, how=how).select(
        "alert_id", key, "ref_date", "opp_party", "txn_date", F.col("amount").cast("double").alias("amount"), "category", "direction", "days_before")


@query("asof_window_join_inner", with_tables("txn alert", ASOF_SQL.format(key="party", alerts="alert", how="")))
def asof_window_join_inner(spark, sf):
    return alert_transactions(spark, sf, "party", "inner")


@query("asof_window_join_right", with_tables("txn alert", ASOF_SQL.format(
    key="account", alerts="(SELECT *, alert_id AS account FROM alert)", how="LEFT")))
def asof_window_join_right(spark, sf):
    """Alerts without a transaction stay."""
    return alert_transactions(spark, sf, "account", "right")


def _wide(names: dict[str, str]):
    """Requested feature name -> column name in the result (SQL friendly)."""
    def run(spark, sf, facts=None, digits=4):
        txn, refs = txn_and_refs(spark, sf)
        facts = txn if facts is None else facts
        made = ft.feature_matrix(facts, refs, list(names), CATEGORIES)
        return rounded(made.select("party", "ref_date", *[F.col(f"`{n}`").alias(a) for n, a in names.items()]), digits)
    return run


IN, OUT = "direction = 'incoming-all'", "direction = 'outgoing-all'"

_CATEGORY = {"incoming-all_30DAY_AMT_CUSTOMER": "in_30_amt", "incoming-all_90DAY_AMT_CUSTOMER": "in_90_amt",
             "incoming-all_360DAY_AMT_CUSTOMER": "in_360_amt", "outgoing-all_90DAY_AMT_CUSTOMER": "out_90_amt",
             "incoming-all_90DAY_VOL_CUSTOMER": "in_90_vol", "all_360DAY_VOL_CUSTOMER": "all_360_vol",
             "outgoing-all_360DAY_MAX_CUSTOMER": "out_360_max", "all_DAILY_AMT_CUSTOMER": "all_1_amt"}


@query("feat_lookback_category", sql_features(", ".join([
    amt(f"{IN} AND dd < 30", "in_30_amt"), amt(f"{IN} AND dd < 90", "in_90_amt"), amt(f"{IN} AND dd < 360", "in_360_amt"),
    amt(f"{OUT} AND dd < 90", "out_90_amt"), vol(f"{IN} AND dd < 90", "in_90_vol"), vol("dd < 360", "all_360_vol"),
    mx(f"{OUT} AND dd < 360", "out_360_max"), amt("dd < 1", "all_1_amt")])))
def feat_lookback_category(spark, sf):
    return _wide(_CATEGORY)(spark, sf)


@query("feat_lookback_sd", sql_features(", ".join([sd("dd < 360", "all_360_sd"), sd(f"{IN} AND dd < 180", "in_180_sd")])))
def feat_lookback_sd(spark, sf):
    return _wide({"all_360DAY_SD_CUSTOMER": "all_360_sd", "incoming-all_180DAY_SD_CUSTOMER": "in_180_sd"})(spark, sf, digits=2)


@query("feat_lookback_offset", sql_features(", ".join([
    amt("dd >= 30 AND dd < 180", "all_180_off30_amt"), vol(f"{OUT} AND dd >= 90 AND dd < 360", "out_360_off90_vol")])))
def feat_lookback_offset(spark, sf):
    return _wide({"all_180DAY_OFFSET_30DAY_AMT_CUSTOMER": "all_180_off30_amt",
                  "outgoing-all_360DAY_OFFSET_90DAY_VOL_CUSTOMER": "out_360_off90_vol"})(spark, sf)


_FLAG_SQL = """flagged AS (SELECT x.*, o.opp_region = 0 AS country, COALESCE(o.opp_balance < 0, FALSE) AS risky,
    COALESCE(o.opp_nation <> c.nation, FALSE) AS abroad FROM txn_refs x LEFT JOIN opp o USING (opp_party) LEFT JOIN cust c USING (party))"""

#: every fact with all flags: party, account, day, amount, direction, counter-party and what is known of both sides
_VIEW_SQL = """flagged AS (SELECT t.*, opp_party * 10 + t.account % 3 AS opp_account, o.opp_nation AS opp_country, DATE '1970-01-01' + CAST(opp_party % 12000 AS INT) AS birth_date,
    COALESCE(o.opp_region = 0, FALSE) AS to_high_risk_country, COALESCE(o.opp_balance < 0, FALSE) AS to_high_risk_party, COALESCE(t.party = t.opp_party, FALSE) AS same_party,
    COALESCE(o.opp_nation <> c.nation, FALSE) AS to_foreign, COALESCE(CASE opp_party % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END <> q.o_orderstatus, FALSE) AS diff_account_unit,
    COALESCE(o.opp_region <> c.region_key, FALSE) AS diff_account_segment, COALESCE(CASE WHEN opp_party % 2 = 0 THEN '5-LOW' ELSE '2-HIGH' END <> q.o_orderpriority, FALSE) AS diff_account_type,
    COALESCE((opp_balance > 5000) <> (c.balance > 5000), FALSE) AS diff_party_type, COALESCE(opp_balance > 9000, FALSE) AS with_pep, COALESCE(opp_balance < -500, FALSE) AS with_adverse_news,
    COALESCE(opp_party % 7 = 0, FALSE) AS with_ngo, COALESCE(o.opp_region = 2, FALSE) AS with_tax_haven
    FROM txn t LEFT JOIN opp o USING (opp_party) LEFT JOIN cust c ON c.party = t.party LEFT JOIN orders q ON q.o_orderkey = t.account)"""


def flagged_transactions(spark, sf):
    """One view of the transactions with everything that feature names can ask for. What is known of
    an account and its owner is joined before the transactions are, which outnumber them."""
    own = t.customers(spark, sf).select("party", F.col("nation").alias("country"), F.col("region_key").alias("account_segment"), (F.col("balance") > 5000).alias("party_type"))
    accounts = t.load(spark, sf, "orders").select(F.col("o_orderkey").alias("account"), F.col("o_orderstatus").alias("account_unit"), F.col("o_orderpriority").alias("account_type"))
    opp = F.col("opp_party")
    other = t.counterparties(spark, sf).select(
        "opp_party", F.col("opp_nation").alias("opp_country"), F.col("opp_region").alias("opp_account_segment"), (F.col("opp_balance") > 5000).alias("opp_party_type"),
        (F.col("opp_region") == t.HIGH_RISK_REGION).alias("risky_country"), (F.col("opp_balance") < 0).alias("risky_party"), (F.col("opp_balance") > 9000).alias("opp_pep"),
        (F.col("opp_balance") < -500).alias("opp_adverse_news"), (F.col("opp_region") == 2).alias("opp_tax_haven"))
    owners = t.account_owners(spark, sf).join(own, "party", "left").join(accounts, "account", "left")
    rows = t.transactions(spark, sf, owners).join(other, "opp_party", "left").withColumns({
        "opp_account": opp * 10 + F.col("account") % 3, "opp_account_unit": F.element_at(F.array(*map(F.lit, "FOP")), (opp % 3 + 1).cast("int")),
        "opp_account_type": F.when(opp % 2 == 0, "5-LOW").otherwise("2-HIGH"), "opp_ngo": opp % 7 == 0,
        "birth_date": F.date_add(F.lit(lb.EPOCH).cast("date"), (opp % 12000).cast("int"))})
    return enrich.with_flags(rows).select("party", "account", "txn_date", "amount", "direction", "category", "opp_party", "opp_account", "opp_country", "birth_date", *enrich.FLAGS)


def sources(spark, sf) -> dict[str, ft.Source]:
    """Transactions with their flags, and past alerts of two kinds (of transactions and of customers)."""
    def past(rows):
        marked = rows.select("party", "alert_date", (F.col("result") == "F").alias("is_true"), (F.col("result") == "O").alias("is_false"))
        return ft.Source(marked, "alert_date", {"CUSTOMER": "party"})
    return {"transactions": ft.Source(flagged_transactions(spark, sf), "txn_date", {"CUSTOMER": "party", "ACCOUNT": "account"}, "amount"),
            "alerts": past(t.alert_history(spark, sf)), "cdd_alerts": past(t.customer_alerts(spark, sf))}


def mixed(spark, sf, names: dict[str, str], refs=None, keys=None, digits: int = 4):
    """Features by name alone; requested name -> column of the result."""
    refs = t.reference_points(t.alerts(spark, sf)) if refs is None else refs
    made = ft.mixed_matrix(sources(spark, sf), refs, list(names), CATEGORIES, keys or {"CUSTOMER": "party"})
    ids = [c for c in refs.columns if c in made.columns]
    return rounded(made.select(*ids, *[F.col(f"`{n}`").alias(a) for n, a in names.items()]), digits)


@query("feat_lookback_flag", sql_features(", ".join([
    amt("country AND dd < 90", "hrc_90_amt"), vol("risky AND dd < 360", "hrp_360_vol"),
    mx(f"abroad AND {IN} AND dd < 180", "foreign_180_max")]), extra=_FLAG_SQL, source="flagged"))
def feat_lookback_flag(spark, sf):
    return _wide({"all_90DAY_TO-HIGH-RISK-COUNTRY_AMT_CUSTOMER": "hrc_90_amt",
                  "all_360DAY_TO-HIGH-RISK-PARTY_VOL_CUSTOMER": "hrp_360_vol",
                  "incoming-all_180DAY_TO-FOREIGN_MAX_CUSTOMER": "foreign_180_max"})(spark, sf, flagged_transactions(spark, sf))


@query("feat_lookback_offset_flag", sql_features(", ".join([
    amt("country AND dd >= 30 AND dd < 180", "hrc_180_off30_amt"),
    vol("abroad AND dd >= 7 AND dd < 90", "foreign_90_off7_vol")]), extra=_FLAG_SQL, source="flagged"))
def feat_lookback_offset_flag(spark, sf):
    return _wide({"all_180DAY_OFFSET_30DAY_TO-HIGH-RISK-COUNTRY_AMT_CUSTOMER": "hrc_180_off30_amt",
                  "all_90DAY_OFFSET_7DAY_TO-FOREIGN_VOL_CUSTOMER": "foreign_90_off7_vol"})(spark, sf, flagged_transactions(spark, sf))


@query("feat_structured_amount", sql_features(", ".join([
    amt("amount > 45000 AND amount < 50000 AND dd < 180", "structured_180_amt"), vol("amount > 50000 AND dd < 360", "large_360_vol"),
    vol("amount > 20000 AND amount < 30000 AND dd < 90", "mid_90_vol"), amt("amount > 65000 AND dd < 360", "huge_360_amt")])))
def feat_structured_amount(spark, sf):
    return _wide({"all_180DAY_45kto50k_AMT_CUSTOMER": "structured_180_amt", "all_360DAY_greater-than-50k_VOL_CUSTOMER": "large_360_vol",
                  "all_90DAY_20kto30k_VOL_CUSTOMER": "mid_90_vol", "all_360DAY_greater-than-65k_AMT_CUSTOMER": "huge_360_amt"})(spark, sf)


@query("feat_account_level", with_tables("txn alert", f"""
    , r AS (SELECT DISTINCT alert_id AS account, alert_date AS ref_date FROM alert), x AS (SELECT r.account, r.ref_date, t.amount, t.direction,
        date_diff('day', t.txn_date, r.ref_date) AS dd FROM r LEFT JOIN txn t ON t.account = r.account
        AND t.txn_date <= r.ref_date AND t.txn_date > r.ref_date - 360)
    SELECT account, ref_date, {amt("direction = 'incoming-all' AND dd < 180", "in_180_amt")}, {vol("dd < 360", "all_360_vol")}
    FROM x GROUP BY account, ref_date"""))
def feat_account_level(spark, sf):
    refs = t.alerts(spark, sf).select(F.col("alert_id").alias("account"), F.col("alert_date").alias("ref_date")).distinct()
    names = ["incoming-all_180DAY_AMT_ACCOUNT", "all_360DAY_VOL_ACCOUNT"]
    made = ft.feature_matrix(t.transactions(spark, sf), refs, names, CATEGORIES, key="account", level="ACCOUNT")
    return rounded(made.select("account", "ref_date", F.col(f"`{names[0]}`").alias("in_180_amt"), F.col(f"`{names[1]}`").alias("all_360_vol")))


@query("feat_txn_gap", with_tables("txn refs", """
    SELECT r.party, r.ref_date, ROUND(AVG(g.gap), 4) AS gap_90_avg, ROUND(STDDEV_SAMP(g.gap), 4) AS gap_90_sd,
           ROUND(AVG(h.gap), 4) AS gap_180_avg, ROUND(STDDEV_SAMP(h.gap), 4) AS gap_180_sd
    FROM refs r
    LEFT JOIN LATERAL (SELECT date_diff('day', LAG(d) OVER (ORDER BY d), d) AS gap, d FROM
        (SELECT DISTINCT txn_date AS d FROM txn t WHERE t.party = r.party AND t.txn_date <= r.ref_date AND t.txn_date > r.ref_date - 180)) h ON TRUE
    LEFT JOIN LATERAL (SELECT CASE WHEN h.d > r.ref_date - 90 AND h.d - h.gap::INT > r.ref_date - 90 THEN h.gap END AS gap) g ON TRUE
    GROUP BY r.party, r.ref_date"""))
def feat_txn_gap(spark, sf):
    return _wide({"TXN-GAP_90DAY_AVG": "gap_90_avg", "TXN-GAP_90DAY_SD": "gap_90_sd",
                  "TXN-GAP_180DAY_AVG": "gap_180_avg", "TXN-GAP_180DAY_SD": "gap_180_sd"})(spark, sf)


@query("feat_txn_gap_category", with_tables("txn refs", """, d AS (SELECT DISTINCT r.party, r.ref_date, t.txn_date AS d FROM refs r JOIN txn t ON t.party = r.party
        AND t.txn_date <= r.ref_date AND t.txn_date > r.ref_date - 180 AND t.direction = 'incoming-all'),
    g AS (SELECT *, date_diff('day', LAG(d) OVER (PARTITION BY party, ref_date ORDER BY d), d) AS gap FROM d)
    SELECT r.party, r.ref_date, ROUND(AVG(gap), 4) AS in_gap_180_avg, ROUND(STDDEV_SAMP(gap), 4) AS in_gap_180_sd FROM refs r LEFT JOIN g USING (party, ref_date) GROUP BY 1, 2"""))
def feat_txn_gap_category(spark, sf):
    return _wide({"incoming-all_180DAY_TXN-GAP_AVG_CUSTOMER": "in_gap_180_avg", "incoming-all_180DAY_TXN-GAP_SD_CUSTOMER": "in_gap_180_sd"})(spark, sf)


def dist(value: str, pred: str, name: str) -> str:
    return f"CAST(COUNT(DISTINCT CASE WHEN {pred} THEN {value} END) AS BIGINT) AS {name}"


@query("feat_distinct_count", sql_features(", ".join([
    dist("opp_party", "dd < 30", "opp_30"), dist("opp_party", "dd < 360", "opp_360"),
    dist("opp_party", f"{IN} AND dd < 180", "in_opp_180")])))
def feat_distinct_count(spark, sf):
    return _wide({"all_30DAY_DISTINCT-COUNT_CUSTOMER": "opp_30", "all_360DAY_DISTINCT-COUNT_CUSTOMER": "opp_360",
                  "incoming-all_180DAY_DISTINCT-COUNT_CUSTOMER": "in_opp_180"})(spark, sf)


@query("feat_distinct_count_flag", sql_features(", ".join([
    dist("opp_nation", "abroad AND dd < 360", "foreign_countries_360"),
    dist("opp_nation", "country AND dd >= 30 AND dd < 180", "risk_countries_180_off30")]), source="flagged",
    extra=_FLAG_SQL.replace("SELECT x.*", "SELECT x.*, o.opp_nation")))
def feat_distinct_count_flag(spark, sf):
    """The flag says what is counted: here countries."""
    return mixed(spark, sf, {"all_360DAY_TO-FOREIGN_DISTINCT-COUNT_CUSTOMER": "foreign_countries_360",
                             "all_180DAY_OFFSET_30DAY_TO-HIGH-RISK-COUNTRY_DISTINCT-COUNT_CUSTOMER": "risk_countries_180_off30"})


def _young(n: int) -> str:
    return f"COALESCE(CAST(floor(date_diff('day', DATE '1970-01-01' + CAST(opp_party % 12000 AS INT), x.ref_date) / 365.25) AS INT) < {n}, FALSE) AS young_{n}"


@query("feat_age_condition", sql_features(", ".join([
    amt("young_24 AND dd < 360", "young_360_amt"), vol("young_24 AND dd < 180", "young_180_vol"), amt(f"young_27 AND {IN} AND dd >= 30 AND dd < 360", "in_under_27_amt"),
    f"CAST(COUNT(DISTINCT CASE WHEN young_27 AND dd < 360 THEN opp_party END) AS BIGINT) AS under_27_parties", mx("young_24 AND dd < 360", "young_360_max")]),
    extra=f"flagged AS (SELECT x.*, {_young(24)}, {_young(27)} FROM txn_refs x)", source="flagged"))
def feat_age_condition(spark, sf):
    """Counter-parties younger than any number of years at the reference date."""
    return mixed(spark, sf, {"all_360DAY_OPP-PARTY-AGE-UNDER-24_AMT_CUSTOMER": "young_360_amt", "all_180DAY_OPP-PARTY-AGE-UNDER-24_VOL_CUSTOMER": "young_180_vol",
                             "incoming-all_360DAY_OFFSET_30DAY_OPP-PARTY-AGE-UNDER-27_AMT_CUSTOMER": "in_under_27_amt",
                             "all_360DAY_OPP-PARTY-AGE-UNDER-27_DISTINCT-COUNT_CUSTOMER": "under_27_parties", "all_360DAY_OPP-PARTY-AGE-UNDER-24_MAX_CUSTOMER": "young_360_max"})


_ALL_FLAGS = [f for f in ft.FLAG_COLUMNS.values()]


@query("feat_flag_view", with_tables("txn refs opp cust", f""", {_VIEW_SQL}, x AS (SELECT r.party, r.ref_date, t.* EXCLUDE (party) FROM refs r LEFT JOIN flagged t
    ON t.party = r.party AND t.txn_date <= r.ref_date AND t.txn_date > r.ref_date - 360) SELECT party, ref_date, {", ".join(vol(f, f) for f in _ALL_FLAGS)} FROM x GROUP BY 1, 2"""))
def feat_flag_view(spark, sf):
    """All twelve flags of one enriched view."""
    return mixed(spark, sf, {f"all_360DAY_{token}_VOL_CUSTOMER": column for token, column in ft.FLAG_COLUMNS.items()})


def _a(p: str) -> str:
    return f"CAST(COALESCE(SUM(CASE WHEN {p} THEN amount END), 0) AS DOUBLE)"


def _v(p: str) -> str:
    return f"COUNT(CASE WHEN {p} THEN 1 END)"


@query("feat_avg_from_sum", sql_features(", ".join([
    f"ROUND({_a('dd < 90')} / NULLIF({_v('dd < 90')}, 0), 4) AS all_90_avg",
    f"ROUND({_a(OUT + ' AND dd < 360')} / NULLIF({_v(OUT + ' AND dd < 360')}, 0), 4) AS out_360_avg"])))
def feat_avg_from_sum(spark, sf):
    return _wide({"all_90DAY_AVG_CUSTOMER": "all_90_avg", "outgoing-all_360DAY_AVG_CUSTOMER": "out_360_avg"})(spark, sf)


@query("feat_monthly_avg", sql_features(", ".join([
    f"ROUND({_a('dd < 90')} / 3, 4) AS m3", f"ROUND({_a('dd < 180')} / 6, 4) AS m6", f"ROUND({_a('dd < 360')} / 12, 4) AS m12"])))
def feat_monthly_avg(spark, sf):
    return _wide({f"all_{m}_MONTHLY_AVG_CUSTOMER": c for m, c in (("3MONTH", "m3"), ("6MONTH", "m6"), ("12MONTH", "m12"))})(spark, sf)


@query("feat_ratio", sql_features(
    f"ROUND({_a(IN + ' AND dd < 30')} / NULLIF({_a(IN + ' AND dd < 90')}, 0), 4) AS r_amt, "
    f"ROUND(({_a('dd < 30')} / NULLIF({_v('dd < 30')}, 0)) / NULLIF({_a('dd >= 30 AND dd < 180')} / NULLIF({_v('dd >= 30 AND dd < 180')}, 0), 0), 4) AS r_avg"))
def feat_ratio(spark, sf):
    return _wide({"ratio_incoming-all_30DAY_AMT_CUSTOMER_incoming-all_90DAY_AMT_CUSTOMER": "r_amt",
                  "ratio_all_30DAY_AVG_CUSTOMER_all_180DAY_OFFSET_30DAY_AVG_CUSTOMER": "r_avg"})(spark, sf)


@query("feat_net", sql_features(f"ROUND({_a(IN + ' AND dd < 90')} - {_a(OUT + ' AND dd < 90')}, 2) AS net_90"))
def feat_net(spark, sf):
    return _wide({"net_incoming-all_90DAY_AMT_CUSTOMER_outgoing-all_90DAY_AMT_CUSTOMER": "net_90"})(spark, sf, digits=2)


@query("feat_flow_through", sql_features(
    f"ROUND(COALESCE(LEAST({_a(IN + ' AND dd < 30')}, {_a(OUT + ' AND dd < 30')}) / NULLIF(GREATEST({_a(IN + ' AND dd < 30')}, {_a(OUT + ' AND dd < 30')}), 0), 0), 4) AS flow_30"))
def feat_flow_through(spark, sf):
    return _wide({"flow-through-adj_outgoing-all_30DAY_AMT_CUSTOMER_incoming-all_30DAY_AMT_CUSTOMER": "flow_30"})(spark, sf)


@query("feat_plan", sql_features(", ".join([
    f"ROUND({_a(IN + ' AND dd < 90')} / NULLIF({_v(IN + ' AND dd < 90')}, 0), 4) AS in_90_avg",
    f"ROUND({_a(IN + ' AND dd < 90')} / 3, 4) AS in_3m", vol(f"{IN} AND dd < 90", "in_90_vol"),
    f"ROUND({_a(IN + ' AND dd < 90')} / NULLIF({_a(OUT + ' AND dd < 90')}, 0), 4) AS in_out_90"])))
def feat_plan(spark, sf):
    """Four requested names share three first-level sums."""
    return _wide({"incoming-all_90DAY_AVG_CUSTOMER": "in_90_avg", "incoming-all_3MONTH_MONTHLY_AVG_CUSTOMER": "in_3m",
                  "incoming-all_90DAY_VOL_CUSTOMER": "in_90_vol",
                  "ratio_incoming-all_90DAY_AMT_CUSTOMER_outgoing-all_90DAY_AMT_CUSTOMER": "in_out_90"})(spark, sf)


# ---- alert history -------------------------------------------------------------------

ALERT_SQL = with_tables("refs hist", """, j AS (SELECT r.party, r.ref_date, h.result, date_diff('day', h.alert_date, r.ref_date) AS dd
    FROM refs r LEFT JOIN hist h ON h.party = r.party AND h.alert_date <= r.ref_date AND h.alert_date > r.ref_date - 360)
    SELECT party, ref_date, {cols} FROM j GROUP BY party, ref_date""")


@query("feat_alert_count", ALERT_SQL.format(cols=", ".join([vol("dd < 90", "alert_90"), vol("dd < 360", "alert_360")])))
def feat_alert_count(spark, sf):
    return mixed(spark, sf, {f"ALERT_{n}DAY_COUNT_CUSTOMER": f"alert_{n}" for n in (90, 360)})


@query("feat_alert_str", ALERT_SQL.format(cols=", ".join([vol("result = 'F' AND dd < 180", "str_180"), vol("result = 'F' AND dd < 360", "str_360")])))
def feat_alert_str(spark, sf):
    return mixed(spark, sf, {f"STR_{n}DAY_COUNT_CUSTOMER": f"str_{n}" for n in (180, 360)})


@query("feat_alert_fstr", ALERT_SQL.format(cols=", ".join([vol("result = 'O' AND dd < 180", "fstr_180"), vol("result = 'O' AND dd < 360", "fstr_360")])))
def feat_alert_fstr(spark, sf):
    return mixed(spark, sf, {f"FSTR_{n}DAY_COUNT_CUSTOMER": f"fstr_{n}" for n in (180, 360)})


@query("feat_alert_cdd", ALERT_SQL.replace("hist h", "cdd h").replace(", j AS", """, cdd AS (SELECT o_custkey AS party, CAST(o_orderdate AS DATE) AS alert_date, o_orderstatus AS result
    FROM orders WHERE o_orderpriority = '3-MEDIUM'), j AS""").format(
    cols=", ".join([vol("dd < 360", "cdd_360"), vol("result = 'F' AND dd < 360", "cdd_str_360"), vol("result = 'O' AND dd >= 30 AND dd < 360", "cdd_fstr_360_off30")])))
def feat_alert_cdd(spark, sf):
    return mixed(spark, sf, {"CDD-ALERT_360DAY_COUNT_CUSTOMER": "cdd_360", "CDD-STR_360DAY_COUNT_CUSTOMER": "cdd_str_360",
                             "CDD-FSTR_360DAY_OFFSET_30DAY_COUNT_CUSTOMER": "cdd_fstr_360_off30"})


@query("feat_alert_offset", ALERT_SQL.format(cols=", ".join([vol("dd >= 90 AND dd < 360", "alert_360_off90"), vol("result = 'O' AND dd >= 30 AND dd < 180", "fstr_180_off30")])))
def feat_alert_offset(spark, sf):
    return mixed(spark, sf, {"ALERT_360DAY_OFFSET_90DAY_COUNT_CUSTOMER": "alert_360_off90", "FSTR_180DAY_OFFSET_30DAY_COUNT_CUSTOMER": "fstr_180_off30"})


FALSE_360 = "result = 'O' AND dd < 360"


@query("feat_alert_ratio", ALERT_SQL.format(cols=f"ROUND({_v(FALSE_360)} / CAST(NULLIF({_v('dd < 360')}, 0) AS DOUBLE), 4) AS fstr_share_360"))
def feat_alert_ratio(spark, sf):
    return mixed(spark, sf, {"ratio_FSTR_360DAY_COUNT_CUSTOMER_ALERT_360DAY_COUNT_CUSTOMER": "fstr_share_360"})


# ---- skew, series, matrices ----------------------------------------------------------

AGG_SQL = with_tables("txn", """SELECT {key}, CAST(COUNT(*) AS BIGINT) AS vol, CAST(SUM(amount) AS DOUBLE) AS amt,
    CAST(MAX(amount) AS DOUBLE) AS max, ROUND(STDDEV_SAMP(CAST(amount AS DOUBLE)), 2) AS sd,
    CAST(COUNT(DISTINCT opp_party) AS BIGINT) AS distinct_count FROM txn GROUP BY 1""")


@query("salted_two_stage_agg", AGG_SQL.format(key="category"))
def salted_two_stage_agg(spark, sf):
    """A few categories, so every key is hot."""
    return rounded(lb.skew_safe_agg(t.transactions(spark, sf), "category", "amount", "opp_party"), 2)


@query("partition_pre_agg", AGG_SQL.format(key="party"))
def partition_pre_agg(spark, sf):
    return rounded(lb.skew_safe_agg(t.transactions(spark, sf), "party", "amount", "opp_party"), 2)


_SHIFTS = (0, 30, 60, 90, 120, 150)


@query("feat_risk_indicator_series", sql_features(", ".join(
    [amt(f"{IN} AND dd >= {s} AND dd < {s + 30}", f"in_30_amt_t{s}") for s in _SHIFTS] +
    [vol(f"{OUT} AND dd >= {s} AND dd < {s + 30}", f"out_30_vol_t{s}") for s in _SHIFTS])))
def feat_risk_indicator_series(spark, sf):
    txn, refs = txn_and_refs(spark, sf)
    base = [ft.parse_first("incoming-all_30DAY_AMT", CATEGORIES), ft.parse_first("outgoing-all_30DAY_VOL", CATEGORIES)]
    names = ["in_30_amt", "out_30_vol"]
    specs = [b.shifted(s, f"{n}_t{s}") for b, n in zip(base, names) for s in _SHIFTS]
    return lb.lookback_features(txn, refs, specs)


@query("feat_matrix_customer", with_tables("txn alert hist cust", """,
    refd AS (SELECT c.party, GREATEST(COALESCE(m.d, a.d), COALESCE(a.d, m.d)) AS ref_date FROM cust c
        LEFT JOIN (SELECT party, MAX(txn_date) AS d FROM txn GROUP BY 1) m USING (party)
        LEFT JOIN (SELECT party, MAX(alert_date) AS d FROM alert GROUP BY 1) a USING (party) WHERE COALESCE(m.d, a.d) IS NOT NULL),
    f AS (SELECT r.party, r.ref_date, CAST(COALESCE(SUM(amount), 0) AS DOUBLE) AS amt_360, CAST(COUNT(amount) AS BIGINT) AS vol_360
        FROM refd r LEFT JOIN txn t ON t.party = r.party AND txn_date <= ref_date AND txn_date > ref_date - 360 GROUP BY 1, 2),
    g AS (SELECT r.party, r.ref_date, CAST(COUNT(alert_id) AS BIGINT) AS alert_360
        FROM refd r LEFT JOIN hist h ON h.party = r.party AND alert_date <= ref_date AND alert_date > ref_date - 360 GROUP BY 1, 2)
    SELECT party, ref_date, amt_360, vol_360, alert_360 FROM f JOIN g USING (party, ref_date)"""))
def feat_matrix_customer(spark, sf):
    refs = enrich.reference_dates(t.customers(spark, sf).select("party"), t.transactions(spark, sf), t.alerts(spark, sf)).filter("ref_date is not null")
    return mixed(spark, sf, {"all_360DAY_AMT_CUSTOMER": "amt_360", "all_360DAY_VOL_CUSTOMER": "vol_360", "ALERT_360DAY_COUNT_CUSTOMER": "alert_360"}, refs)


@query("feat_matrix_alert", with_tables("txn alert hist opp cust", f""", {_VIEW_SQL},
    f AS (SELECT a.alert_id, CAST(COALESCE(SUM(amount), 0) AS DOUBLE) AS amt_90, CAST(COUNT(amount) AS BIGINT) AS vol_90,
        CAST(COUNT(DISTINCT CASE WHEN to_foreign THEN opp_country END) AS BIGINT) AS foreign_90, CAST(COUNT(DISTINCT opp_account) AS BIGINT) AS accounts_90,
        CAST(MAX(CASE WHEN with_pep THEN amount END) AS DOUBLE) AS pep_90_max, ROUND(AVG(CASE WHEN direction = 'incoming-all' THEN amount END), 4) AS in_90_avg
        FROM alert a LEFT JOIN flagged t ON t.party = a.party AND txn_date <= a.alert_date AND txn_date > a.alert_date - 90 GROUP BY 1),
    c AS (SELECT a.alert_id, CAST(COALESCE(SUM(amount), 0) AS DOUBLE) AS account_360
        FROM alert a LEFT JOIN txn t ON t.account = a.alert_id AND txn_date <= a.alert_date AND txn_date > a.alert_date - 360 GROUP BY 1),
    g AS (SELECT a.alert_id, CAST(COUNT(h.alert_id) AS BIGINT) AS alert_180, CAST(COUNT(CASE WHEN h.result = 'F' THEN 1 END) AS BIGINT) AS str_180
        FROM alert a LEFT JOIN hist h ON h.party = a.party AND h.alert_date <= a.alert_date AND h.alert_date > a.alert_date - 180 GROUP BY 1)
    SELECT alert_id, party, alert_date, amt_90, vol_90, alert_180, str_180, foreign_90, accounts_90, pep_90_max, in_90_avg, account_360
    FROM alert JOIN f USING (alert_id) JOIN g USING (alert_id) JOIN c USING (alert_id)"""))
def feat_matrix_alert(spark, sf):
    """Transactions of the party and of the account, past alerts, flags and distinct values from one list of names."""
    alerts = t.alerts(spark, sf).withColumn("account", F.col("alert_id"))
    names = {"all_90DAY_AMT_CUSTOMER": "amt_90", "all_90DAY_VOL_CUSTOMER": "vol_90", "ALERT_180DAY_COUNT_CUSTOMER": "alert_180", "STR_180DAY_COUNT_CUSTOMER": "str_180",
             "all_90DAY_TO-FOREIGN_DISTINCT-COUNT_CUSTOMER": "foreign_90", "all_90DAY_DISTINCT-COUNT_CUSTOMER": "accounts_90", "all_90DAY_WITH-PEP_MAX_CUSTOMER": "pep_90_max",
             "incoming-all_90DAY_AVG_CUSTOMER": "in_90_avg", "all_360DAY_AMT_ACCOUNT": "account_360"}
    points = mixed(spark, sf, names, alerts.select("party", "account", F.col("alert_date").alias("ref_date")), {"CUSTOMER": "party", "ACCOUNT": "account"})
    points = points.withColumnRenamed("ref_date", "alert_date")
    return alerts.select("alert_id", "party", "account", "alert_date").join(points, ["party", "account", "alert_date"], "left").drop("account")

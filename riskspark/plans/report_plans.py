"""Queries over report tables and the synthetic data generator."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskspark.functions import levels as lv
from riskspark.operators import enrich, lookback as lb, reports as rp, shape
from riskspark.operators.store import KeyedStore
from riskspark.plans.base_sql import with_tables
from riskspark.plans.registry import query
from riskspark.sources import generate as gen, tables as t
from riskspark.sources.session import ensure_checkpoint_dir

RUN = "2024-01-31"

COMPONENTS = {"5-LOW": "ctb", "4-NOT SPECIFIED": "nla", "2-HIGH": "scr"}
COMP_SQL = with_tables("", """comp AS (SELECT o_custkey AS party, CASE o_orderpriority WHEN '5-LOW' THEN 'ctb' WHEN '4-NOT SPECIFIED' THEN 'nla' ELSE 'scr' END AS component, CAST(o_orderdate AS DATE) AS created,
    o_orderkey AS score_id, round(o_totalprice / 600000.0, 4) AS score, o_custkey % 9 AS cluster FROM orders WHERE o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED', '2-HIGH')),
    newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY party, component ORDER BY created DESC, score_id DESC) AS rn FROM comp) WHERE rn = 1)""")


def components(spark, sf):
    orders = t.load(spark, sf, "orders").filter(F.col("o_orderpriority").isin(*COMPONENTS))
    return orders.select(
        F.col("o_custkey").alias("party"), shape.recode("o_orderpriority", {v: [k] for k, v in COMPONENTS.items()}).alias("component"),
        F.col("o_orderdate").cast("date").alias("created"), F.col("o_orderkey").alias("score_id"), F.round(F.col("o_totalprice") / 600000.0, 4).alias("score"),
        F.to_json(F.struct((F.col("o_custkey") % 9).cast("string").alias("CLUSTER_ID"), F.lit("7").alias("MODEL_ID"))).alias("attributes"))


@query("latest_component", COMP_SQL + " SELECT party, component, created, score_id, score, CAST(cluster AS VARCHAR) AS cluster_id, '7' AS model_id FROM newest")
def latest_component(spark, sf):
    return rp.latest_component(components(spark, sf))


PRODUCT_SQL = """(SELECT party, string_agg(name, ', ' ORDER BY name) AS products FROM (SELECT DISTINCT o_custkey AS party,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Current account' WHEN '2-HIGH' THEN 'Savings account' ELSE o_orderpriority END AS name FROM orders WHERE {w}) GROUP BY 1)"""


def products(spark, sf, where="true"):
    held = t.load(spark, sf, "orders").filter(where).select(F.col("o_custkey").alias("party"), F.col("o_orderpriority").alias("code"))
    codes = spark.createDataFrame([("1-URGENT", "Current account"), ("2-HIGH", "Savings account")], "code string, description string")
    return rp.product_list(held, codes)


@query("product_list", f"SELECT * FROM {PRODUCT_SQL.format(w='TRUE')}")
def product_list(spark, sf):
    return products(spark, sf)


UPSERT_SQL = COMP_SQL + f""", prev AS (SELECT * FROM (SELECT o_custkey AS party, round(o_totalprice / 600000.0, 4) AS s, CASE WHEN o_totalprice > 300000 THEN 'High' ELSE 'Low' END AS risk_level, o_orderkey % 3 AS str_count,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders WHERE o_orderpriority = '3-MEDIUM') WHERE rn = 1),
    kyc AS (SELECT c_custkey AS party, c_acctbal AS kyc_new, c_mktsegment AS segment_new FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
    trues AS (SELECT o_custkey AS party, COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
    ids AS (SELECT party FROM prev UNION SELECT party FROM kyc UNION SELECT party FROM newest UNION SELECT party FROM trues UNION SELECT party FROM {PRODUCT_SQL.format(w='o_totalprice > 200000')})
    SELECT i.party, COALESCE(kyc_new, p.s) AS kyc_score, COALESCE(segment_new, CASE WHEN p.party IS NOT NULL THEN 'OLD' END) AS segment, COALESCE(c.score, p.s) AS ctb_score, COALESCE(n.score, p.s) AS nla_score, COALESCE(s.score, p.s) AS scr_score,
        CAST(COALESCE(tr.n, 0) + COALESCE(p.str_count, 0) AS BIGINT) AS str_count, COALESCE(pr.products, CASE WHEN p.party IS NOT NULL THEN 'OLD' END) AS product,
        COALESCE(NULLIF(concat_ws(',', CASE WHEN c.party IS NOT NULL THEN 'ctb changed' END, CASE WHEN n.party IS NOT NULL THEN 'nla changed' END, CASE WHEN s.party IS NOT NULL THEN 'scr changed' END), ''), CASE WHEN p.party IS NOT NULL THEN 'OLD' END) AS reason,
        COALESCE(c.score, p.s) AS overall_score, p.risk_level AS previous_risk_level,
        COALESCE(CASE WHEN c.score >= 0.6 THEN 'High' WHEN c.score >= 0.2 THEN 'Medium' WHEN c.score IS NOT NULL THEN 'Low' END, p.risk_level) AS risk_level, DATE '{RUN}' AS created
    FROM ids i LEFT JOIN prev p USING (party) LEFT JOIN kyc USING (party) LEFT JOIN newest c ON c.party = i.party AND c.component = 'ctb' LEFT JOIN newest n ON n.party = i.party AND n.component = 'nla'
    LEFT JOIN newest s ON s.party = i.party AND s.component = 'scr' LEFT JOIN trues tr ON tr.party = i.party LEFT JOIN {PRODUCT_SQL.format(w='o_totalprice > 200000')} pr ON pr.party = i.party"""


@query("customer_history_upsert", UPSERT_SQL)
def customer_history_upsert(spark, sf):
    s = F.round(F.col("o_totalprice") / 600000.0, 4)
    previous = t.load(spark, sf, "orders").filter("o_orderpriority = '3-MEDIUM'").select(
        F.col("o_custkey").alias("party"), F.col("o_orderdate").cast("date").alias("created"), F.col("o_orderkey").alias("history_id"),
        *[s.alias(c) for c in ("kyc_score", "ctb_score", "nla_score", "scr_score")], F.lit("OLD").alias("segment"), F.lit("OLD").alias("product"), F.lit("OLD").alias("reason"),
        F.when(F.col("o_totalprice") > 300000, "High").otherwise("Low").alias("risk_level"), (F.col("o_orderkey") % 3).alias("str_count"))
    kyc = t.load(spark, sf, "customer").filter("c_mktsegment IN ('BUILDING', 'MACHINERY')").select(
        F.col("c_custkey").alias("party"), F.col("c_acctbal").alias("kyc_score"), F.col("c_mktsegment").alias("segment"))
    newest = rp.latest_component(components(spark, sf))
    parts = {}
    for name in COMPONENTS.values():
        part = newest.filter(F.col("component") == name).select("party", "score", F.lit(f"{name} changed").alias("reason"))
        parts[name] = part.withColumn("level", lv.level_hml(F.col("score"), 0.6, 0.2)) if name == "ctb" else part
    results = t.alerts(spark, sf).withColumn("result", F.when(F.col("result") == "F", "STR").otherwise("Non-STR"))
    return rp.history_upsert(previous, kyc, parts, rp.true_counts(results), products(spark, sf, "o_totalprice > 200000"), F.lit(RUN).cast("date"))


# runs of the stored history: newest date, segment of the customers whose score came with it
HISTORY_RUNS = [("1997-12-31", "BUILDING"), ("1999-12-31", "MACHINERY"), ("2024-01-31", "FURNITURE")]
HISTORY_COLS = ["kyc_score", "segment", "ctb_score", "nla_score", "scr_score", "str_count", "product", "reason", "overall_score", "previous_risk_level", "risk_level", "created"]


def history_run_sql(k: int) -> str:
    run, segment = HISTORY_RUNS[k]
    since = f"CAST(o_orderdate AS DATE) > DATE '{HISTORY_RUNS[k - 1][0]}' AND " if k else ""
    held = f"{since}CAST(o_orderdate AS DATE) <= DATE '{run}'"
    return f""", kyc{k} AS (SELECT c_custkey AS party, c_acctbal AS kyc_new, c_mktsegment AS segment_new FROM customer WHERE c_mktsegment = '{segment}'),
    n{k} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY party, component ORDER BY created DESC, score_id DESC) AS rn FROM comp WHERE {held.replace('o_orderdate', 'created')}) WHERE rn = 1),
    t{k} AS (SELECT o_custkey AS party, COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n FROM orders WHERE o_orderpriority = '1-URGENT' AND {held} GROUP BY 1),
    pr{k} AS (SELECT * FROM {PRODUCT_SQL.format(w='o_totalprice > 400000 AND ' + held)}),
    i{k} AS (SELECT party FROM kyc{k} UNION SELECT party FROM n{k} UNION SELECT party FROM t{k} UNION SELECT party FROM pr{k}),
    h{k + 1} AS (SELECT i.party, COALESCE(kyc_new, p.kyc_score) AS kyc_score, COALESCE(segment_new, p.segment) AS segment, COALESCE(c.score, p.ctb_score) AS ctb_score, COALESCE(n.score, p.nla_score) AS nla_score,
        COALESCE(s.score, p.scr_score) AS scr_score, CAST(COALESCE(tr.n, 0) + COALESCE(p.str_count, 0) AS BIGINT) AS str_count, COALESCE(pr.products, p.product) AS product,
        COALESCE(NULLIF(concat_ws(',', CASE WHEN c.party IS NOT NULL THEN 'ctb changed' END, CASE WHEN n.party IS NOT NULL THEN 'nla changed' END, CASE WHEN s.party IS NOT NULL THEN 'scr changed' END), ''), p.reason) AS reason,
        COALESCE(c.score, p.ctb_score) AS overall_score, p.risk_level AS previous_risk_level,
        COALESCE(CASE WHEN c.score >= 0.6 THEN 'High' WHEN c.score >= 0.2 THEN 'Medium' WHEN c.score IS NOT NULL THEN 'Low' END, p.risk_level) AS risk_level, DATE '{run}' AS created
        FROM i{k} i LEFT JOIN h{k} p USING (party) LEFT JOIN kyc{k} USING (party) LEFT JOIN n{k} c ON c.party = i.party AND c.component = 'ctb' LEFT JOIN n{k} n ON n.party = i.party AND n.component = 'nla'
        LEFT JOIN n{k} s ON s.party = i.party AND s.component = 'scr' LEFT JOIN t{k} tr ON tr.party = i.party LEFT JOIN pr{k} pr ON pr.party = i.party
        UNION ALL SELECT party, {', '.join(HISTORY_COLS)} FROM h{k} WHERE party NOT IN (SELECT party FROM i{k}))"""


STORE_SQL = COMP_SQL + f""", h0 AS (SELECT party, s AS kyc_score, 'OLD' AS segment, s AS ctb_score, s AS nla_score, s AS scr_score, CAST(k AS BIGINT) AS str_count, 'OLD' AS product, 'OLD' AS reason,
        s AS overall_score, CAST(NULL AS VARCHAR) AS previous_risk_level, CASE WHEN s > 0.5 THEN 'High' ELSE 'Low' END AS risk_level, CAST(d AS DATE) AS created
        FROM (SELECT o_custkey AS party, round(o_totalprice / 600000.0, 4) AS s, o_orderkey % 3 AS k, o_orderdate AS d, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn
              FROM orders WHERE o_orderpriority = '3-MEDIUM') WHERE rn = 1)""" + "".join(history_run_sql(k) for k in range(len(HISTORY_RUNS))) + f" SELECT * FROM h{len(HISTORY_RUNS)}"


@query("customer_history_store", STORE_SQL)
def customer_history_store(spark, sf):
    """The stored history after three runs, each of which rewrites the buckets of its customers."""
    orders = t.load(spark, sf, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    s = F.round(F.col("o_totalprice") / 600000.0, 4)
    first = shape.latest(orders.filter("o_orderpriority = '3-MEDIUM'").select(
        F.col("o_custkey").alias("party"), "day", "o_orderkey", s.alias("s")), ["party"], ["day", "o_orderkey"])
    store = KeyedStore(spark, f"{ensure_checkpoint_dir(spark)}/history-{uuid.uuid4().hex}", "party", 64)
    store.create(first.select(
        "party", F.col("s").alias("kyc_score"), F.lit("OLD").alias("segment"), *[F.col("s").alias(f"{c}_score") for c in ("ctb", "nla", "scr")],
        (F.col("o_orderkey") % 3).cast("bigint").alias("str_count"), F.lit("OLD").alias("product"), F.lit("OLD").alias("reason"), F.col("s").alias("overall_score"),
        F.lit(None).cast("string").alias("previous_risk_level"), F.when(F.col("s") > 0.5, "High").otherwise("Low").alias("risk_level"), F.col("day").alias("created")))
    since = None
    for run, segment in HISTORY_RUNS:
        inside = f"{{0}} <= DATE '{run}'" + (f" AND {{0}} > DATE '{since}'" if since else "")
        kyc = t.load(spark, sf, "customer").filter(F.col("c_mktsegment") == segment).select(
            F.col("c_custkey").alias("party"), F.col("c_acctbal").alias("kyc_score"), F.col("c_mktsegment").alias("segment"))
        newest = rp.latest_component(components(spark, sf).filter(inside.format("created")))
        parts = {}
        for name in COMPONENTS.values():
            part = newest.filter(F.col("component") == name).select("party", "score", F.lit(f"{name} changed").alias("reason"))
            parts[name] = part.withColumn("level", lv.level_hml(F.col("score"), 0.6, 0.2)) if name == "ctb" else part
        results = t.alerts(spark, sf).filter(inside.format("alert_date")).withColumn("result", F.when(F.col("result") == "F", "STR").otherwise("Non-STR"))
        held = products(spark, sf, "o_totalprice > 400000 AND " + inside.format("CAST(o_orderdate AS DATE)"))
        rp.store_upsert(store, kyc, parts, rp.true_counts(results), held, F.lit(run).cast("date"))
        since = run
    return store.read()


@query("customers_profile", with_tables("cust hrp", """, l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY party ORDER BY COALESCE(expiry_date, DATE '9999-12-31') DESC, start_date DESC, interval_id DESC) AS rn FROM hrp) WHERE rn = 1)
    SELECT c.party, c.name, c.segment, CASE WHEN l.party IS NOT NULL THEN '{"id":"' || l.interval_id || '","start":"' || strftime(l.start_date, '%Y-%m-%d') || '","expiry":"' || COALESCE(strftime(l.expiry_date, '%Y-%m-%d'), 'open') || '"}' END AS high_risk_info
    FROM cust c LEFT JOIN l USING (party)"""))
def customers_profile(spark, sf):
    return rp.customers_profile(t.customers(spark, sf).select("party", "name", "segment"), t.high_risk_intervals(spark, sf))


@query("alerts_unified", with_tables("alert cust", """, s AS (SELECT o_orderkey AS alert_id, round(o_totalprice / 600000.0, 4) AS p FROM orders)
    SELECT alert_id, CAST(14 AS INT) AS alert_source, alert_date, ROUND(p * 100.0, 2) AS alert_score, CASE WHEN p >= 0.6 THEN 'High' WHEN p >= 0.2 THEN 'Medium' ELSE 'Low' END AS alert_level,
    CAST(date_diff('day', alert_date, DATE '2024-01-31') AS INT) AS alert_age, a.party, segment, country FROM alert a JOIN s USING (alert_id) LEFT JOIN cust c ON c.party = a.party"""))
def alerts_unified(spark, sf):
    scores = t.load(spark, sf, "orders").select(F.col("o_orderkey").alias("alert_id"), F.round(F.col("o_totalprice") / 600000.0, 4).alias("p"))
    bucket = F.when(F.col("p") >= 0.6, "L3").when(F.col("p") >= 0.2, "L2").otherwise("L1")
    df = t.alerts(spark, sf).join(scores, "alert_id").join(t.customers(spark, sf).select("party", "segment", "country"), "party", "left")
    return df.select("alert_id", F.lit(14).alias("alert_source"), "alert_date", F.round(F.col("p") * 100.0, 2).alias("alert_score"), rp.alert_level(bucket).alias("alert_level"),
                     F.datediff(F.lit(RUN).cast("date"), "alert_date").alias("alert_age"), "party", "segment", "country")


@query("alerted_customers", with_tables("alert cust hrp txn refs", """, v AS (SELECT a.party, a.alert_date, MAX(h.start_date) AS risk_since FROM (SELECT DISTINCT party, alert_date FROM alert) a LEFT JOIN hrp h ON h.party = a.party AND a.alert_date >= h.start_date AND (h.expiry_date IS NULL OR a.alert_date <= h.expiry_date) GROUP BY 1, 2),
    s AS (SELECT r.party, r.ref_date, COALESCE(SUM(CASE WHEN txn_date > ref_date - 90 THEN amount END), 0) AS a90, COUNT(CASE WHEN txn_date > ref_date - 90 THEN 1 END) AS n90 FROM refs r LEFT JOIN txn t ON t.party = r.party AND txn_date <= ref_date AND txn_date > ref_date - 90 GROUP BY 1, 2)
    SELECT a.alert_id, a.party, c.name, c.segment, v.risk_since, '{"amount_90":"' || CAST(CAST(s.a90 AS DECIMAL(38,2)) AS VARCHAR) || '","count_90":' || s.n90 || '}' AS activity
    FROM alert a JOIN cust c USING (party) JOIN v ON v.party = a.party AND v.alert_date = a.alert_date JOIN s ON s.party = a.party AND s.ref_date = a.alert_date"""))
def alerted_customers(spark, sf):
    alerts = t.alerts(spark, sf)
    refs = t.reference_points(alerts)
    sums = lb.lookback_features(t.transactions(spark, sf), refs, [lb.Spec("a", "AMT", 90), lb.Spec("n", "VOL", 90)])
    activity = sums.select("party", F.col("ref_date").alias("alert_date"), F.to_json(F.struct(
        F.col("a").cast("decimal(38,2)").cast("string").alias("amount_90"), F.col("n").alias("count_90"))).alias("activity"))
    risk = enrich.valid_intervals(alerts, t.high_risk_intervals(spark, sf), "party", "alert_date").select("party", "alert_date", F.col("start_date").alias("risk_since"))
    cust = t.customers(spark, sf).select("party", "name", "segment")
    points = risk.join(activity, ["party", "alert_date"])
    return alerts.join(cust, "party").join(points, ["party", "alert_date"]).select("alert_id", "party", "name", "segment", "risk_since", "activity")


@query("alerted_linked_customers", with_tables("alert link", """, r AS (SELECT party, MAX(alert_date) AS ref_date FROM alert GROUP BY 1),
    a AS (SELECT l.*, row_number() OVER (PARTITION BY l.party, linked_party, relation ORDER BY COALESCE(end_date, DATE '9999-12-31') DESC, link_id DESC) AS rn FROM link l JOIN r USING (party) WHERE end_date IS NULL OR end_date > ref_date)
    SELECT r.party, r.ref_date, a.linked_party, a.relation, a.link_id FROM r LEFT JOIN (SELECT * FROM a WHERE rn = 1) a USING (party)"""))
def alerted_linked_customers(spark, sf):
    return rp.active_latest_links(t.links(spark, sf), t.alerts(spark, sf))


@query("alerted_accounts", with_tables("alert acct", """ SELECT account, party, open_date, COALESCE(CASE WHEN account_type = '1-URGENT' THEN 'L' || account END, CASE WHEN account_type IN ('2-HIGH', '1-URGENT') THEN 'D' || account END, CASE WHEN account_type <> '5-LOW' THEN 'C' || account END) AS product_id,
    CASE WHEN account_type = '1-URGENT' THEN 'loan' WHEN account_type IN ('2-HIGH', '1-URGENT') THEN 'deposit' WHEN account_type <> '5-LOW' THEN 'card' END AS product_kind FROM acct WHERE party IN (SELECT party FROM alert)"""))
def alerted_accounts(spark, sf):
    base = t.load(spark, sf, "orders").select(F.col("o_orderkey").alias("account"), F.col("o_orderpriority").alias("account_type"))

    def product(kind, letter, condition):
        return base.filter(condition).select("account", F.concat(F.lit(letter), F.col("account").cast("string")).alias(f"{kind}_key"))
    held = {"loan": product("loan", "L", "account_type = '1-URGENT'"), "deposit": product("deposit", "D", "account_type IN ('2-HIGH', '1-URGENT')"), "card": product("card", "C", "account_type <> '5-LOW'")}
    acct = t.load(spark, sf, "orders").select(F.col("o_orderkey").alias("account"), F.col("o_custkey").alias("party"), F.col("o_orderdate").cast("date").alias("open_date"))
    return rp.alerted_accounts(acct, t.alerts(spark, sf), held)


@query("alerted_transactions", with_tables("alert txn opp", """ SELECT party, opp_region = 0 AS high_risk_country, direction = 'incoming-all' AS is_credit, CASE WHEN account % 4 = 0 THEN opp_name || ';' || opp_country ELSE CAST(account + 1 AS VARCHAR) END AS counter_party,
    CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(amount) AS DOUBLE) AS amount FROM txn LEFT JOIN opp USING (opp_party) WHERE party IN (SELECT party FROM alert) GROUP BY 1, 2, 3, 4"""))
def alerted_transactions(spark, sf):
    alerted = t.alerts(spark, sf).select("party").distinct()
    txn = t.transactions(spark, sf).join(alerted, "party", "left_semi")
    txn = enrich.add_attrs(txn, t.counterparties(spark, sf), "opp_party", ["opp_name", "opp_country", "opp_nation"])
    txn = enrich.flag_member(txn, t.high_risk_countries(spark, sf), "opp_nation", "risky")
    opp_account = F.when(F.col("account") % 4 != 0, (F.col("account") + 1).cast("string"))
    rows = txn.select("party", F.coalesce("risky", F.lit(False)).alias("high_risk_country"),
                      shape.recode("direction", {True: ["incoming-all"], False: ["outgoing-all"]}).alias("is_credit"),
                      F.coalesce(opp_account, F.concat_ws(";", "opp_name", "opp_country")).alias("counter_party"), "amount")
    return rows.groupBy("party", "high_risk_country", "is_credit", "counter_party").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("amount"))


TAG_SQL = with_tables("scored hist", """, p AS (SELECT party, MAX(score) AS score, MAX(label) AS label FROM scored WHERE segment = '1-URGENT' GROUP BY 1),
    h AS (SELECT party, COUNT(CASE WHEN result IN ('F', 'O') THEN 1 END) AS past, COUNT(CASE WHEN result = 'F' THEN 1 END) AS past_true, COUNT(CASE WHEN result = 'O' THEN 1 END) AS past_false FROM hist GROUP BY 1),
    tag AS (SELECT c_custkey AS party, CASE WHEN c_custkey % 50 <> 0 THEN c_mktsegment END AS segment, label, CASE WHEN COALESCE(score, 0) >= 0.6 THEN 'High' WHEN COALESCE(score, 0) <= 0.2 THEN 'Low' ELSE 'Medium' END AS ours,
        CASE WHEN c_custkey % 20 = 0 THEN NULL WHEN c_acctbal > 6000 THEN 'High' WHEN c_acctbal < 1500 THEN 'Low' ELSE 'Medium' END AS bank, past, past_true, past_false FROM customer LEFT JOIN p ON p.party = c_custkey LEFT JOIN h ON h.party = c_custkey)""")


def tagged(spark, sf):
    best = t.scored_alerts(spark, sf).filter("segment = '1-URGENT'").groupBy("party").agg(F.max("score").alias("score"), F.max("label").alias("label"))
    cust = t.load(spark, sf, "customer").select(
        F.col("c_custkey").alias("party"), F.when(F.col("c_custkey") % 50 != 0, F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_custkey") % 20 != 0, F.when(F.col("c_acctbal") > 6000, "High").when(F.col("c_acctbal") < 1500, "Low").otherwise("Medium")).alias("bank"))
    return cust.join(best, "party", "left").select("party", "segment", "label", lv.level_tag(F.coalesce("score", F.lit(0.0)), 0.6, 0.2).alias("ours"), "bank")


@query("report_overall", TAG_SQL + """ SELECT risk, CAST(SUM(ours) AS BIGINT) AS ours, CAST(SUM(bank) AS BIGINT) AS bank, ROUND(SUM(ours) * 100.0::DOUBLE / (SELECT COUNT(*) FROM tag), 2) AS ours_pct, ROUND(SUM(bank) * 100.0::DOUBLE / (SELECT COUNT(*) FROM tag), 2) AS bank_pct,
    CAST(SUM(ours_true) AS BIGINT) AS ours_true, CAST(SUM(bank_true) AS BIGINT) AS bank_true FROM (SELECT COALESCE(ours, 'NaN') AS risk, 1 AS ours, 0 AS bank, CAST(COALESCE(label = 1, FALSE) AS INT) AS ours_true, 0 AS bank_true FROM tag
    UNION ALL SELECT COALESCE(bank, 'NaN'), 0, 1, 0, CAST(COALESCE(label = 1, FALSE) AS INT) FROM tag) GROUP BY 1""")
def report_overall(spark, sf):
    return rp.overall(tagged(spark, sf), "ours", "bank", "label")


@query("report_by_segment", TAG_SQL + " UNION ALL ".join(f""" SELECT COALESCE(segment, 'not specified') AS segment, CAST(COUNT(CASE WHEN {c} = 'High' THEN 1 END) AS BIGINT) AS high, CAST(COUNT(CASE WHEN {c} = 'Medium' THEN 1 END) AS BIGINT) AS medium,
    CAST(COUNT(CASE WHEN {c} = 'Low' THEN 1 END) AS BIGINT) AS low, CAST(COUNT(CASE WHEN {c} IS NULL THEN 1 END) AS BIGINT) AS "none", '{c}' AS system FROM tag GROUP BY 1""" for c in ("ours", "bank")))
def report_by_segment(spark, sf):
    return rp.by_segment(tagged(spark, sf), "segment", {"ours": "ours", "bank": "bank"})


@query("report_level_vs_label", TAG_SQL + """ SELECT risk, CAST(SUM(bt) AS BIGINT) AS bank_true, CAST(SUM(bf) AS BIGINT) AS bank_false, CAST(SUM(ot) AS BIGINT) AS ours_true, CAST(SUM(of) AS BIGINT) AS ours_false FROM (
    SELECT COALESCE(bank, 'NaN') AS risk, COUNT(CASE WHEN label = 1 THEN 1 END) AS bt, COUNT(CASE WHEN label = 0 THEN 1 END) AS bf, 0 AS ot, 0 AS of FROM tag GROUP BY 1
    UNION ALL SELECT COALESCE(ours, 'NaN'), 0, 0, COUNT(CASE WHEN label = 1 THEN 1 END), COUNT(CASE WHEN label = 0 THEN 1 END) FROM tag GROUP BY 1) GROUP BY 1""")
def report_level_vs_label(spark, sf):
    return rp.level_vs_label(tagged(spark, sf), "ours", "bank", "label")


@query("report_shift", TAG_SQL + " SELECT bank || '-' || ours AS shift, CAST(COUNT(*) AS BIGINT) AS number, CAST(SUM(COALESCE(past_true, 0)) AS BIGINT) AS true_alerts FROM tag WHERE bank <> ours GROUP BY 1")
def report_shift(spark, sf):
    counted = rp.history_counts(tagged(spark, sf), t.alert_history(spark, sf), shape.recode("result", t.ALERT_LABELS))
    return rp.shifts(counted, "bank", "ours", "past_true")


@query("report_history_counts", TAG_SQL + " SELECT party, CAST(past AS BIGINT) AS past, CAST(past_false AS BIGINT) AS past_false, CAST(past_true AS BIGINT) AS past_true FROM tag")
def report_history_counts(spark, sf):
    parties = t.load(spark, sf, "customer").select(F.col("c_custkey").alias("party"))
    return rp.history_counts(parties, t.alert_history(spark, sf), shape.recode("result", t.ALERT_LABELS))


@query("version_row", "SELECT ROUND(MAX(YEAR(o_orderdate) - 1994 + MONTH(o_orderdate) / 100.0) + 0.01, 2)::DOUBLE AS version, CAST(COUNT(*) AS BIGINT) AS alerts, 'system' AS created_by FROM orders")
def version_row(spark, sf):
    orders = t.load(spark, sf, "orders")
    runs = orders.select((F.year("o_orderdate") - 1994 + F.month("o_orderdate") / 100.0).alias("version"))
    return rp.next_version(runs, {"alerts": orders.agg(F.count(F.lit(1))).scalar(), "created_by": F.lit("system")})


@query("code_table_expand", """SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN p_type || '_45kto50k_AMT' WHEN 1 THEN p_type || '_greater-than-50k_AMT' WHEN 2 THEN p_type || '_OPP-PARTY-AGE-UNDER-24_AMT' ELSE p_type || '_AMT' END AS code,
    CASE p_partkey % 4 WHEN 0 THEN 'between 45 and 50' WHEN 1 THEN 'above 50' WHEN 2 THEN 'younger than 24' ELSE 'plain {}' END AS description FROM part""")
def code_table_expand(spark, sf):
    kind = F.col("p_partkey") % 4
    suffix = F.when(kind == 0, "_{}kto{}k_AMT").when(kind == 1, "_greater-than-{}k_AMT").when(kind == 2, "_OPP-PARTY-AGE-UNDER-{}_AMT").otherwise("_AMT")
    text = F.when(kind == 0, "between {} and {}").when(kind == 1, "above {}").when(kind == 2, "younger than {}").otherwise("plain {}")
    codes = t.load(spark, sf, "part").select(F.concat("p_type", suffix).alias("code"), text.alias("description"))
    return rp.expand_codes(codes, {"OPP-PARTY-AGE-UNDER": [24], "kto": [45, 50], "greater-than": [50]})


# ---- generator: rows derived from the given customers ---------------------------------

def parties(spark, sf):
    return t.load(spark, sf, "customer").select(F.col("c_custkey").alias("party"))


def u_sql(name: str, *ids: str, seed: int = 1) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', '{name}', {', '.join(f'CAST({i} AS VARCHAR)' for i in ids)})), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def pick_sql(u: str, values, weights=None) -> str:
    weights = weights or [1.0] * len(values)
    total, upto, out = sum(weights), 0.0, ""
    for v, w in zip(values[:-1], weights[:-1]):
        upto += w / total
        out += f" WHEN {u} < {upto!r}::DOUBLE THEN '{v}'"
    return f"CASE{out} ELSE '{values[-1]}' END"


def whole_sql(u: str, low: int, high: int) -> str:
    return f"CAST(floor({u} * {high - low + 1}) + {low} AS BIGINT)"


def day_sql(u: str, start: str, end: str) -> str:
    return f"{start} + CAST(floor({u} * (date_diff('day', {start}, {end}) + 1)) AS INT)"


P_SQL = "WITH p AS (SELECT c_custkey AS party FROM customer)"
ACCT_SQL = P_SQL + f", acct AS (SELECT party, concat_ws('-', '1', party, n) AS account, {pick_sql(u_sql('currency', 'party', 'n'), ['SGD', 'USD', 'EUR'], [6, 3, 1])} AS currency FROM (SELECT party, UNNEST(range(1, {whole_sql(u_sql('accounts', 'party'), 1, 4)} + 1)) AS n FROM p))"


@query("gen_customers", P_SQL + f""" SELECT party, CASE WHEN {u_sql('type', 'party')} > 0.9::DOUBLE THEN 'C' ELSE 'I' END AS party_type, {day_sql(u_sql('birth', 'party'), "DATE '1926-01-01'", "DATE '2006-01-01'")} AS birth_date,
    {pick_sql(u_sql('employment', 'party'), ['Worker', 'Employee', 'Self-employed', 'Unemployed'])} AS employment, {pick_sql(u_sql('segment', 'party'), ['C', 'V', 'L'])} AS segment, {pick_sql(u_sql('risk', 'party'), ['0', '1'])} AS risk_level FROM p""")
def gen_customers(spark, sf):
    return gen.customers(parties(spark, sf))


@query("gen_accounts", ACCT_SQL + " SELECT party, account, currency FROM acct")
def gen_accounts(spark, sf):
    return gen.accounts(parties(spark, sf))


@query("gen_links", P_SQL + f", l AS (SELECT party, UNNEST(range(1, 1 + CASE WHEN {u_sql('linked', 'party')} < 0.4 THEN {whole_sql(u_sql('links', 'party'), 1, 3)} ELSE 0 END)) AS n FROM p) SELECT DISTINCT party, linked_party FROM (SELECT party, CAST(floor({u_sql('link', 'party', 'n')} * (SELECT COUNT(*) FROM p)) AS BIGINT) AS linked_party FROM l) WHERE party <> linked_party")
def gen_links(spark, sf):
    df = parties(spark, sf)
    return gen.party_links(df, df.count())


CATS = [*gen.INCOMING, *gen.OUTGOING]


@query("gen_transactions", ACCT_SQL + f""", r AS (SELECT party, account, UNNEST(range(1, 13)) AS n FROM acct), g AS (SELECT party, concat_ws('-', account, n) AS txn, account, {whole_sql(u_sql('amount', 'account', 'n'), 10, 10000)} AS amount,
    {day_sql(u_sql('date', 'account', 'n'), "DATE '2023-01-01'", "DATE '2023-12-31'")} AS txn_date, {pick_sql(u_sql('category', 'account', 'n'), CATS)} AS category FROM r)
    SELECT *, CASE WHEN category IN ('CDM-cash-deposit', 'incoming-cheque', 'incoming-fund-transfer') THEN 'C' ELSE 'D' END AS direction FROM g""")
def gen_transactions(spark, sf):
    return gen.transactions(gen.accounts(parties(spark, sf)))


@query("gen_alerts", P_SQL + ", r AS (SELECT party, UNNEST([1, 2]) AS n FROM p)" + " UNION ALL ".join(f""" SELECT concat_ws('-', '1', '{k}-alert', party, n) AS alert, party, '{k}' AS kind, created, created + CAST({whole_sql(u_sql(f'{k}-open', 'party', 'n'), 1, 10)} AS INT) AS closed,
    {pick_sql(u_sql(f'{k}-result', 'party', 'n'), ['Non-STR', 'STR'], [9, 1])} AS result, {pick_sql(u_sql(f'{k}-analyst', 'party', 'n'), ['analyst-1', 'analyst-2', 'analyst-3'])} AS analyst
    FROM (SELECT *, {day_sql(u_sql(f'{k}-created', 'party', 'n'), "DATE '2024-01-01'", "DATE '2024-01-20'")} AS created FROM r)""" for k in gen.ALERT_KINDS))
def gen_alerts(spark, sf):
    return gen.alerts(parties(spark, sf))


@query("gen_marginal", P_SQL + f" SELECT party, {pick_sql(u_sql('channel', 'party', seed=3), ['branch', 'phone', 'web'], [5, 1, 4])} AS channel FROM p")
def gen_marginal(spark, sf):
    return gen.marginal(parties(spark, sf), "channel", 3, ["party"], ["branch", "phone", "web"], [5, 1, 4])


@query("gen_conditional", "WITH p AS (SELECT c_custkey AS party, c_mktsegment AS segment FROM customer)" + f""" SELECT party, segment, CASE WHEN segment = 'BUILDING' THEN {pick_sql(u_sql('job', 'party', seed=3), ['builder', 'broker'], [9, 1])}
    WHEN segment = 'MACHINERY' THEN {pick_sql(u_sql('job', 'party', seed=3), ['engineer', 'trader'], [7, 3])} ELSE {pick_sql(u_sql('job', 'party', seed=3), ['clerk', 'other'], [1, 1])} END AS job FROM p""")
def gen_conditional(spark, sf):
    df = t.load(spark, sf, "customer").select(F.col("c_custkey").alias("party"), F.col("c_mktsegment").alias("segment"))
    seg = F.col("segment")
    return gen.conditional(df, "job", 3, ["party"], [(seg == "BUILDING", ["builder", "broker"], [9, 1]), (seg == "MACHINERY", ["engineer", "trader"], [7, 3])], (["clerk", "other"], [1, 1]))


@query("gen_between_dates", with_tables("acct", f" SELECT account, {day_sql(u_sql('review', 'account', seed=3), 'LEAST(open_date, closed_date)', 'GREATEST(open_date, closed_date)')} AS review_date FROM acct WHERE closed_date IS NOT NULL"))
def gen_between_dates(spark, sf):
    acct = t.accounts(spark, sf).filter("closed_date is not null")
    return acct.select("account", gen.between_dates(gen.draw(3, "review", "account"), F.least("open_date", "closed_date"), F.greatest("open_date", "closed_date")).alias("review_date"))

"""Queries over table shaping, recoding, reconciliation and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators import enrich, lookback as lb, shape
from riskspark.plans.base_sql import with_tables
from riskspark.plans.registry import query
from riskspark.sources import tables as t

ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
])
CUSTOMER_OUT = T.StructType([
    T.StructField("customer_key", T.StringType()), T.StructField("customer_name", T.StringType()),
    T.StructField("segment", T.StringType()), T.StructField("balance", T.DoubleType()),
    T.StructField("closed_date", T.DateType()),
])


@query("src_load", """SELECT o_orderstatus AS status, CAST(COUNT(*) AS BIGINT) AS n,
    CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1""")
def src_load(spark, sf):
    df = t.load(spark, sf, "orders", schema=ORDERS_SCHEMA)
    return df.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(t.money("o_totalprice")).cast("double").alias("total"))


@query("sink_table", with_tables("cust", """SELECT CAST(party AS VARCHAR) AS customer_key, name AS customer_name, segment,
    CAST(balance AS DOUBLE) AS balance, CAST(NULL AS DATE) AS closed_date FROM cust"""))
def sink_table(spark, sf):
    df = t.customers(spark, sf).select(F.col("party").alias("customer_key"), F.col("name").alias("customer_name"),
                                       "balance", "segment", "region")
    return t.conform(df, CUSTOMER_OUT)


@query("prune_cols", "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def prune_cols(spark, sf):
    pruned = shape.prune(t.load(spark, sf, "orders"), ["o_orderkey", "o_custkey"], ["o_orderdate", "o_branch"])
    return pruned.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query("fill_absent_cols", """SELECT c_custkey, c_mktsegment, CAST(NULL AS DOUBLE) AS c_income, CAST(NULL AS DATE) AS c_birth FROM customer""")
def fill_absent_cols(spark, sf):
    return shape.select_or_null(t.load(spark, sf, "customer"), {
        "c_custkey": "bigint", "c_mktsegment": "string", "c_income": "double", "c_birth": "date"})


@query("rename_fill_derive", """SELECT s_suppkey AS product_key, s_name AS product_name, s_nationkey, s_acctbal,
    'CARD' AS product_type, s_suppkey AS account_key FROM supplier""")
def rename_fill_derive(spark, sf):
    return shape.reshape(t.load(spark, sf, "supplier"), {"s_suppkey": "product_key", "s_name": "product_name"},
                         {"product_type": "CARD"}, {"account_key": "s_suppkey"})


@query("etl_stamps", with_tables("alert", """SELECT alert_id, alert_date AS created_time, 'system' AS created_user,
    CAST(CONCAT(YEAR(alert_date), MONTH(alert_date)) AS INT) AS year_month FROM alert"""))
def etl_stamps(spark, sf):
    return shape.stamp(t.alerts(spark, sf).select("alert_id", "alert_date"), at=F.col("alert_date")).drop("alert_date")


@query("drop_by_type", """SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'True' ELSE 'False' END AS large,
    CAST(o_orderdate AS DATE) AS open_date FROM orders""")
def drop_by_type(spark, sf):
    df = t.load(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_totalprice") > 250000).alias("large"), F.col("o_orderdate").cast("date").alias("open_date"),
        F.col("o_orderdate").alias("seen_at"))
    return shape.drop_types(df, keep=["open_date"])


SPARSE_SQL = """SELECT c_custkey AS party, CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS balance,
    CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS income, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS segment
    FROM customer"""


def sparse_customers(spark, sf):
    key = F.col("c_custkey")
    return t.load(spark, sf, "customer").select(
        key.alias("party"), F.when(key % 10 != 0, F.col("c_acctbal")).alias("balance"),
        F.when(key % 2 == 0, F.col("c_acctbal")).alias("income"), F.when(key % 5 != 0, F.col("c_mktsegment")).alias("segment"))


@query("fill_missing_features", f"""SELECT party, COALESCE(balance, 0) AS balance, COALESCE(income, 0) AS income,
    COALESCE(segment, 'MISSING') AS segment FROM ({SPARSE_SQL})""")
def fill_missing_features(spark, sf):
    return shape.fill_missing(sparse_customers(spark, sf))


@query("align_trained_cols", f"""SELECT party, balance, 0.0::DOUBLE AS txn_90, 0.0::DOUBLE AS alert_90 FROM ({SPARSE_SQL})""")
def align_trained_cols(spark, sf):
    return shape.align(sparse_customers(spark, sf).select("party", "balance"), ["balance", "txn_90", "alert_90"])


@query("null_sentinels", """SELECT o_orderkey, CASE WHEN o_orderkey % 6 NOT IN (0, 1, 2, 3) THEN o_orderpriority END AS note,
    CASE WHEN o_orderkey % 6 <> 1 THEN o_totalprice END AS price FROM orders""")
def null_sentinels(spark, sf):
    k = F.col("o_orderkey") % 6
    texts = F.element_at(F.array(*[F.lit(x) for x in shape.NULL_TEXTS]), (k + 1).cast("int"))
    df = t.load(spark, sf, "orders").select(
        "o_orderkey", F.when(k < 4, texts).otherwise(F.col("o_orderpriority")).alias("note"),
        F.when(k == 1, float("nan")).otherwise(F.col("o_totalprice")).alias("price"))
    return shape.clean_nulls(df)


@query("parse_date_any", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS from_date, CASE WHEN o_orderkey % 9 = 0 THEN NULL
    ELSE CAST(o_orderdate AS DATE) END AS from_text, CAST(o_orderdate AS DATE) AS from_epoch FROM orders""")
def parse_date_any(spark, sf):
    day = F.col("o_orderdate").cast("date")
    df = t.load(spark, sf, "orders").select(
        "o_orderkey", day.alias("from_date"),
        F.when(F.col("o_orderkey") % 9 == 0, "unknown").otherwise(F.date_format(day, "dd/MM/yyyy")).alias("from_text"),
        (F.unix_date(day).cast("bigint") * 86400).alias("from_epoch"))
    for c in ("from_date", "from_text", "from_epoch"):
        df = shape.to_ts(df, c, "dd/MM/yyyy")
    return df.select("o_orderkey", *[F.col(c).cast("date").alias(c) for c in ("from_date", "from_text", "from_epoch")])


@query("drop_sparse_cols", f"SELECT party, COALESCE(balance, 0) AS balance, segment FROM ({SPARSE_SQL})")
def drop_sparse_cols(spark, sf):
    return shape.drop_sparse(sparse_customers(spark, sf), 25.0)


# ---- recodes, filters, reconciliation -------------------------------------------------

@query("recode_map", with_tables("alert", "SELECT alert_id, CASE result WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS label FROM alert"))
def recode_map(spark, sf):
    return t.alerts(spark, sf).select("alert_id", shape.recode("result", t.ALERT_LABELS).alias("label"))


@query("recode_default", with_tables("cust", """SELECT party, CASE segment WHEN 'BUILDING' THEN 'C' WHEN 'MACHINERY' THEN 'C'
    WHEN 'HOUSEHOLD' THEN 'I' ELSE 'U' END AS party_type FROM cust"""))
def recode_default(spark, sf):
    kinds = {"C": ["BUILDING", "MACHINERY"], "I": ["HOUSEHOLD"]}
    return t.customers(spark, sf).select("party", shape.recode("segment", kinds, "U").alias("party_type"))


@query("filter_labelled", with_tables("alert", "SELECT alert_id, party, result FROM alert WHERE result IN ('F', 'O')"))
def filter_labelled(spark, sf):
    return shape.labelled_only(t.alerts(spark, sf), ["result"], t.ALERT_LABELS).select("alert_id", "party", "result")


@query("min_rows_guard", with_tables("alert", "SELECT result, CAST(COUNT(*) AS BIGINT) AS n FROM alert WHERE result IN ('F', 'O') GROUP BY 1"))
def min_rows_guard(spark, sf):
    labelled = shape.labelled_only(t.alerts(spark, sf), ["result"], t.ALERT_LABELS)
    return shape.require_rows(labelled, 50).groupBy("result").agg(F.count(F.lit(1)).alias("n"))


@query("error_reconcile", with_tables("alert txn acct", """, p AS (SELECT c_custkey FROM customer WHERE c_acctbal >= -800),
    a AS (SELECT account FROM acct WHERE closed_date IS NOT NULL),
    x AS (SELECT alert_id, party, CASE WHEN party NOT IN (SELECT c_custkey FROM p) THEN 'CDD_ERR_C100'
          WHEN alert_id NOT IN (SELECT account FROM a) THEN 'CDD_ERR_A100'
          WHEN NOT EXISTS (SELECT 1 FROM txn WHERE txn.party = alert.party AND txn_date <= alert_date AND txn_date > alert_date - 360) THEN 'CDD_ERR_T100'
          ELSE 'OK' END AS error_code FROM alert)
    SELECT alert_id, party, error_code FROM x"""))
def error_reconcile(spark, sf):
    alerts = t.alerts(spark, sf)
    parties = t.load(spark, sf, "customer").filter("c_acctbal >= -800").select(F.col("c_custkey").alias("party"))
    ok, no_party = shape.reconcile(alerts, parties, "party", "customer")
    owned = t.accounts(spark, sf).filter("closed_date is not null").select(F.col("account").alias("alert_id"))
    ok, no_account = shape.reconcile(ok, owned, "alert_id", "account")
    daily = lb.daily_totals(t.transactions(spark, sf), [lb.Spec("n", "VOL", 360)])
    seen = lb.lookback_join(daily, t.reference_points(alerts), "txn_date").select("party", "ref_date").distinct()
    with_key = ok.withColumnRenamed("alert_date", "ref_date")
    done = with_key.join(seen, ["party", "ref_date"], "left_semi").withColumn("error_code", F.lit("OK"))
    no_txn = with_key.join(seen, ["party", "ref_date"], "left_anti").withColumn("error_code", F.lit(shape.ERROR_CODES["transaction"]))
    cols = ["alert_id", "party", "error_code"]
    return no_party.select(cols).union(no_account.select(cols)).union(no_txn.select(cols)).union(done.select(cols))


@query("single_hit_filter", """SELECT l_orderkey AS alert_id, l_suppkey AS hit, l_returnflag AS status FROM (
    SELECT *, COUNT(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag IN ('R', 'A'))
    WHERE n = 1 AND l_linenumber IN (1, 2, 3)""")
def single_hit_filter(spark, sf):
    hits = t.load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("alert_id"), F.col("l_suppkey").alias("hit"), F.col("l_returnflag").alias("status"),
        F.col("l_linestatus").alias("entity"), F.col("l_linenumber").alias("reason"))
    return shape.single_hit(hits, "alert_id", ("entity", "F"), ("status", ["R", "A"]), ("reason", [1, 2, 3])).select(
        "alert_id", "hit", "status")


@query("nr_filter", "SELECT c_custkey AS party, c_name AS name FROM customer WHERE c_acctbal >= 0")
def nr_filter(spark, sf):
    df = t.load(spark, sf, "customer").select(
        F.col("c_custkey").alias("party"), F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("on_boarding_flag"))
    return df.filter("on_boarding_flag = 0").drop("on_boarding_flag")


@query("zero_activity_split", with_tables("txn cust", """SELECT c.segment, CAST(COUNT(CASE WHEN n > 0 THEN 1 END) AS BIGINT) AS active,
    CAST(COUNT(CASE WHEN COALESCE(n, 0) = 0 THEN 1 END) AS BIGINT) AS inactive FROM cust c LEFT JOIN
    (SELECT party, COUNT(*) AS n FROM txn WHERE txn_date > (SELECT MAX(txn_date) FROM txn) - 360 GROUP BY 1) USING (party) GROUP BY 1"""))
def zero_activity_split(spark, sf):
    txn = t.transactions(spark, sf)
    newest = t.last_transaction_date(spark, sf)
    refs = enrich.reference_dates(t.customers(spark, sf).select("party", "segment"), txn, txn, "overall_max", newest=newest)
    recent = txn.filter(F.col("txn_date") > F.date_sub(newest, 360))
    sums = recent.groupBy("party").agg(
        F.sum(F.when(F.col("direction") == "incoming-all", F.col("amount"))).alias("i"),
        F.sum(F.when(F.col("direction") == "outgoing-all", F.col("amount"))).alias("o"))
    active, idle = shape.split_activity(refs.join(sums, "party", "left"), "i", "o")
    both = active.withColumn("on", F.lit(1)).unionByName(idle.withColumn("on", F.lit(0)))
    return both.groupBy("segment").agg(F.sum("on").cast("bigint").alias("active"),
                                       F.sum(1 - F.col("on")).cast("bigint").alias("inactive"))


@query("merge_anomaly_history", with_tables("alert hist", "SELECT alert_id, party, alert_date FROM (SELECT * FROM alert UNION ALL SELECT * FROM hist)"))
def merge_anomaly_history(spark, sf):
    return shape.union_if_same(t.alerts(spark, sf), t.alert_history(spark, sf)).select("alert_id", "party", "alert_date")


# ---- reference dates and enrichment ---------------------------------------------------

REF_SQL = with_tables("cust txn alert", """SELECT c.party, {e} AS ref_date FROM cust c
    LEFT JOIN (SELECT party, MAX(txn_date) AS d FROM txn GROUP BY 1) m USING (party)
    LEFT JOIN (SELECT party, MAX(alert_date) AS d FROM alert GROUP BY 1) a USING (party)""")


@query("ref_date_individual", REF_SQL.format(e="COALESCE(GREATEST(m.d, a.d), m.d, a.d, DATE '2024-01-31')"))
def ref_date_individual(spark, sf):
    return enrich.reference_dates(t.customers(spark, sf).select("party"), t.transactions(spark, sf), t.alerts(spark, sf),
                                  today=F.lit("2024-01-31").cast("date"))


@query("ref_date_current", REF_SQL.format(e="DATE '2024-01-31'"))
def ref_date_current(spark, sf):
    return enrich.reference_dates(t.customers(spark, sf).select("party"), None, None, "current",
                                  today=F.lit("2024-01-31").cast("date"))


@query("ref_date_overall_max", REF_SQL.format(e="(SELECT MAX(txn_date) FROM txn)"))
def ref_date_overall_max(spark, sf):
    return enrich.reference_dates(t.customers(spark, sf).select("party"), t.transactions(spark, sf), None, "overall_max",
                                  newest=t.last_transaction_date(spark, sf))


@query("history_window_filter", with_tables("hist cust txn", """SELECT h.alert_id, h.party, h.alert_date FROM hist h
    JOIN (SELECT party, MAX(txn_date) AS ref_date FROM txn GROUP BY 1) r USING (party)
    WHERE h.alert_date <= ref_date AND h.alert_date > ref_date - 360"""))
def history_window_filter(spark, sf):
    refs = t.transactions(spark, sf).groupBy("party").agg(F.max("txn_date").alias("ref_date"))
    return enrich.history_window(t.alert_history(spark, sf).join(refs, "party"), "alert_date").select("alert_id", "party", "alert_date")


@query("opp_party_lookup", with_tables("txn", """SELECT o.o_custkey AS opp_owner, CAST(COUNT(*) AS BIGINT) AS n,
    CAST(SUM(amount) AS DOUBLE) AS amount FROM txn LEFT JOIN orders o ON o.o_orderkey = txn.account + 1 GROUP BY 1"""))
def opp_party_lookup(spark, sf):
    """Owner of the opposite account (the account keyed one above)."""
    owners = t.load(spark, sf, "orders").select(F.col("o_orderkey").alias("opp_account"), F.col("o_custkey").alias("opp_owner"))
    txn = t.transactions(spark, sf).withColumn("opp_account", F.col("account") + 1)
    per_account = txn.groupBy("opp_account").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    return enrich.add_attrs(per_account, owners, "opp_account", ["opp_owner"]).groupBy("opp_owner").agg(
        F.sum("n").alias("n"), F.sum("amount").cast("double").alias("amount"))


@query("flag_high_risk_party", with_tables("txn opp", """SELECT account, CAST(COUNT(*) AS BIGINT) AS n,
    CAST(SUM(CASE WHEN opp_balance < 0 THEN 1 ELSE 0 END) AS BIGINT) AS risky FROM txn LEFT JOIN opp USING (opp_party) GROUP BY 1"""))
def flag_high_risk_party(spark, sf):
    flagged = enrich.flag_member(t.transactions(spark, sf), t.high_risk_parties(spark, sf), "opp_party", "to_high_risk_party")
    return flagged.groupBy("account").agg(F.count(F.lit(1)).alias("n"), F.count("to_high_risk_party").alias("risky"))


@query("flag_high_risk_country", with_tables("txn opp", """SELECT account, CAST(COUNT(*) AS BIGINT) AS n,
    CAST(SUM(CASE WHEN opp_region = 0 THEN 1 ELSE 0 END) AS BIGINT) AS risky FROM txn LEFT JOIN opp USING (opp_party) GROUP BY 1"""))
def flag_high_risk_country(spark, sf):
    txn = enrich.add_attrs(t.transactions(spark, sf), t.counterparties(spark, sf), "opp_party", ["opp_nation"])
    flagged = enrich.flag_member(txn, t.high_risk_countries(spark, sf), "opp_nation", "to_high_risk_country")
    return flagged.groupBy("account").agg(F.count(F.lit(1)).alias("n"), F.count("to_high_risk_country").alias("risky"))


@query("add_opp_party_attrs", with_tables("txn opp", """SELECT opp_country, category, CAST(COUNT(*) AS BIGINT) AS n,
    CAST(SUM(amount) AS DOUBLE) AS amount, CAST(MAX(opp_balance) AS DOUBLE) AS top_balance
    FROM txn LEFT JOIN opp USING (opp_party) GROUP BY 1, 2"""))
def add_opp_party_attrs(spark, sf):
    txn = enrich.add_attrs(t.transactions(spark, sf), t.counterparties(spark, sf), "opp_party", ["opp_country", "opp_balance"])
    return txn.groupBy("opp_country", "category").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("amount"),
        F.max("opp_balance").cast("double").alias("top_balance"))


ACCT_TXN_SQL = with_tables("txn acct", """, x AS (SELECT t.*, COALESCE(a.account_type, 'NONE') AS own_type, a.account_unit AS own_unit,
    b.account_type AS opp_type, b.account_unit AS opp_unit, b.party AS opp_owner FROM txn t
    LEFT JOIN acct a ON t.account = a.account LEFT JOIN acct b ON t.account + 1 = b.account)""")


def account_transactions(spark, sf):
    """Transactions with own and opposite account attributes; an unknown key falls back to the number."""
    acct = t.load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("account"), F.col("o_custkey").alias("owner"),
        F.col("o_orderpriority").alias("type"), F.col("o_orderstatus").alias("unit"))
    txn = t.transactions(spark, sf).withColumn("opp_account", F.coalesce(F.lit(None).cast("bigint"), F.col("account") + 1))
    own = enrich.add_attrs(txn, acct, "account", ["type", "unit"], "own_")
    return enrich.add_attrs(own, acct.withColumnRenamed("account", "opp_account"), "opp_account", ["type", "unit", "owner"], "opp_")


@query("add_account_attrs", ACCT_TXN_SQL + """ SELECT own_type, opp_type, own_unit, CAST(COUNT(*) AS BIGINT) AS n,
    CAST(SUM(amount) AS DOUBLE) AS amount FROM x GROUP BY 1, 2, 3""")
def add_account_attrs(spark, sf):
    return account_transactions(spark, sf).groupBy(F.coalesce("own_type", F.lit("NONE")).alias("own_type"), "opp_type", "own_unit").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("amount"))


@query("diff_flags", ACCT_TXN_SQL + """ SELECT party, CAST(COUNT(CASE WHEN own_type <> opp_type THEN 1 END) AS BIGINT) AS diff_type,
    CAST(COUNT(CASE WHEN own_unit <> opp_unit THEN 1 END) AS BIGINT) AS diff_unit FROM x GROUP BY 1""")
def diff_flags(spark, sf):
    flags = enrich.diff_flags({"diff_type": ("own_type", "opp_type"), "diff_unit": ("own_unit", "opp_unit")})
    return account_transactions(spark, sf).select("party", *flags).groupBy("party").agg(
        F.count("diff_type").alias("diff_type"), F.count("diff_unit").alias("diff_unit"))


@query("same_party_transfer", ACCT_TXN_SQL + """ SELECT party, CAST(COUNT(*) AS BIGINT) AS n,
    CAST(COUNT(CASE WHEN party = opp_owner THEN 1 END) AS BIGINT) AS same_party FROM x GROUP BY 1""")
def same_party_transfer(spark, sf):
    return account_transactions(spark, sf).groupBy("party").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("party") == F.col("opp_owner"), True)).alias("same_party"))


@query("party_transfer_any", ACCT_TXN_SQL + """ SELECT party, CAST(COUNT(CASE WHEN COALESCE(party = opp_owner, FALSE)
    OR COALESCE(account = opp_owner, FALSE) OR party = opp_party OR account = opp_party THEN 1 END) AS BIGINT) AS own_transfers FROM x GROUP BY 1""")
def party_transfer_any(spark, sf):
    own = enrich.any_equal([("party", "opp_owner"), ("account", "opp_owner"), ("party", "opp_party"), ("account", "opp_party")])
    return account_transactions(spark, sf).groupBy("party").agg(F.count(F.when(own, True)).alias("own_transfers"))


@query("foreign_flag", with_tables("txn opp cust", """SELECT party, CAST(COUNT(CASE WHEN nation <> opp_nation THEN 1 END) AS BIGINT) AS abroad,
    CAST(COUNT(*) AS BIGINT) AS n FROM txn JOIN opp USING (opp_party) JOIN cust USING (party) GROUP BY 1"""))
def foreign_flag(spark, sf):
    txn = enrich.add_attrs(t.transactions(spark, sf), t.counterparties(spark, sf), "opp_party", ["opp_nation"])
    txn = enrich.add_attrs(txn, t.customers(spark, sf), "party", ["nation"])
    flags = enrich.diff_flags({"abroad": ("nation", "opp_nation")})
    return txn.select("party", *flags).groupBy("party").agg(F.count("abroad").alias("abroad"), F.count(F.lit(1)).alias("n"))


BIRTH = "DATE '1940-01-01' + CAST({k} % 25000 AS INT)"


def birth_date(key: str):
    return F.date_add(F.lit("1940-01-01").cast("date"), (F.col(key) % 25000).cast("int"))


@query("opp_party_age", with_tables("alert", f"""SELECT alert_id, CAST(trunc(date_diff('day', {BIRTH.format(k='(party * 17)')}, alert_date) / 365.25) AS INT) AS age FROM alert"""))
def opp_party_age(spark, sf):
    df = t.alerts(spark, sf).withColumn("k", F.col("party") * 17)
    return df.select("alert_id", enrich.age_years(birth_date("k"), "alert_date").alias("age"))


@query("valid_interval_join", with_tables("alert hrp", """SELECT DISTINCT a.party, a.alert_date, FIRST_VALUE(h.start_date) OVER w AS start_date,
    FIRST_VALUE(h.interval_id) OVER w AS interval_id FROM alert a LEFT JOIN hrp h ON h.party = a.party AND a.alert_date >= h.start_date
    AND (h.expiry_date IS NULL OR a.alert_date <= h.expiry_date)
    WINDOW w AS (PARTITION BY a.party, a.alert_date ORDER BY h.start_date DESC NULLS LAST, COALESCE(h.expiry_date, DATE '9999-12-31') DESC, h.interval_id DESC)"""))
def valid_interval_join(spark, sf):
    return enrich.valid_intervals(t.alerts(spark, sf), t.high_risk_intervals(spark, sf), "party", "alert_date")


@query("antijoin_complete", with_tables("alert hrp", """SELECT a.alert_id, CASE WHEN EXISTS (SELECT 1 FROM hrp h WHERE h.party = a.party
    AND a.alert_date >= h.start_date AND (h.expiry_date IS NULL OR a.alert_date <= h.expiry_date)) THEN 1 END AS high_risk FROM alert a"""))
def antijoin_complete(spark, sf):
    """Matched rows plus unmatched rows with a null flag, as one left join."""
    alerts = t.alerts(spark, sf)
    points = enrich.valid_intervals(alerts, t.high_risk_intervals(spark, sf), "party", "alert_date")
    flags = points.select("party", "alert_date", F.when(F.col("interval_id").isNotNull(), 1).alias("high_risk"))
    return alerts.join(flags, ["party", "alert_date"], "left").select("alert_id", "high_risk")


@query("feature_assemble", with_tables("txn acct cust", """SELECT c.party, c.segment, CAST(COALESCE(a.accounts, 0) AS BIGINT) AS accounts,
    COALESCE(x.amount, 0) AS amount FROM cust c LEFT JOIN (SELECT party, COUNT(*) AS accounts FROM acct GROUP BY 1) a USING (party)
    LEFT JOIN (SELECT party, CAST(SUM(amount) AS DOUBLE) AS amount FROM txn GROUP BY 1) x USING (party)"""))
def feature_assemble(spark, sf):
    static = t.load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("party")).agg(F.count(F.lit(1)).alias("accounts"))
    dynamic = t.transactions(spark, sf).groupBy("party").agg(F.sum("amount").cast("double").alias("amount"))
    base = t.customers(spark, sf).select("party", "segment")
    return base.join(static, "party", "left").join(dynamic, "party", "left").na.fill(0)


@query("outer_merge_many", with_tables("alert hist txn", """SELECT COALESCE(a.party, h.party, x.party) AS party, a.n AS alerts, h.n AS past, x.big
    FROM (SELECT party, COUNT(*) AS n FROM alert GROUP BY 1) a
    FULL JOIN (SELECT party, COUNT(*) AS n FROM hist GROUP BY 1) h ON a.party = h.party
    FULL JOIN (SELECT party, COUNT(*) AS big FROM txn WHERE amount > 90000 GROUP BY 1) x ON x.party = COALESCE(a.party, h.party)"""))
def outer_merge_many(spark, sf):
    a = t.alerts(spark, sf).groupBy("party").agg(F.count(F.lit(1)).alias("alerts"))
    h = t.alert_history(spark, sf).groupBy("party").agg(F.count(F.lit(1)).alias("past"))
    x = t.transactions(spark, sf).filter("amount > 90000").groupBy("party").agg(F.count(F.lit(1)).alias("big"))
    return enrich.outer_all([a, h, x], "party")

"""Queries over static features."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators import enrich, shape, static
from riskspark.plans.base_sql import with_tables
from riskspark.plans.registry import query
from riskspark.plans.shape_plans import BIRTH, birth_date
from riskspark.sources import tables as t

RISK_SEGMENTS = ["BUILDING", "AUTOMOBILE"]
RISK_REGIONS = ["AFRICA"]


def refs_of(spark, sf):
    return t.reference_points(t.alerts(spark, sf))


@query("static_account_count", "SELECT o_custkey AS party, CAST(COUNT(*) AS BIGINT) AS number_of_accounts FROM orders GROUP BY 1")
def static_account_count(spark, sf):
    return static.account_counts(t.load(spark, sf, "orders").select(F.col("o_custkey").alias("party"), F.col("o_orderkey").alias("account")))


OPENED_SQL = """SELECT r.party, r.ref_date,
    CAST(COUNT(CASE WHEN date_diff('day', open_date, ref_date) BETWEEN 0 AND 365 THEN 1 END) AS BIGINT) AS opened_360,
    CAST(COUNT(CASE WHEN date_diff('day', open_date, ref_date) BETWEEN 0 AND 365 AND closed_date < ref_date AND open_date < closed_date THEN 1 END) AS BIGINT) AS opened_closed_360
    FROM refs r LEFT JOIN acct a USING (party) GROUP BY 1, 2"""


@query("static_accounts_opened_360", with_tables("refs acct", OPENED_SQL))
def static_accounts_opened_360(spark, sf):
    return static.accounts_opened(t.accounts(spark, sf), refs_of(spark, sf))


@query("static_party_age", with_tables("refs", f"SELECT party, ref_date, CAST(trunc(date_diff('day', {BIRTH.format(k='party')}, ref_date) / 365.25) AS INT) AS age FROM refs"))
def static_party_age(spark, sf):
    return refs_of(spark, sf).select("party", "ref_date", enrich.age_years(birth_date("party"), "ref_date").alias("age"))


@query("static_risk_lists", with_tables("cust", """SELECT party, CASE WHEN segment IN ('BUILDING', 'AUTOMOBILE') THEN 1 ELSE 0 END AS high_risk_occupation,
    CASE WHEN region IN ('AFRICA') THEN 1 ELSE 0 END AS high_risk_business FROM cust"""))
def static_risk_lists(spark, sf):
    def member(col, values):
        return F.when(F.col(col).isin(*values), 1).otherwise(0)
    return t.customers(spark, sf).select("party", member("segment", RISK_SEGMENTS).alias("high_risk_occupation"),
                                         member("region", RISK_REGIONS).alias("high_risk_business"))


@query("static_doc_expired_age", """SELECT c_custkey AS party, CAST(trunc(date_diff('day', DATE '2012-01-01' + CAST(c_custkey % 6000 AS INT),
    DATE '2024-01-31') / 365.25) AS INT) AS expired_years FROM customer""")
def static_doc_expired_age(spark, sf):
    expiry = F.date_add(F.lit("2012-01-01").cast("date"), (F.col("c_custkey") % 6000).cast("int"))
    return t.load(spark, sf, "customer").select(
        F.col("c_custkey").alias("party"), enrich.age_years(expiry, F.lit("2024-01-31").cast("date")).alias("expired_years"))


@query("static_account_age", with_tables("alert acct", """SELECT alert_id, CAST(trunc(date_diff('day', open_date,
    COALESCE(CASE WHEN account_unit <> 'P' THEN closed_date END, alert_date)) / 365.25) AS INT) AS account_age
    FROM alert LEFT JOIN acct ON account = alert_id - 1"""))
def static_account_age(spark, sf):
    acct = t.accounts(spark, sf).select("account", "open_date", F.when(F.col("account_unit") != "P", F.col("closed_date")).alias("closed_date"))
    alerts = t.alerts(spark, sf).select("alert_id", "alert_date", (F.col("alert_id") - 1).alias("account"))
    return static.account_age(alerts.join(acct, "account", "left"), "alert_date").select("alert_id", "account_age")


@query("static_alert_label", with_tables("alert", "SELECT DISTINCT alert_id, party, alert_date, CASE result WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS label FROM alert"))
def static_alert_label(spark, sf):
    return t.alerts(spark, sf).select("alert_id", "party", "alert_date", shape.recode("result", t.ALERT_LABELS).alias("label")).distinct()


PAIRS = ", pair AS (SELECT party, linked_party, MAX(COALESCE(end_date, DATE '9999-12-31')) AS until FROM link GROUP BY 1, 2)"
ACTIVE = ", active AS (SELECT r.party, r.ref_date, p.linked_party FROM refs r LEFT JOIN pair p ON p.party = r.party AND p.until > r.ref_date)"


@query("static_active_links", with_tables("refs link", PAIRS + ACTIVE + """
    SELECT party, ref_date, CAST(COUNT(linked_party) AS BIGINT) AS active_links FROM active GROUP BY 1, 2"""))
def static_active_links(spark, sf):
    return static.active_links(t.links(spark, sf), refs_of(spark, sf))


@query("static_linked_alerts", with_tables("refs link hist", PAIRS + ACTIVE + """, x AS (SELECT a.*, h.alert_id, h.result FROM active a
    LEFT JOIN hist h ON h.party = a.linked_party AND h.alert_date <= a.ref_date AND h.alert_date > a.ref_date - 360)
    SELECT party, ref_date, CAST(COUNT(alert_id) AS BIGINT) AS linked_alerts,
    CAST(COUNT(CASE WHEN result = 'F' THEN 1 END) AS BIGINT) AS linked_true_alerts,
    CAST(COUNT(DISTINCT CASE WHEN result = 'F' THEN linked_party END) AS BIGINT) AS linked_with_true_alert FROM x GROUP BY 1, 2"""))
def static_linked_alerts(spark, sf):
    return static.linked_alerts(t.links(spark, sf), t.alert_history(spark, sf), refs_of(spark, sf))


@query("static_linked_risk", with_tables("refs link hrp cust", PAIRS + ACTIVE + """
    SELECT a.party, a.ref_date, CAST(COUNT(DISTINCT CASE WHEN EXISTS (SELECT 1 FROM hrp h WHERE h.party = a.linked_party AND a.ref_date >= h.start_date
        AND (h.expiry_date IS NULL OR a.ref_date <= h.expiry_date)) THEN a.linked_party END) AS BIGINT) AS linked_high_risk_party,
    CAST(COUNT(CASE WHEN c.region_key = 0 THEN 1 END) AS BIGINT) AS linked_high_risk_country
    FROM active a LEFT JOIN cust c ON c.party = a.linked_party GROUP BY 1, 2"""))
def static_linked_risk(spark, sf):
    risky = t.customers(spark, sf).filter(F.col("region_key") == t.HIGH_RISK_REGION)
    return static.linked_risk(t.links(spark, sf), t.high_risk_intervals(spark, sf), risky, refs_of(spark, sf))


@query("static_assemble", with_tables("refs acct link cust", PAIRS + ACTIVE + f""", o AS ({OPENED_SQL}),
    l AS (SELECT party, ref_date, CAST(COUNT(linked_party) AS BIGINT) AS active_links FROM active GROUP BY 1, 2),
    n AS (SELECT party, CAST(COUNT(*) AS BIGINT) AS number_of_accounts FROM acct GROUP BY 1)
    SELECT r.party, r.ref_date, c.segment, n.number_of_accounts, o.opened_360, o.opened_closed_360, l.active_links
    FROM refs r LEFT JOIN cust c USING (party) LEFT JOIN n USING (party) LEFT JOIN o USING (party, ref_date) LEFT JOIN l USING (party, ref_date)"""))
def static_assemble(spark, sf):
    refs, acct = refs_of(spark, sf), t.accounts(spark, sf)
    keys = ["party", "ref_date"]
    return (refs.join(t.customers(spark, sf).select("party", "segment"), "party", "left")
            .join(static.account_counts(acct), "party", "left")
            .join(static.accounts_opened(acct, refs), keys, "left")
            .join(static.active_links(t.links(spark, sf), refs), keys, "left"))

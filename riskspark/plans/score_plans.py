"""Queries over deciles, thresholds, risk levels and combined scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.functions import levels as lv, scores as sc
from riskspark.operators import branches as br, deciles as dc, enrich, shape
from riskspark.plans.base_sql import with_tables
from riskspark.plans.registry import query
from riskspark.sources import tables as t
from riskspark.sources.session import ensure_checkpoint_dir


def rnd(df, **digits):
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


def ranked_sql(bins: int, rank: str, order: str, label: bool = True, source: str = "scored", tail: str = "") -> str:
    """Chart over row-level bins; ``rank`` is the bin expression over rn and total."""
    true_cols = ("""CAST(SUM(label) AS BIGINT) AS true_alerts, CAST(SUM(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS false_alerts,"""
                 if label else "")
    cums = ("""CAST(SUM(true_alerts) OVER w AS BIGINT) AS cum_true, SUM(true_alerts) OVER w / SUM(true_alerts) OVER () AS cum_true_share,"""
            if label else "")
    return f""", b AS (SELECT *, {rank} AS decile FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS rn, COUNT(*) OVER () AS total FROM {source})),
    c AS (SELECT CAST(decile AS INT) AS decile, CAST(COUNT(*) AS BIGINT) AS total_rows, {true_cols} MIN(score) AS min_score, MAX(score) AS max_score FROM b GROUP BY 1),
    chart AS (SELECT *, {cums} CAST(SUM(total_rows) OVER w AS BIGINT) AS cum_total, SUM(total_rows) OVER w / SUM(total_rows) OVER () AS cum_total_share
        FROM c WINDOW w AS (ORDER BY decile)){tail}"""


def chart_desc_sql(bins: int, label: bool = True, source: str = "scored") -> str:
    return ranked_sql(bins, f"(rn * {bins} + total - 1) // total", "score DESC, label DESC" if label else "score DESC", label, source)


def chart_ntile_sql(bins: int, source: str = "scored", label: bool = True) -> str:
    order = "score, label DESC" if label else "score"
    return ranked_sql(bins, f"ntile({bins}) OVER (ORDER BY {order}, rn)", order, label, source)


CHART_COLS = "decile, total_rows, true_alerts, false_alerts, min_score, max_score, cum_true, ROUND(cum_true_share, 6) AS cum_true_share, cum_total, ROUND(cum_total_share, 6) AS cum_total_share"


def chart_out(chart):
    return rnd(chart.drop("feature"), **{c: 6 for c in chart.columns if c.endswith("_share")})


@query("decile_desc", with_tables("scored", chart_desc_sql(10)) + f" SELECT {CHART_COLS} FROM chart")
def decile_desc(spark, sf):
    return chart_out(dc.decile_chart(t.scored_alerts(spark, sf), 10))


@query("decile_unlabelled", with_tables("scored", chart_desc_sql(20, False)) + " SELECT decile, total_rows, min_score, max_score, cum_total, ROUND(cum_total_share, 6) AS cum_total_share FROM chart")
def decile_unlabelled(spark, sf):
    return chart_out(dc.decile_chart(t.scored_alerts(spark, sf), 20, label=None))


@query("decile_ntile", with_tables("docs", chart_ntile_sql(100, "docs")) + f" SELECT {CHART_COLS} FROM chart")
def decile_ntile(spark, sf):
    return chart_out(dc.decile_chart(t.scored_documents(spark, sf), 100, rule="ntile", descending=False))


QUANTILE_SQL = """, r AS (SELECT *, row_number() OVER (ORDER BY score) AS rn, COUNT(*) OVER () AS total FROM scored),
    q AS (SELECT DISTINCT r.score AS cut FROM r, (SELECT UNNEST([0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS p) WHERE rn = CEIL(total * CAST(p AS DOUBLE))),
    b AS (SELECT scored.*, 1 + (SELECT COUNT(*) FROM q WHERE scored.score >= cut) AS ordered_bin FROM scored),
    s AS (SELECT CAST(ordered_bin AS INT) AS ordered_bin, CAST(SUM(label) AS BIGINT) AS true_alerts, CAST(SUM(1 - label) AS BIGINT) AS false_alerts,
        AVG(score) AS avg_score, MIN(score) AS min_score, MAX(score) AS max_score FROM b GROUP BY 1),
    k AS (SELECT *, ROUND(true_alerts / SUM(true_alerts) OVER (), 6) AS recall, ROUND(false_alerts / SUM(false_alerts) OVER (), 3) AS reduction FROM s)"""


@query("decile_quantile", with_tables("scored", QUANTILE_SQL) + """ SELECT ordered_bin, true_alerts, false_alerts, ROUND(avg_score, 6) AS avg_score, min_score, max_score,
    recall, reduction, ROUND(SUM(recall) OVER (ORDER BY ordered_bin), 6) AS cum_recall, ROUND(SUM(reduction) OVER (ORDER BY ordered_bin), 6) AS cum_reduction FROM k""")
def decile_quantile(spark, sf):
    return rnd(dc.quantile_chart(t.scored_alerts(spark, sf)), avg_score=6, cum_recall=6, cum_reduction=6)


BOUNDARY_SQL = """, lagged AS (SELECT *, COALESCE(LAG(cum_true_share) OVER (ORDER BY decile), 0) AS lag_share FROM chart),
    bnd AS (SELECT MAX(CASE WHEN cum_true_share >= 0.8 THEN min_score END) AS high, MIN(CASE WHEN cum_true_share >= 0.8 THEN decile END) AS high_decile,
    MAX(CASE WHEN lag_share >= 1 - 0.05::DOUBLE THEN max_score END) AS low, MIN(CASE WHEN lag_share >= 1 - 0.05::DOUBLE THEN decile END) AS low_decile FROM lagged)"""
WORST_SQL = """, worst AS (SELECT MAX(CASE WHEN decile = 2 THEN min_score END) AS high, MAX(CASE WHEN decile = 13 THEN max_score END) AS low,
    MAX(CASE WHEN decile = 2 THEN cum_true_share END) AS recall, 1 - MAX(CASE WHEN decile = 12 THEN cum_true_share END) AS misclass FROM chart)"""


@query("threshold_boundary", with_tables("scored", chart_desc_sql(20) + BOUNDARY_SQL) + " SELECT high, high_decile, low, low_decile FROM bnd")
def threshold_boundary(spark, sf):
    return dc.boundaries(dc.decile_chart(t.scored_alerts(spark, sf), 20)).drop("feature")


@query("threshold_worst_case", with_tables("scored", chart_desc_sql(20) + WORST_SQL) + " SELECT high, low, ROUND(recall, 6) AS recall, ROUND(misclass, 6) AS misclass FROM worst")
def threshold_worst_case(spark, sf):
    return rnd(dc.worst_case(dc.decile_chart(t.scored_alerts(spark, sf), 20), 20).drop("feature"), recall=6, misclass=6)


@query("threshold_tuned", with_tables("scored", chart_desc_sql(20) + BOUNDARY_SQL + WORST_SQL) + """ SELECT CASE WHEN b.high >= b.low THEN b.high ELSE w.high END AS high,
    CASE WHEN b.high >= b.low THEN b.low ELSE w.low END AS low, COALESCE(b.high < b.low, TRUE) AS conservative FROM bnd b, worst w""")
def threshold_tuned(spark, sf):
    return dc.tuned(dc.decile_chart(t.scored_alerts(spark, sf), 20), 20).drop("feature")


RECALL_SQL = """, thr AS (SELECT COALESCE(MIN(CASE WHEN cum_true_share > 1 - 0.7::DOUBLE THEN min_score END), 1.0) AS high,
    COALESCE(MIN(CASE WHEN cum_true_share > 0.05::DOUBLE THEN min_score END), 0.0) AS low FROM chart)"""


@query("threshold_recall", with_tables("scored", chart_ntile_sql(100) + RECALL_SQL) + " SELECT high, low FROM thr")
def threshold_recall(spark, sf):
    return dc.recall_thresholds(dc.decile_chart(t.scored_alerts(spark, sf), 100, rule="ntile", descending=False), 0.7, 0.05).drop("feature")


ADJUST_SQL = """, shares AS (SELECT AVG(CASE WHEN score >= high THEN 1.0::DOUBLE ELSE 0 END) AS h, AVG(CASE WHEN score >= low THEN 0.0::DOUBLE ELSE 1 END) AS l FROM {source}, thr),
    recut AS (SELECT COALESCE(MIN(CASE WHEN cum_total_share > 1 - 0.2::DOUBLE THEN min_score END), 1.0) AS rh, COALESCE(MIN(CASE WHEN cum_total_share > 0.3::DOUBLE THEN min_score END), 0.0) AS rl FROM chart),
    adj AS (SELECT CASE WHEN h > 0.2::DOUBLE THEN rh ELSE high END AS high, CASE WHEN l < 0.3::DOUBLE THEN rl ELSE low END AS low FROM thr, shares, recut)"""


@query("threshold_population_adjust", with_tables("scored", chart_ntile_sql(100) + RECALL_SQL + ADJUST_SQL.format(source="scored")) + " SELECT high, low FROM adj")
def threshold_population_adjust(spark, sf):
    df = t.scored_alerts(spark, sf)
    chart = dc.decile_chart(df, 100, rule="ntile", descending=False)
    return dc.adjust_to_population(chart, df, dc.recall_thresholds(chart, 0.7, 0.05), 0.2, 0.3).drop("feature")


@query("threshold_apply_given", with_tables("scored", """SELECT ROUND(SUM(CASE WHEN score >= 0.6 THEN label ELSE 0 END) / SUM(label), 6) AS recall,
    ROUND(SUM(CASE WHEN score <= 0.2 THEN label ELSE 0 END) / SUM(label), 6) AS misclass, ROUND(AVG(CASE WHEN score >= 0.6 THEN 1.0::DOUBLE ELSE 0 END), 6) AS high_share,
    ROUND(AVG(CASE WHEN score <= 0.2 THEN 1.0::DOUBLE ELSE 0 END), 6) AS low_share FROM scored"""))
def threshold_apply_given(spark, sf):
    return rnd(dc.evaluate_cutoffs(t.scored_alerts(spark, sf), 0.6, 0.2), recall=6, misclass=6, high_share=6, low_share=6)


HISTORY_SQL = """, th AS (SELECT segment, date_trunc('month', run_date)::DATE AS threshold_date, MAX(score) AS high, MIN(score) AS low FROM scored GROUP BY 1, 2),
    newest AS (SELECT segment, threshold_date, high, low FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY threshold_date DESC) AS rn FROM th) WHERE rn = 1)"""


def threshold_history(spark, sf):
    """Threshold rows per type and month: the extremes seen in that month."""
    return t.scored_alerts(spark, sf).groupBy("segment", F.trunc("run_date", "month").alias("threshold_date")).agg(
        F.max("score").alias("high"), F.min("score").alias("low"))


@query("threshold_latest", with_tables("scored", HISTORY_SQL) + " SELECT segment, threshold_date, high, low FROM newest")
def threshold_latest(spark, sf):
    return shape.latest(threshold_history(spark, sf), ["segment"], ["threshold_date"])


@query("threshold_override", with_tables("scored cust", HISTORY_SQL) + """, manual(segment, high, low) AS (VALUES ('1-URGENT', 0.9::DOUBLE, NULL::DOUBLE), ('2-HIGH', NULL, 0.1))
    SELECT k.segment, COALESCE(m.high, n.high, 0.8::DOUBLE) AS high, COALESCE(m.low, n.low, 0.2::DOUBLE) AS low
    FROM (SELECT DISTINCT o_orderpriority AS segment FROM orders) k LEFT JOIN (SELECT * FROM newest WHERE segment <> '5-LOW') n USING (segment) LEFT JOIN manual m USING (segment)""")
def threshold_override(spark, sf):
    """A manual value beats the stored one, which beats the default."""
    stored = shape.latest(threshold_history(spark, sf).filter("segment <> '5-LOW'"), ["segment"], ["threshold_date"])
    manual = spark.createDataFrame([("1-URGENT", 0.9, None), ("2-HIGH", None, 0.1)], "segment string, m_high double, m_low double")
    kinds = t.load(spark, sf, "orders").select(F.col("o_orderpriority").alias("segment")).distinct()
    return kinds.join(stored, "segment", "left").join(manual, "segment", "left").select(
        "segment", F.coalesce("m_high", "high", F.lit(lv.DEFAULT_HIGH)).alias("high"),
        F.coalesce("m_low", "low", F.lit(lv.DEFAULT_LOW)).alias("low"))


HML = "CASE WHEN {s} >= {h} THEN 'High' WHEN {s} >= {l} THEN 'Medium' ELSE 'Low' END"


@query("risk_level_hml", with_tables("scored", f"SELECT id, {HML.format(s='score', h=0.6, l=0.2)} AS risk_level FROM scored"))
def risk_level_hml(spark, sf):
    return t.scored_alerts(spark, sf).select("id", lv.level_hml(F.col("score"), 0.6, 0.2).alias("risk_level"))


@query("risk_level_tag", with_tables("scored", "SELECT id, CASE WHEN score >= 0.6 THEN 'High' WHEN score <= 0.2 THEN 'Low' ELSE 'Medium' END AS risk_level FROM scored"))
def risk_level_tag(spark, sf):
    return t.scored_alerts(spark, sf).select("id", lv.level_tag(F.col("score"), 0.6, 0.2).alias("risk_level"))


@query("risk_level_hist", with_tables("scored", """SELECT id, CAST(CASE WHEN id % 10 = 0 THEN NULL WHEN score < 0.2 THEN 0 WHEN score > 0.6 THEN 2 ELSE 1 END AS INT) AS risk_level FROM scored"""))
def risk_level_hist(spark, sf):
    score = F.when(F.col("id") % 10 != 0, F.col("score"))
    return t.scored_alerts(spark, sf).select("id", lv.level_int(score, 0.6, 0.2).alias("risk_level"))


@query("risk_level_by_type", with_tables("scored", HISTORY_SQL) + f""" SELECT id, segment, {HML.format(s='score', h='high', l='low')} AS risk_level FROM scored JOIN newest USING (segment)""")
def risk_level_by_type(spark, sf):
    df = t.scored_alerts(spark, sf)
    thr = shape.latest(threshold_history(spark, sf), ["segment"], ["threshold_date"])
    return df.join(thr, "segment").select("id", "segment", lv.level_hml(F.col("score"), F.col("high"), F.col("low")).alias("risk_level"))


@query("risk_distribution", with_tables("scored", f""", x AS (SELECT {HML.format(s='score', h=0.6, l=0.2)} AS risk_level, label FROM scored)
    SELECT risk_level, CAST(COUNT(*) AS BIGINT) AS n, ROUND(COUNT(*) / (SELECT COUNT(*) FROM x), 6) AS share, ROUND(AVG(label), 6) AS recall FROM x GROUP BY 1"""))
def risk_distribution(spark, sf):
    return distribution(t.scored_alerts(spark, sf), lv.level_hml(F.col("score"), 0.6, 0.2))


def distribution(df, level):
    x = df.select(level.alias("risk_level"), "label").groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("n"), F.avg("label").alias("recall"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return x.select("risk_level", "n", F.round(F.col("n") / total, 6).alias("share"), F.round("recall", 6).alias("recall"))


# the four score flows of a customer; a flow may lack a customer
FLOWS_SQL = with_tables("scored", """, s1 AS (SELECT c_custkey AS party, round(abs(c_acctbal) / 10000.0, 4) AS static_score FROM customer WHERE c_acctbal >= -500),
    s2 AS (SELECT o_custkey AS party, round(LEAST(COUNT(*) / 20.0, 1.0)::DOUBLE, 4) AS regulatory_score FROM orders GROUP BY 1),
    s3 AS (SELECT o_custkey AS party, round(LEAST(MAX(o_totalprice) / 600000.0, 1.0), 4) AS anomaly_score FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1),
    s4 AS (SELECT party, MAX(score) AS supervised_score FROM scored WHERE segment = '1-URGENT' GROUP BY 1),
    merged AS (SELECT party, static_score, regulatory_score, anomaly_score, supervised_score FROM s1 FULL JOIN s2 USING (party) FULL JOIN s3 USING (party) FULL JOIN s4 USING (party)),
    flows AS (SELECT *, party % 29 = 0 AS m_static, party % 31 = 0 AS m_regulatory,
        CASE WHEN static_score >= 0.66 THEN 'High' WHEN static_score >= 0.33 THEN 'Medium' WHEN static_score IS NOT NULL THEN 'Low' END AS l1,
        CASE WHEN regulatory_score >= 0.66 THEN 'High' WHEN regulatory_score >= 0.33 THEN 'Medium' WHEN regulatory_score IS NOT NULL THEN 'Low' END AS l2,
        CASE WHEN anomaly_score >= 0.66 THEN 'High' WHEN anomaly_score >= 0.33 THEN 'Medium' WHEN anomaly_score IS NOT NULL THEN 'Low' END AS l3,
        CASE WHEN supervised_score >= 0.66 THEN 'High' WHEN supervised_score >= 0.33 THEN 'Medium' WHEN supervised_score IS NOT NULL THEN 'Low' END AS l4 FROM merged)""")
FLOWS = ["static_score", "regulatory_score", "anomaly_score", "supervised_score"]
FLOW_WEIGHTS = [0.2, 0.3, 0.1, 0.4]
LEVEL_WEIGHTS = {lv.HIGH: 0.6, lv.MEDIUM: 0.3, lv.LOW: 0.1}


def flow_tables(spark, sf):
    orders = t.load(spark, sf, "orders")
    party = F.col("o_custkey").alias("party")
    s1 = t.load(spark, sf, "customer").filter("c_acctbal >= -500").select(
        F.col("c_custkey").alias("party"), F.round(F.abs("c_acctbal") / 10000.0, 4).alias("static_score"))
    s2 = orders.groupBy(party).agg(F.round(F.least(F.count(F.lit(1)) / 20.0, F.lit(1.0)), 4).alias("regulatory_score"))
    s3 = orders.filter("o_orderpriority = '5-LOW'").groupBy(party).agg(
        F.round(F.least(F.max("o_totalprice") / 600000.0, F.lit(1.0)), 4).alias("anomaly_score"))
    s4 = t.scored_alerts(spark, sf).filter("segment = '1-URGENT'").groupBy("party").agg(F.max("score").alias("supervised_score"))
    return [s1, s2, s3, s4]


def flows(spark, sf):
    merged = enrich.outer_all(flow_tables(spark, sf), "party")
    return merged.select(
        "*", (F.col("party") % 29 == 0).alias("m_static"), (F.col("party") % 31 == 0).alias("m_regulatory"),
        *[F.when(F.col(s).isNotNull(), lv.level_hml(F.col(s), 0.66, 0.33)).alias(f"l{i + 1}") for i, s in enumerate(FLOWS)])




def cols(names):
    return [F.col(n) for n in names]


LEVEL_COLS = ["l1", "l2", "l3", "l4"]


@query("train_label_all", FLOWS_SQL + ", labelled AS (SELECT party, MAX(label) AS label FROM scored GROUP BY 1)" + "".join(
    f""", f{i} AS (SELECT {s} AS score, COALESCE(label, 0) AS label FROM merged LEFT JOIN labelled USING (party) WHERE {s} IS NOT NULL)""" for i, s in enumerate(FLOWS))
    + "".join(chart_ntile_sql(100, f"f{i}").replace(" b AS", f" b{i} AS").replace(" c AS", f" c{i} AS").replace("chart AS", f"chart{i} AS")
              .replace("FROM b ", f"FROM b{i} ").replace("FROM c ", f"FROM c{i} ") +
              (RECALL_SQL + ADJUST_SQL.format(source=f"f{i}")).replace("thr", f"thr{i}").replace("shares", f"shares{i}").replace("recut", f"recut{i}")
              .replace("adj ", f"adj{i} ").replace("FROM chart", f"FROM chart{i}") for i in range(4))
    + " UNION ALL ".join(f" SELECT '{s}' AS flow, high, low, CAST((SELECT COUNT(*) FROM f{i} WHERE score >= high) AS BIGINT) AS n_high, CAST((SELECT COUNT(*) FROM f{i} WHERE score < low) AS BIGINT) AS n_low FROM adj{i}" for i, s in enumerate(FLOWS)))
def train_label_all(spark, sf):
    """Threshold rows of all four flows, with the sizes of the High and Low groups; the
    four scores are charted together. The merged scores are read by several steps, so they
    are written once to the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    labels = t.scored_alerts(spark, sf).groupBy("party").agg(F.max("label").alias("label"))
    wide = enrich.outer_all([*flow_tables(spark, sf), labels], "party").select(
        *FLOWS, F.coalesce("label", F.lit(0)).alias("label")).checkpoint()
    chart = dc.decile_chart(wide, 100, FLOWS, rule="ntile", descending=False)
    thr = dc.adjust_to_population(chart, wide, dc.recall_thresholds(chart, 0.7, 0.05), 0.2, 0.3, FLOWS).persist()
    return thr.join(dc.level_sizes(wide, thr, FLOWS), "feature").select(F.col("feature").alias("flow"), "high", "low", "n_high", "n_low")


@query("proxy_metrics", with_tables("scored alert", """, hist_scores AS (SELECT party, run_date, MAX(score) AS score FROM scored GROUP BY 1, 2),
    recent AS (SELECT a.*, h.score, CASE WHEN h.score <= 0.3 THEN 'Low' WHEN h.score < 0.6 THEN 'Medium' ELSE 'High' END AS bucket FROM alert a
        JOIN hist_scores h ON h.party = a.party AND h.run_date = a.alert_date WHERE a.alert_date > (SELECT MAX(alert_date) FROM alert) - 360)
    SELECT ROUND(COUNT(CASE WHEN bucket = 'High' AND result = 'F' THEN 1 END) / NULLIF(COUNT(CASE WHEN bucket = 'High' THEN 1 END), 0), 6) AS precision_high,
        ROUND(COUNT(CASE WHEN bucket = 'High' AND result = 'F' THEN 1 END) / NULLIF(COUNT(CASE WHEN result = 'F' THEN 1 END), 0), 6) AS recall_high,
        ROUND(COALESCE(COUNT(CASE WHEN bucket = 'Low' AND result = 'F' THEN 1 END) / NULLIF(COUNT(CASE WHEN result = 'F' THEN 1 END), 0), 0), 6) AS misclass_low,
        ROUND(COUNT(CASE WHEN bucket = 'Low' THEN 1 END) / COUNT(*), 6) AS low_share FROM recent"""))
def proxy_metrics(spark, sf):
    history = t.scored_alerts(spark, sf).groupBy("party", F.col("run_date").alias("alert_date")).agg(F.max("score").alias("score"))
    alerts = t.alerts(spark, sf)
    last = alerts.agg(F.max("alert_date")).scalar()
    recent = alerts.filter(F.col("alert_date") > F.date_sub(last, 360)).join(history, ["party", "alert_date"])
    score, true = F.col("score"), F.col("result") == "F"
    high, low = score >= 0.6, score <= 0.3

    def n(cond):
        return F.count(F.when(cond, True))

    def share(a, b):
        return F.when(b > 0, a / b)
    return recent.agg(
        F.round(share(n(high & true), n(high)), 6).alias("precision_high"), F.round(share(n(high & true), n(true)), 6).alias("recall_high"),
        F.round(F.coalesce(share(n(low & true), n(true)), F.lit(0.0)), 6).alias("misclass_low"),
        F.round(n(low) / F.count(F.lit(1)), 6).alias("low_share"))


# ---- combination ----------------------------------------------------------------------

@query("score_rescale", FLOWS_SQL + " SELECT party, ROUND(0.5 * (1.0 + static_score)::DOUBLE, 6) AS static_score, regulatory_score AS raw_score FROM flows")
def score_rescale(spark, sf):
    return flows(spark, sf).select("party", F.round(sc.rescale(F.col("static_score")), 6).alias("static_score"),
                                   sc.rescale(F.col("regulatory_score"), raw=True).alias("raw_score"))


def w_sql(weights) -> str:
    total = " + ".join(f"CASE WHEN {s} IS NOT NULL THEN {w} ELSE 0 END" for s, w in zip(FLOWS, weights))
    parts = " + ".join(f"COALESCE({s} * {w}, 0)" for s, w in zip(FLOWS, weights))
    return f"({parts})::DOUBLE / NULLIF(({total})::DOUBLE, 0)"


FLOW_AVG = w_sql(FLOW_WEIGHTS)


@query("score_weighted_flow", FLOWS_SQL + f" SELECT party, ROUND({FLOW_AVG} * 100, 6) AS score FROM flows")
def score_weighted_flow(spark, sf):
    return flows(spark, sf).select("party", F.round(sc.weighted_by_flow(cols(FLOWS), FLOW_WEIGHTS), 6).alias("score"))


@query("score_weighted_level", FLOWS_SQL + " SELECT party, ROUND(" + w_sql([
    f"(CASE {c} WHEN 'High' THEN 0.6 WHEN 'Medium' THEN 0.3 WHEN 'Low' THEN 0.1 END)" for c in LEVEL_COLS]) + " * 100, 6) AS score FROM flows")
def score_weighted_level(spark, sf):
    return flows(spark, sf).select("party", F.round(sc.weighted_by_level(cols(FLOWS), cols(LEVEL_COLS), LEVEL_WEIGHTS), 6).alias("score"))


@query("score_raw_modes", FLOWS_SQL + """ SELECT party, ROUND(static_score * 100, 4) AS static_only, ROUND(regulatory_score * 100, 4) AS regulatory_only,
    ROUND((static_score + regulatory_score) * 0.5 * 100, 4) AS both FROM flows""")
def score_raw_modes(spark, sf):
    a, b = F.col("static_score"), F.col("regulatory_score")
    return flows(spark, sf).select("party", *[F.round(sc.raw_mode(a, b, m), 4).alias(n) for m, n in (
        ("static", "static_only"), ("regulatory", "regulatory_only"), ("average", "both"))])


RANK = "CASE {c} WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 WHEN 'Low' THEN 1 END"
MAX_SQL = "CASE GREATEST(" + ", ".join(f"COALESCE({RANK.format(c=c)}, 0)" for c in LEVEL_COLS) + ") WHEN 3 THEN 'High' WHEN 2 THEN 'Medium' WHEN 1 THEN 'Low' END"
AVG_SQL = "(" + " + ".join(f"COALESCE({s}, 0)" for s in FLOWS) + ") / NULLIF(" + " + ".join(f"({s} IS NOT NULL)::INT" for s in FLOWS) + ", 0)"


@query("score_mandatory_override", FLOWS_SQL + f""" SELECT party, CASE WHEN m_static THEN COALESCE(l1, 'High') WHEN m_regulatory THEN COALESCE(l2, 'High') ELSE {MAX_SQL} END AS risk_level,
    CASE WHEN m_static OR m_regulatory THEN 100.0::DOUBLE ELSE ROUND(GREATEST({', '.join(FLOWS)}), 6) END AS max_score,
    CASE WHEN m_static OR m_regulatory THEN 0.0::DOUBLE ELSE ROUND(LEAST({', '.join(FLOWS)}), 6) END AS min_score,
    CASE WHEN m_static OR m_regulatory THEN 50.0::DOUBLE ELSE ROUND({AVG_SQL}, 6) END AS avg_score,
    CASE WHEN m_static OR m_regulatory THEN 100.0::DOUBLE ELSE ROUND({FLOW_AVG} * 100, 6) END AS ensemble_score FROM flows""")
def score_mandatory_override(spark, sf):
    ms, mr = F.col("m_static"), F.col("m_regulatory")
    s = cols(FLOWS)
    level = F.when(ms, F.coalesce("l1", F.lit(lv.HIGH))).when(mr, F.coalesce("l2", F.lit(lv.HIGH))).otherwise(lv.level_max(cols(LEVEL_COLS)))
    fixed = {"max_score": (100.0, F.round(F.greatest(*s), 6)), "min_score": (0.0, F.round(F.least(*s), 6)),
             "avg_score": (50.0, F.round(sc.mean_present(s), 6)),
             "ensemble_score": (100.0, F.round(sc.weighted_by_flow(s, FLOW_WEIGHTS), 6))}
    return flows(spark, sf).select("party", level.alias("risk_level"), *[sc.override(ms, mr, v, c).alias(n) for n, (v, c) in fixed.items()])


@query("level_max", FLOWS_SQL + f" SELECT party, {MAX_SQL} AS risk_level FROM flows")
def level_max(spark, sf):
    return flows(spark, sf).select("party", lv.level_max(cols(LEVEL_COLS)).alias("risk_level"))


@query("level_vote", FLOWS_SQL + """, votes AS (SELECT party, level, COUNT(*) AS n, CASE level WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 ELSE 1 END AS rk
        FROM (SELECT party, UNNEST([l1, l2, l3, l4]) AS level FROM flows) WHERE level IS NOT NULL GROUP BY 1, 2),
    t AS (SELECT party, MAX(n) AS top, MAX(rk) AS highest FROM votes GROUP BY 1),
    w AS (SELECT v.party, COUNT(*) AS winners, MAX(v.level) AS winner, ANY_VALUE(highest) AS highest FROM votes v JOIN t ON v.party = t.party AND v.n = t.top GROUP BY 1)
    SELECT f.party, CASE WHEN w.party IS NULL THEN 'High' WHEN winners = 1 THEN winner WHEN highest = 3 THEN 'High' WHEN highest = 2 THEN 'Medium' ELSE 'Low' END AS risk_level
    FROM flows f LEFT JOIN w USING (party)""")
def level_vote(spark, sf):
    return flows(spark, sf).select("party", lv.level_vote(cols(LEVEL_COLS)).alias("risk_level"))


@query("level_agg", FLOWS_SQL + f" SELECT party, {HML.format(s=f'ROUND({FLOW_AVG}, 6)', h=0.5, l=0.3)} AS risk_level FROM flows")
def level_agg(spark, sf):
    mean = F.round(sc.weighted(cols(FLOWS), [F.lit(w) for w in FLOW_WEIGHTS]), 6)
    return flows(spark, sf).select("party", lv.level_hml(mean, 0.5, 0.3).alias("risk_level"))


@query("score_min_max_avg", FLOWS_SQL + f" SELECT party, GREATEST({', '.join(FLOWS)}) AS max_score, LEAST({', '.join(FLOWS)}) AS min_score, ROUND({AVG_SQL}, 6) AS avg_score FROM flows")
def score_min_max_avg(spark, sf):
    s = cols(FLOWS)
    return flows(spark, sf).select("party", F.greatest(*s).alias("max_score"), F.least(*s).alias("min_score"), F.round(sc.mean_present(s), 6).alias("avg_score"))


SIGMOID_SQL = "1.0 / (1.0 + EXP(-({c} - (SELECT AVG({c}) FROM orders)) / (SELECT STDDEV_SAMP({c}) FROM orders)))"


@query("score_sigmoid_z", f"SELECT o_orderkey, ROUND({SIGMOID_SQL.format(c='o_totalprice')}, 6) AS o_totalprice_score, ROUND(0.5::DOUBLE, 6) AS flat_score FROM orders")
def score_sigmoid_z(spark, sf):
    df = t.load(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.lit(7.0).alias("flat"))
    return rnd(sc.sigmoid_scores(df, ["o_totalprice", "flat"]).drop("o_totalprice", "flat"), o_totalprice_score=6, flat_score=6)


@query("score_weight_product", with_tables("scored", "SELECT id, ROUND(score * 0.5 * CASE label WHEN 1 THEN 1.2 ELSE 0.8 END::DOUBLE, 6) AS weighted FROM scored"))
def score_weight_product(spark, sf):
    w = F.when(F.col("label") == 1, 1.2).otherwise(0.8)
    return t.scored_alerts(spark, sf).select("id", F.round(sc.weight_product(F.col("score"), [0.5, w]), 6).alias("weighted"))


@query("component_score", with_tables("cust", """SELECT party AS customer_key, round(abs(CAST(balance AS DOUBLE)) / 10000.0, 4) AS risk_score,
    '{"CLUSTER_ID":"' || nation || '","MODEL_ID":"42"}' AS component_attributes, 'CUSTOMER TRANSACTION BEHAVIOUR' AS component, DATE '2024-01-31' AS created FROM cust"""))
def component_score(spark, sf):
    return t.customers(spark, sf).select(
        F.col("party").alias("customer_key"), F.round(F.abs(F.col("balance").cast("double")) / 10000.0, 4).alias("risk_score"),
        sc.component_attributes(F.col("nation"), F.lit(42)).alias("component_attributes"),
        F.lit("CUSTOMER TRANSACTION BEHAVIOUR").alias("component"), F.lit("2024-01-31").cast("date").alias("created"))


@query("anomaly_filter", with_tables("scored hist", """, p AS (SELECT party, MAX(score) AS score FROM scored GROUP BY 1)
    SELECT party, score FROM p WHERE party NOT IN (SELECT party FROM hist WHERE alert_date > DATE '2000-06-01') ORDER BY score DESC, party LIMIT 100"""))
def anomaly_filter(spark, sf):
    past = t.alert_history(spark, sf).filter(F.col("alert_date") > F.lit("2000-06-01").cast("date")).groupBy("party").agg(F.count(F.lit(1)).alias("past"))
    scored = t.scored_alerts(spark, sf).groupBy("party").agg(F.max("score").alias("score"))
    df = scored.join(past, "party", "left").na.fill(0, ["past"])
    return br.anomaly_filter(df, 100, "score", "party", "past").select("party", "score")


BRANCH_SQL = with_tables("cust", """, r AS (SELECT party, 7 AS model_id, segment || ' / ' || region || CASE WHEN balance < 0 THEN ' / overdrawn' ELSE '' END AS rule FROM cust),
    m AS (SELECT model_id, rule, CAST(row_number() OVER (ORDER BY COUNT(*), model_id, rule) AS INT) AS branch_id, CAST(CASE WHEN COUNT(*) >= 50 THEN 1 ELSE 0 END AS INT) AS to_cluster FROM r GROUP BY 1, 2)""")


def tree_rows(spark, sf):
    rule = F.concat("segment", F.lit(" / "), "region", F.when(F.col("balance") < 0, " / overdrawn").otherwise(""))
    return t.customers(spark, sf).select("party", F.lit(7).alias("model_id"), rule.alias("rule"))


@query("tree_branch_split", BRANCH_SQL + " SELECT party, branch_id, to_cluster FROM r JOIN m USING (model_id, rule)")
def tree_branch_split(spark, sf):
    return br.branch_split(tree_rows(spark, sf)).select("party", "branch_id", "to_cluster")


@query("tree_branch_apply", BRANCH_SQL + " SELECT party, CASE WHEN party % 6 <> 0 THEN branch_id END AS branch_id, CASE WHEN party % 6 <> 0 THEN to_cluster END AS to_cluster FROM r LEFT JOIN m USING (model_id, rule)")
def tree_branch_apply(spark, sf):
    """The stored branch map is applied to new rows; rows of another model stay unassigned."""
    rows = tree_rows(spark, sf)
    stored = br.branch_map(rows).agg(F.to_json(F.collect_list(F.struct("model_id", "rule", "branch_id", "to_cluster"))).alias("model_parameters"))
    fresh = rows.withColumn("model_id", F.when(F.col("party") % 6 == 0, 8).otherwise(F.col("model_id")))
    return br.branch_apply(fresh, stored).select("party", "branch_id", "to_cluster")


@query("missing_prob_col", with_tables("scored", "SELECT id, score AS Prediction_Prob_1_tree, 0.1::DOUBLE AS Prediction_Prob_0_tree FROM scored"))
def missing_prob_col(spark, sf):
    return br.ensure_prob(t.scored_alerts(spark, sf).select("id", F.col("score").alias("Prediction_Prob_1_tree")))

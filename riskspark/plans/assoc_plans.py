"""Queries over feature association, contributions and explanations."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators import assoc as ac, clusters as cl, explain as ex, features as ft
from riskspark.plans.base_sql import with_tables
from riskspark.plans.registry import query
from riskspark.plans.rule_plans import FEATURES_SQL, rule_features
from riskspark.plans.score_plans import FLOWS, FLOWS_SQL, flows
from riskspark.sources import tables as t

NUMS = ["balance", "age", "in_360", "out_360", "vol_360"]
CATS = ["segment", "region"]
THRESHOLD = 0.5
TYPOLOGY = {"in_360": "FLOW", "out_360": "FLOW", "balance": "STATIC", "segment": "STATIC"}


def r6(df, *cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


RANKS_SQL = ", rk AS (SELECT party, segment, region, " + ", ".join(
    f"{c}, rank() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}_r" for c in NUMS) + " FROM feat)"
PAIRS = [(a, b) for i, a in enumerate(NUMS) for b in NUMS[i + 1:]]
SPEARMAN_SQL = " UNION ALL ".join(f"SELECT '{a}' AS f1, '{b}' AS f2, corr({a}_r, {b}_r) AS r FROM rk" for a, b in PAIRS)


def v_sql(a: str, b: str, source: str, name_a: str | None = None) -> str:
    return f"""SELECT '{name_a or a}' AS f1, '{b}' AS f2, sqrt(GREATEST(0, s - 1 - (k - 1) * (r - 1) / (n - 1)) / GREATEST(LEAST(r - (r - 1) * (r - 1) / (n - 1) - 1, k - (k - 1) * (k - 1) / (n - 1) - 1), 0.001)) AS r
    FROM (SELECT SUM(c.n * c.n / (CAST(x.n AS DOUBLE) * y.n)) AS s, CAST(SUM(c.n) AS DOUBLE) AS n, (SELECT COUNT(DISTINCT {a}) FROM {source}) AS r, (SELECT COUNT(DISTINCT {b}) FROM {source}) AS k
        FROM (SELECT {a} AS a, {b} AS b, COUNT(*) AS n FROM {source} GROUP BY 1, 2) c JOIN (SELECT {a} AS a, COUNT(*) AS n FROM {source} GROUP BY 1) x ON x.a = c.a
        JOIN (SELECT {b} AS b, COUNT(*) AS n FROM {source} GROUP BY 1) y ON y.b = c.b)"""


def cut_sql(num: str, cat: str) -> str:
    return f""", cuts_{num}_{cat} AS (SELECT DISTINCT UNNEST([m - s, m + s, lo, hi]) AS cut FROM (SELECT {cat}, AVG({num}) AS m, STDDEV_POP({num}) AS s, MIN({num})::DOUBLE AS lo, MAX({num})::DOUBLE AS hi FROM feat GROUP BY 1)),
    b_{num}_{cat} AS (SELECT f.{cat}, (SELECT COUNT(*) FROM cuts_{num}_{cat} WHERE f.{num} >= cut) AS bucket FROM feat f)"""


@query("corr_spearman", FEATURES_SQL + RANKS_SQL + f" SELECT f1, f2, ROUND(r, 6) AS r FROM ({SPEARMAN_SQL})")
def corr_spearman(spark, sf):
    return r6(ac.spearman(rule_features(spark, sf), "party", NUMS), "r")


@query("corr_cramers_v", with_tables("txn", ", x AS (SELECT category, opp_party % 5 AS branch FROM txn)") + f" SELECT f1, f2, ROUND(r, 6) AS r FROM ({v_sql('category', 'branch', 'x')})")
def corr_cramers_v(spark, sf):
    return r6(ac.cramers_v(t.transactions(spark, sf).select("category", (F.col("opp_party") % 5).alias("branch")), [("category", "branch")]), "r")


NUM_CAT_SQL = "".join(cut_sql(n, "segment") for n in NUMS)
NUM_CAT_REGION_SQL = "".join(cut_sql(n, "region") for n in NUMS)


def num_cat_rows(cat: str) -> str:
    return " UNION ALL ".join(v_sql("bucket", cat, f"b_{n}_{cat}", n) for n in NUMS)


@query("corr_num_cat", FEATURES_SQL + NUM_CAT_SQL + f" SELECT f1, f2, ROUND(r, 6) AS r FROM ({num_cat_rows('segment')})")
def corr_num_cat(spark, sf):
    return r6(ac.num_cat_v(rule_features(spark, sf), NUMS, ["segment"]), "r")


ASSOC_SQL = FEATURES_SQL + RANKS_SQL + NUM_CAT_SQL + NUM_CAT_REGION_SQL + f""", assoc AS ({SPEARMAN_SQL} UNION ALL {v_sql('segment', 'region', 'feat')}
    UNION ALL {num_cat_rows('segment')} UNION ALL {num_cat_rows('region')})"""


def assoc_of(spark, sf):
    """A row per pair of features: small, and read by several steps."""
    return ac.assoc_matrix(rule_features(spark, sf), "party", NUMS, CATS).persist()


@query("corr_matrix", ASSOC_SQL + " SELECT f1, f2, ROUND(COALESCE(r, 0), 6) AS r FROM assoc")
def corr_matrix(spark, sf):
    return r6(ac.assoc_matrix(rule_features(spark, sf), "party", NUMS, CATS), "r")


GROUP_SQL = ASSOC_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + f""", names AS (SELECT UNNEST({NUMS + CATS}) AS feature),
    e AS (SELECT f1 AS a, f2 AS b FROM assoc WHERE abs(r) >= {THRESHOLD} UNION SELECT f2, f1 FROM assoc WHERE abs(r) >= {THRESHOLD}),
    reach(feature, root) AS (SELECT feature, feature FROM names UNION SELECT e.b, reach.root FROM reach JOIN e ON e.a = reach.feature),
    grp AS (SELECT feature, MIN(root) AS grp FROM reach GROUP BY 1)"""


@query("feature_groups", GROUP_SQL + ' SELECT feature, grp AS "group" FROM grp')
def feature_groups(spark, sf):
    return ac.feature_groups(assoc_of(spark, sf), NUMS + CATS, THRESHOLD)


LINKAGE_BELOW = 0.6
_FEATURES = NUMS + CATS


def linkage_sql() -> str:
    """One merge after the other: distances of the features, then a step for each possible merge."""
    steps = [f""", g0(feature, grp) AS (VALUES {", ".join(f"('{f}', '{f}')" for f in _FEATURES)})"""]
    for k in range(len(_FEATURES) - 1):
        steps.append(f""", m{k} AS (SELECT x.grp AS a, y.grp AS b, AVG(d) AS h FROM dist JOIN g{k} x ON x.feature = dist.a JOIN g{k} y ON y.feature = dist.b WHERE x.grp < y.grp GROUP BY 1, 2 ORDER BY h, a, b LIMIT 1),
        g{k + 1} AS (SELECT feature, CASE WHEN grp = (SELECT b FROM m{k} WHERE h < {LINKAGE_BELOW}) THEN (SELECT a FROM m{k}) ELSE grp END AS grp FROM g{k})""")
    return ASSOC_SQL + """, mat AS (SELECT f1 AS f, f2 AS k, abs(COALESCE(r, 0)) AS x FROM assoc UNION ALL SELECT f2, f1, abs(COALESCE(r, 0)) FROM assoc UNION ALL SELECT f, f, 1.0 FROM (SELECT UNNEST(""" + str(_FEATURES) + """) AS f)),
    dist AS (SELECT p.f AS a, q.f AS b, 1 - SUM(p.x * q.x) / (sqrt((SELECT SUM(x * x) FROM mat WHERE f = p.f)) * sqrt((SELECT SUM(x * x) FROM mat WHERE f = q.f))) AS d FROM mat p JOIN mat q ON p.k = q.k AND p.f <> q.f GROUP BY 1, 2)""" + \
        "".join(steps) + f' SELECT feature, grp AS "group" FROM g{len(_FEATURES) - 1}'


@query("feature_groups_linkage", linkage_sql())
def feature_groups_linkage(spark, sf):
    return ac.linkage_groups(ac.assoc_matrix(rule_features(spark, sf), "party", NUMS, CATS), NUMS + CATS, below=LINKAGE_BELOW)


TYPOLOGY_SQL = GROUP_SQL + ", known(feature, typology) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in TYPOLOGY.items()) + """),
    ty AS (SELECT g.feature, g.grp, COALESCE(k.typology, 'NA') AS typology FROM grp g LEFT JOIN known k USING (feature)),
    both_ways AS (SELECT f1, f2, r FROM assoc UNION ALL SELECT f2, f1, r FROM assoc),
    guess AS (SELECT feature, t, row_number() OVER (PARTITION BY feature ORDER BY m DESC, t) AS rn FROM (SELECT a.feature, b.typology AS t, AVG(ABS(r)) AS m FROM ty a JOIN both_ways w ON w.f1 = a.feature
        JOIN ty b ON b.feature = w.f2 AND b.grp = a.grp AND b.typology <> 'NA' WHERE a.typology = 'NA' GROUP BY 1, 2)),
    filled AS (SELECT ty.feature, ty.grp, CASE WHEN typology = 'NA' THEN COALESCE(g.t, 'NA') ELSE typology END AS typology FROM ty LEFT JOIN guess g ON g.feature = ty.feature AND g.rn = 1),
    cnt AS (SELECT grp, typology, COUNT(*) AS n FROM filled GROUP BY 1, 2),
    top AS (SELECT grp, MIN(n) AS lo, MAX(n) AS hi, (array_agg(typology ORDER BY n DESC, typology))[1] AS t FROM cnt GROUP BY 1),
    typo AS (SELECT feature, grp, CASE WHEN lo = hi THEN typology ELSE t END AS typology FROM filled JOIN top USING (grp))"""


@query("group_typology", TYPOLOGY_SQL + ' SELECT feature, grp AS "group", typology FROM typo')
def group_typology(spark, sf):
    assoc = assoc_of(spark, sf)
    known = spark.createDataFrame(list(TYPOLOGY.items()), "feature string, typology string")
    return ac.assign_typology(ac.feature_groups(assoc, NUMS + CATS, THRESHOLD), known, assoc)


@query("melt_wide", FLOWS_SQL + " SELECT party, feature, value FROM (" + " UNION ALL ".join(f"SELECT party, '{s}' AS feature, {s} AS value FROM flows" for s in FLOWS) + ")")
def melt_wide(spark, sf):
    return cl.melt(flows(spark, sf), ["party"], FLOWS)


CONTRIB = {"balance": "round(balance / 10000, 4)", "age": "round((age - 50) / 100.0, 4)", "in_360": "round(in_360 / 500000 - 0.2, 4)",
           "out_360": "round(out_360 / 500000 - 0.2, 4)", "vol_360": "round(vol_360 / 50.0 - 0.1, 4)"}
CONTRIB_SQL = FEATURES_SQL + ", contrib AS (" + " UNION ALL ".join(
    f"SELECT party, '{f}' AS feature, CAST({e.replace('0.2', '0.2::DOUBLE').replace('0.1', '0.1::DOUBLE')} AS DOUBLE) AS contribution FROM feat" for f, e in CONTRIB.items()) + ")"
NORM_SQL = CONTRIB_SQL + ", norm AS (SELECT party, feature, contribution / NULLIF(SUM(ABS(contribution)) OVER (PARTITION BY party), 0) AS contribution FROM contrib)"


def explanations(spark, sf):
    """What a boosted-tree model hands over: the explanation of each party as JSON text."""
    df = rule_features(spark, sf)
    made = {"balance": F.col("balance") / 10000, "age": (F.col("age") - 50) / 100.0, "in_360": F.col("in_360") / 500000 - 0.2,
            "out_360": F.col("out_360") / 500000 - 0.2, "vol_360": F.col("vol_360") / 50.0 - 0.1}
    items = F.array(*[F.struct(F.lit("n").alias("node_str"), F.lit(f).alias("feature_name"), F.round(c, 4).alias("feature_weight")) for f, c in made.items()])
    return df.select("party", F.to_json(items).alias("explanation"))


def parsed(spark, sf):
    return ex.parse_explanations(explanations(spark, sf), "party", "explanation")


@query("contrib_parse_json", CONTRIB_SQL + " SELECT party, feature, contribution FROM contrib")
def contrib_parse_json(spark, sf):
    return parsed(spark, sf)


@query("contrib_normalise", NORM_SQL + " SELECT party, feature, ROUND(contribution, 6) AS contribution FROM norm")
def contrib_normalise(spark, sf):
    return r6(ex.normalise_abs(parsed(spark, sf), "party"), "contribution")


FIXED_GROUPS = {"in_360": "1", "out_360": "1", "vol_360": "1", "balance": "2"}
MAPS_SQL = ", g(feature, grp) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in FIXED_GROUPS.items()) + "), ty(feature, typology) AS (VALUES " + ", ".join(
    f"('{k}', '{v}')" for k, v in TYPOLOGY.items()) + """), named AS (SELECT n.party, n.feature, n.contribution, COALESCE(g.grp, '-99') AS grp, COALESCE(ty.typology, 'OTHERS') AS typology
    FROM {source} n LEFT JOIN g USING (feature) LEFT JOIN ty USING (feature)),
    summed AS (SELECT *, SUM(contribution) OVER (PARTITION BY party, grp) AS gc, SUM(contribution) OVER (PARTITION BY party, grp, typology) AS tc FROM named)"""


def maps(spark):
    return (spark.createDataFrame(list(FIXED_GROUPS.items()), "feature string, group string"),
            spark.createDataFrame(list(TYPOLOGY.items()), "feature string, typology string"))


@query("contrib_group_sums", NORM_SQL + MAPS_SQL.format(source="norm") + """ SELECT party, feature, typology, grp AS "group", ROUND(contribution, 6) AS contribution, ROUND(tc, 6) AS typology_contribution, ROUND(gc, 6) AS group_contribution FROM summed""")
def contrib_group_sums(spark, sf):
    made = ex.group_contrib(ex.normalise_abs(parsed(spark, sf), "party"), "party", *maps(spark))
    return r6(made, "contribution", "typology_contribution", "group_contribution")


CHANNELS = {"incoming-all": ["R-O", "A-O", "N-O"], "outgoing-all": ["R-F", "A-F", "N-F"],
            **{c: [c] for c in ("R-O", "A-O", "N-O", "R-F", "A-F", "N-F")}}
COMPOSITE = "net_incoming-all_360DAY_AMT_outgoing-all_360DAY_AMT"


def text_sql(x: str) -> str:
    return f"CASE WHEN {x} >= 1e9 THEN CAST(ROUND({x} / 1e9, 3) AS VARCHAR) || ' Billion' WHEN {x} >= 1e6 THEN CAST(ROUND({x} / 1e6, 3) AS VARCHAR) || ' Million' ELSE CAST(ROUND({x}, 3) AS VARCHAR) END"


def _component(name: str, cats) -> str:
    def value(cats):
        return text_sql("CAST(COALESCE(SUM(CASE WHEN category IN (" + ", ".join(repr(c) for c in cats) + ") THEN amount END), 0) AS DOUBLE)")
    inner = " || ',' || ".join(f"""'{{"channelType":"{c}","value":"' || {value([c])} || '"}}'""" for c in cats)
    return f"""'{{"componentName":"{name}_360DAY_AMT","value":"' || {value(cats)} || '","channelInfo":[' || {inner} || ']}}'"""


@query("channel_breakdown", with_tables("txn refs", f"""SELECT r.party, r.ref_date, '[' || {_component('incoming-all', CHANNELS['incoming-all'])} || ',' || {_component('outgoing-all', CHANNELS['outgoing-all'])} || ']' AS channel_info
    FROM refs r LEFT JOIN txn t ON t.party = r.party AND t.txn_date <= r.ref_date AND t.txn_date > r.ref_date - 360 GROUP BY 1, 2"""))
def channel_breakdown(spark, sf):
    parts = ex.components(COMPOSITE, CHANNELS)
    wanted = [p for p, _ in parts] + [f for _, channels in parts for _, f in channels]
    made = ft.feature_matrix(t.transactions(spark, sf), t.reference_points(t.alerts(spark, sf)), wanted, CHANNELS, category_col="category")
    return made.select("party", "ref_date", ex.channel_info(COMPOSITE, CHANNELS).alias("channel_info"))


@query("ratio_display", with_tables("txn refs", """, s AS (SELECT r.party, r.ref_date, CAST(COALESCE(SUM(CASE WHEN direction = 'incoming-all' THEN amount END), 0) AS DOUBLE) AS a,
    CAST(COALESCE(SUM(CASE WHEN direction = 'outgoing-all' THEN amount END), 0) AS DOUBLE) AS b FROM refs r LEFT JOIN txn t ON t.party = r.party AND t.txn_date <= r.ref_date AND t.txn_date > r.ref_date - 90 GROUP BY 1, 2)
    SELECT party, ref_date, CASE WHEN b = 0 AND a > 0 THEN '>10' ELSE CAST(ROUND(a / NULLIF(b, 0), 3) AS VARCHAR) END AS ratio FROM s"""))
def ratio_display(spark, sf):
    cats = {"incoming-all": ["incoming-all"], "outgoing-all": ["outgoing-all"]}
    a, b = "incoming-all_90DAY_AMT", "outgoing-all_90DAY_AMT"
    made = ft.feature_matrix(t.transactions(spark, sf), t.reference_points(t.alerts(spark, sf)), [a, b, f"ratio_{a}_{b}"], cats)
    return made.select("party", "ref_date", ex.ratio_text(F.col(f"`ratio_{a}_{b}`"), F.col(f"`{a}`"), F.col(f"`{b}`")).alias("ratio"))


@query("breakdown_validate", FLOWS_SQL + " SELECT party, feature, value FROM (SELECT party, 'ratio_incoming-all_30DAY_AMT_incoming-all_90DAY_AMT' AS feature, static_score AS value FROM flows UNION ALL SELECT party, 'incoming-all_30DAY_AMT', regulatory_score FROM flows)")
def breakdown_validate(spark, sf):
    """Only composite features are kept for break-down."""
    named = {"static_score": "ratio_incoming-all_30DAY_AMT_incoming-all_90DAY_AMT", "regulatory_score": "incoming-all_30DAY_AMT",
             "anomaly_score": "R-O_30DAY_AMT", "supervised_score": "age"}
    wide = flows(spark, sf).select("party", *[F.col(c).alias(n) for c, n in named.items()])
    return cl.melt(wide, ["party"], [n for n in named.values() if ex.needs_breakdown(n, CHANNELS)])


NAMES = {"in_360": "Incoming over 360 days", "out_360": "Outgoing over 360 days"}
TABLE_SQL = """ SELECT party, feature, CASE feature WHEN 'in_360' THEN 'Incoming over 360 days' WHEN 'out_360' THEN 'Outgoing over 360 days' ELSE feature END AS display_name, ROUND(contribution, 6) AS contribution, typology,
    ROUND(tc, 6) AS typology_contribution, grp AS "group", ROUND(gc, 6) AS group_contribution, '{cat}' AS explainability_category, DATE '2024-01-31' AS created_time, 'system' AS created_user, 20241::INT AS year_month FROM summed"""


def final_table(spark, contrib, category):
    grouped = ex.group_contrib(contrib, "party", *maps(spark))
    made = ex.explain_table(grouped, "party", category, NAMES, at=F.lit("2024-01-31").cast("date"))
    return r6(made, "contribution", "typology_contribution", "group_contribution")


@query("explain_supervised", NORM_SQL + MAPS_SQL.format(source="norm") + TABLE_SQL.format(cat="HISTORICAL_BEHAVIOUR"))
def explain_supervised(spark, sf):
    return final_table(spark, ex.normalise_abs(parsed(spark, sf), "party"), "HISTORICAL_BEHAVIOUR")


@query("explain_unsupervised", FLOWS_SQL + ", wide AS (" + " UNION ALL ".join(f"SELECT party, '{n}' AS feature, {s} AS contribution FROM flows WHERE {s} IS NOT NULL" for s, n in zip(FLOWS, ["in_360", "out_360", "balance", "age"]))
       + "), nz AS (SELECT party, feature, contribution / NULLIF(SUM(ABS(contribution)) OVER (PARTITION BY party), 0) AS contribution FROM wide)" + MAPS_SQL.format(source="nz") + TABLE_SQL.format(cat="UNSUPERVISED"))
def explain_unsupervised(spark, sf):
    wide = flows(spark, sf).select("party", *[F.col(s).alias(n) for s, n in zip(FLOWS, ["in_360", "out_360", "balance", "age"])])
    long = cl.melt(wide, ["party"], wide.columns[1:], value="contribution").filter(F.col("contribution").isNotNull())
    return final_table(spark, ex.normalise_abs(long, "party"), "UNSUPERVISED")

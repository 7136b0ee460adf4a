"""Queries over cluster statistics, clustering and cluster quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators import clusters as cl, density as dn
from riskspark.operators.lookback import lookback_features
from riskspark.operators.ranks import ranked_values
from riskspark.plans.base_sql import with_tables
from riskspark.plans.lookback_plans import CATEGORIES, _SHIFTS, amt, sql_features
from riskspark.operators.features import parse_first
from riskspark.plans.registry import query
from riskspark.sources import tables as t

FEATURES = [f"f{i}" for i in range(64)]           # every element of the vectors
SEGMENTS = ["retail", "private", "corporate"]
VEC_SQL = f"""WITH vec AS (SELECT vec_id, label AS cluster, {", ".join(f"embedding[{i + 1}]::DOUBLE AS {f}" for i, f in enumerate(FEATURES))},
    CAST(vec_id % 4 AS BIGINT) AS alerts, CASE WHEN vec_id % 3 = 0 THEN 1 ELSE 0 END AS true_alerts,
    (['retail', 'private', 'corporate'])[CAST(vec_id * 7 % 11 % 3 + 1 AS INT)] AS segment FROM embeddings),
    long AS (SELECT cluster, feature, value, vec_id FROM vec UNPIVOT (value FOR feature IN ({", ".join(FEATURES)})))"""


def vectors(spark, sf):
    segment = F.element_at(F.array(*[F.lit(s) for s in SEGMENTS]), (F.col("vec_id") * 7 % 11 % 3 + 1).cast("int"))
    return t.load(spark, sf, "embeddings").select(
        "vec_id", F.col("label").alias("cluster"), *[F.col("embedding")[i].cast("double").alias(f) for i, f in enumerate(FEATURES)],
        (F.col("vec_id") % 4).alias("alerts"), F.when(F.col("vec_id") % 3 == 0, 1).otherwise(0).alias("true_alerts"), segment.alias("segment"))


def rnd(df, digits, *cols):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


STATS_SQL = ", stats AS (SELECT cluster, feature, AVG(value) AS mean, COALESCE(STDDEV_SAMP(value), 0) AS sd, MIN(value) AS min, MAX(value) AS max FROM long GROUP BY 1, 2)"


@query("cluster_mean_sd", VEC_SQL + STATS_SQL + " SELECT cluster, feature, ROUND(mean, 6) AS mean, ROUND(sd, 6) AS sd, min, max FROM stats")
def cluster_mean_sd(spark, sf):
    return rnd(cl.cluster_stats(vectors(spark, sf), "cluster", FEATURES), 6, "mean", "sd")


@query("cluster_size_counts", VEC_SQL + " SELECT cluster, CAST(COUNT(*) AS BIGINT) AS size, CAST(SUM(alerts) AS BIGINT) AS alerts, CAST(SUM(true_alerts) AS BIGINT) AS true_alerts FROM vec GROUP BY 1")
def cluster_size_counts(spark, sf):
    return cl.cluster_counts(vectors(spark, sf), "cluster", "alerts", "true_alerts")


Q_SQL = """, ranked AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY value) AS rn, COUNT(*) OVER (PARTITION BY feature) AS total FROM long),
    q AS (SELECT feature, p AS prob, value FROM ranked, (VALUES (0.2::DOUBLE), (0.5::DOUBLE), (0.8::DOUBLE)) v(p) WHERE rn = CEIL(total * p))"""


@query("cluster_quantiles", VEC_SQL + Q_SQL + " SELECT feature, prob, value FROM q")
def cluster_quantiles(spark, sf):
    return cl.quantiles(vectors(spark, sf), FEATURES, [0.2, 0.5, 0.8])


COMPARE_SQL = Q_SQL + """, sh AS (SELECT cluster, l.feature, AVG(CASE WHEN l.value <= lo.value THEN 1.0::DOUBLE ELSE 0 END) AS low_value,
        AVG(CASE WHEN l.value >= hi.value THEN 1.0::DOUBLE ELSE 0 END) AS high_value, AVG(CASE WHEN l.value < m.mean THEN 1.0::DOUBLE ELSE 0 END) AS smaller_than_mean,
        AVG(CASE WHEN l.value > m.mean THEN 1.0::DOUBLE ELSE 0 END) AS greater_than_mean FROM long l JOIN q lo ON lo.feature = l.feature AND lo.prob = 0.2
        JOIN q hi ON hi.feature = l.feature AND hi.prob = 0.8 JOIN (SELECT feature, AVG(value) AS mean FROM long GROUP BY 1) m ON m.feature = l.feature GROUP BY 1, 2),
    cmp AS (SELECT *, CASE WHEN high_value >= 0.3 AND low_value < 0.3 THEN 'H' WHEN high_value >= 0.3 AND greater_than_mean > smaller_than_mean THEN 'H'
        WHEN high_value < 0.3 AND low_value < 0.3 THEN 'M' ELSE 'L' END AS comparison FROM sh),
    scored AS (SELECT *, high_value - low_value + CASE comparison WHEN 'L' THEN 0 WHEN 'M' THEN 0.7 / 0.3 - 1 ELSE 0.7 / 0.3 + 0.7 / 0.3 END::DOUBLE AS comparison_score FROM cmp)"""
SHARES = ["low_value", "high_value", "smaller_than_mean", "greater_than_mean"]


@query("cluster_range_compare", VEC_SQL + COMPARE_SQL + " SELECT cluster, feature, " + ", ".join(f"ROUND({c}, 6) AS {c}" for c in [*SHARES, "comparison_score"]) + ", comparison FROM scored")
def cluster_range_compare(spark, sf):
    return rnd(cl.range_compare(vectors(spark, sf), "cluster", FEATURES), 6, *SHARES, "comparison_score")


@query("cluster_severity", VEC_SQL + COMPARE_SQL + """, r AS (SELECT cluster, feature, CASE comparison WHEN 'H' THEN (high_value + 0.0001) / 0.3 ELSE 0 END::DOUBLE AS ratio FROM cmp)
    SELECT cluster, feature, ROUND(ratio, 6) AS severity_ratio, CASE WHEN ratio >= 1.5 THEN 'Critical' WHEN ratio >= 1.2 THEN 'High' WHEN ratio >= 1.0 THEN 'Medium' ELSE 'Low' END AS severity_level FROM r""")
def cluster_severity(spark, sf):
    compared = cl.range_compare(vectors(spark, sf), "cluster", FEATURES)
    made = cl.severity(compared, {1.5: "Critical", 1.2: "High", 1.0: "Medium"}, "Low")
    return rnd(made.select("cluster", "feature", "severity_ratio", "severity_level"), 6, "severity_ratio")


BINS = 8
EDGE_SQL = f""", ext AS (SELECT feature, MIN(value) AS lo, MAX(value) AS hi, (MAX(value) - MIN(value)) / {BINS} AS width FROM long GROUP BY 1),
    edges AS (SELECT feature, CAST(i AS INT) AS i, CASE WHEN i = {BINS} THEN hi ELSE lo + i * width END AS edge FROM ext, range({BINS} + 1) r(i)),
    binned AS (SELECT l.*, CAST((SELECT COUNT(*) FROM edges e WHERE e.feature = l.feature AND e.i BETWEEN 1 AND {BINS - 1} AND l.value >= e.edge) AS INT) AS bin FROM long l)"""


@query("bucketize_equal_width", VEC_SQL + EDGE_SQL + " SELECT vec_id, " + ", ".join(
    f"CAST(MAX(CASE feature WHEN '{f}' THEN bin END) AS INT) AS {f}_bin" for f in FEATURES) + " FROM binned GROUP BY 1")
def bucketize_equal_width(spark, sf):
    df = vectors(spark, sf)
    splits = cl.equal_width_splits(df, FEATURES, BINS)
    return df.select("vec_id", *[cl.bucket(F.col(c), splits[c]).alias(f"{c}_bin") for c in splits])


HIST_SQL = EDGE_SQL + f""", cf AS (SELECT cluster, feature, COUNT(*) AS total FROM long GROUP BY 1, 2),
    hist AS (SELECT cf.cluster, cf.feature, cf.total, CAST(g.i AS INT) AS bin, COUNT(b.bin) AS n FROM cf, range({BINS}) g(i)
        LEFT JOIN binned b ON b.cluster = cf.cluster AND b.feature = cf.feature AND b.bin = g.i GROUP BY 1, 2, 3, 4)"""


def hist_of(spark, sf):
    df = vectors(spark, sf)
    splits = cl.equal_width_splits(df, FEATURES, BINS)
    return df, splits, cl.histogram(df, "cluster", FEATURES, splits)


@query("cluster_histogram", VEC_SQL + HIST_SQL + " SELECT cluster, feature, bin, CAST(total AS BIGINT) AS total, CAST(n AS BIGINT) AS n, ROUND(n / total, 6) AS density FROM hist")
def cluster_histogram(spark, sf):
    return rnd(hist_of(spark, sf)[2], 6, "density")


@query("cluster_histogram_cat", VEC_SQL + " SELECT cluster, segment AS bin, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(COUNT(*)) OVER (PARTITION BY cluster) AS BIGINT) AS total, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY cluster), 6) AS density FROM vec GROUP BY 1, 2")
def cluster_histogram_cat(spark, sf):
    return rnd(cl.categorical_histogram(vectors(spark, sf), "cluster", "segment"), 6, "density")


@query("cluster_kl", VEC_SQL + HIST_SQL + """, k AS (SELECT cluster, feature, SUM(n / total * LN((n + 0.0001) / total * (al - total) / (ba - n + 0.0001))) AS divergence
    FROM (SELECT *, SUM(n) OVER (PARTITION BY feature, bin) AS ba, SUM(n) OVER (PARTITION BY feature) AS al FROM hist) GROUP BY 1, 2)
    SELECT cluster, feature, ROUND(divergence, 6) AS divergence, ROUND(divergence / (SELECT MAX(ABS(divergence)) FROM k), 6) AS scaled FROM k""")
def cluster_kl(spark, sf):
    return rnd(cl.kl_compare(hist_of(spark, sf)[2], "cluster"), 6, "divergence", "scaled")


@query("cluster_categorical_share", VEC_SQL + """, c AS (SELECT k.cluster, s.segment, COUNT(v.vec_id) AS n FROM (SELECT DISTINCT cluster FROM vec) k CROSS JOIN (SELECT DISTINCT segment FROM vec) s
    LEFT JOIN vec v ON v.cluster = k.cluster AND v.segment = s.segment GROUP BY 1, 2), p AS (SELECT *, ROUND(n / SUM(n) OVER (PARTITION BY cluster) * 100) AS pct FROM c)
    SELECT cluster, string_agg(segment || '(' || printf('%.1f', pct) || '%)', ',' ORDER BY segment) AS shares FROM p GROUP BY 1""")
def cluster_categorical_share(spark, sf):
    return cl.categorical_share(vectors(spark, sf), "cluster", "segment")


@query("cluster_long_output", VEC_SQL + STATS_SQL + COMPARE_SQL.replace("scored AS", "sc AS") + """ SELECT 'C' || dense_rank() OVER (ORDER BY s.cluster) AS cluster_name, s.cluster, s.feature, ROUND(s.mean, 6) AS mean,
    ROUND(s.sd, 6) AS sd, c.comparison, CAST(n.size AS BIGINT) AS size FROM stats s JOIN cmp c USING (cluster, feature) JOIN (SELECT cluster, COUNT(*) AS size FROM vec GROUP BY 1) n USING (cluster)""")
def cluster_long_output(spark, sf):
    df = vectors(spark, sf)
    stats = cl.cluster_stats(df, "cluster", FEATURES).drop("min", "max")
    compared = cl.range_compare(df, "cluster", FEATURES).select("cluster", "feature", "comparison")
    sizes = df.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    return rnd(cl.named_clusters(stats.join(compared, ["cluster", "feature"]).join(sizes, "cluster"), "cluster"), 6, "mean", "sd")


@query("cluster_json_attrs", VEC_SQL + STATS_SQL + COMPARE_SQL.replace("scored AS", "sc AS") + """ SELECT cluster, '[' || string_agg('{"name":"' || feature || '","mean":"' || CAST(mean AS DECIMAL(38,4))
    || '","sd":"' || CAST(sd AS DECIMAL(38,4)) || '","min":"' || CAST(min AS DECIMAL(38,4)) || '","max":"' || CAST(max AS DECIMAL(38,4)) || '","comparison":"' || comparison || '"}', ',' ORDER BY feature) || ']' AS attributes
    FROM stats JOIN cmp USING (cluster, feature) GROUP BY 1""")
def cluster_json_attrs(spark, sf):
    df = vectors(spark, sf)
    compared = cl.range_compare(df, "cluster", FEATURES).select("cluster", "feature", "comparison")
    return cl.json_attributes(cl.cluster_stats(df, "cluster", FEATURES).join(compared, ["cluster", "feature"]), "cluster")


DETAIL_SQL = with_tables("cust", """, hs AS (SELECT o_custkey AS party, MAX(CAST(o_totalprice AS DECIMAL(18,2))) / 600000.0 AS score, COUNT(CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 1 END) AS trues FROM orders GROUP BY 1),
    h AS (SELECT nation AS cluster, segment, CAST(score AS DOUBLE) AS score, trues FROM cust JOIN hs USING (party)),
    p AS (SELECT cluster, segment, COUNT(*) AS n, SUM(score) AS s, COUNT(CASE WHEN trues > 0 THEN 1 END) AS t FROM h GROUP BY 1, 2)
    SELECT cluster, CAST(SUM(n) AS BIGINT) AS size, ROUND(SUM(s) / SUM(n), 6) AS severity_score, ROUND(SUM(t) / SUM(n), 6) AS yield_rate,
    '[' || string_agg('{"segment":"' || segment || '","size":' || n || ',"score":"' || CAST(s / n AS DECIMAL(38,4)) || '","yield":"' || CAST(t / n AS DECIMAL(38,4)) || '"}', ',' ORDER BY segment) || ']' AS segments FROM p GROUP BY 1""")


@query("cluster_details", DETAIL_SQL)
def cluster_details(spark, sf):
    history = t.load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("party")).agg(
        (F.max(t.money("o_totalprice")).cast("double") / 600000.0).alias("score"),
        F.count(F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"), True)).alias("trues"))
    df = t.customers(spark, sf).join(history, "party").withColumnRenamed("nation", "cluster")
    return rnd(cl.cluster_details(df, "cluster", "score", "trues", "segment"), 6, "severity_score", "yield_rate")


@query("ri_percentile", VEC_SQL + HIST_SQL + """, w AS (SELECT h.*, h.n / h.total AS density, a.edge AS lo, b.edge AS hi FROM hist h JOIN edges a ON a.feature = h.feature AND a.i = h.bin JOIN edges b ON b.feature = h.feature AND b.i = h.bin + 1)
    SELECT v.vec_id, v.cluster, v.feature, CASE WHEN v.value >= MAX(hi) THEN 1.0 WHEN v.value < MIN(lo) THEN 0.0 ELSE ROUND(SUM(density * LEAST(GREATEST((v.value - lo) / (hi - lo), 0), 1)), 4) END AS percentile
    FROM long v JOIN w ON w.cluster = v.cluster AND w.feature = v.feature GROUP BY 1, 2, 3, v.value""")
def ri_percentile(spark, sf):
    df, splits, hist = hist_of(spark, sf)
    values = cl.long_values(df, ["vec_id", "cluster"], FEATURES).join(cl.hist_arrays(hist, "cluster", splits), ["cluster", "feature"])
    return values.select("vec_id", "cluster", "feature", cl.hist_percentile(F.col("edges"), F.col("density"), F.col("value")).alias("percentile"))


@query("ri_profile_deviation", "WITH base AS (" + sql_features(", ".join(amt(f"direction = 'incoming-all' AND dd >= {s} AND dd < {s + 30}", f"t{s}") for s in _SHIFTS)) + ")" + """,
    m AS (SELECT *, (t30 * 0.4::DOUBLE + t60 * 0.3::DOUBLE + t90 * 0.2::DOUBLE + t120 * 0.1::DOUBLE + t150 * 0.1::DOUBLE) / 5 AS pm FROM base)
    SELECT party, ref_date, ROUND(pm, 4) AS profile_mean, ROUND(100 * (t0 - pm) / (pm + 0.0001::DOUBLE), 2) AS profile_deviation, '[' || """ + " || ',' || ".join(
    f"""'{{"range":"{s}","value":"' || CAST(t{s} AS DECIMAL(38,2)) || '"}}'""" for s in _SHIFTS) + " || ']' AS amounts FROM m")
def ri_profile_deviation(spark, sf):
    base = parse_first("incoming-all_30DAY_AMT", CATEGORIES)
    specs = [base.shifted(s, f"t{s}") for s in _SHIFTS]
    made = lookback_features(t.transactions(spark, sf), t.reference_points(t.alerts(spark, sf)), specs)
    cols = cl.profile(made, {s: f"t{s}" for s in _SHIFTS}, {30: 0.4, 60: 0.3, 90: 0.2, 120: 0.1, 150: 0.1})
    out = made.select("party", "ref_date", *cols)
    return rnd(rnd(out, 4, "profile_mean"), 2, "profile_deviation")


BINS_SQL = HIST_SQL + """, w AS (SELECT h.cluster, h.feature, h.bin, h.n / h.total AS density, a.edge AS lo, b.edge AS hi FROM hist h
    JOIN edges a ON a.feature = h.feature AND a.i = h.bin JOIN edges b ON b.feature = h.feature AND b.i = h.bin + 1)"""


@query("ri_bins_json", VEC_SQL + BINS_SQL + """ SELECT cluster, feature, '[' || string_agg('{"range":"(' || CAST(lo AS DECIMAL(38,4)) || ', ' || CAST(hi AS DECIMAL(38,4)) || ')","value":"' || CAST(density AS DECIMAL(38,4)) || '"}', ',' ORDER BY bin) || ']' AS bins FROM w GROUP BY 1, 2""")
def ri_bins_json(spark, sf):
    _, splits, hist = hist_of(spark, sf)
    return cl.hist_arrays(hist, "cluster", splits).select("cluster", "feature", cl.bins_to_json(F.col("edges"), F.col("density")).alias("bins"))


@query("ri_bins_parse", VEC_SQL + BINS_SQL + """ SELECT cluster, feature, bin, CAST(CAST(lo AS DECIMAL(38,4)) AS DOUBLE) AS lo, CAST(CAST(hi AS DECIMAL(38,4)) AS DOUBLE) AS hi, CAST(CAST(density AS DECIMAL(38,4)) AS DOUBLE) AS density FROM w""")
def ri_bins_parse(spark, sf):
    made = ri_bins_json(spark, sf)
    edges, density = cl.bins_from_json(F.col("bins"))
    parsed = made.select("cluster", "feature", edges.alias("edges"), density.alias("ds"))
    return parsed.select("cluster", "feature", "edges", F.posexplode("ds").alias("bin", "density")).select(
        "cluster", "feature", "bin", F.element_at("edges", F.col("bin") + 1).alias("lo"), F.element_at("edges", F.col("bin") + 2).alias("hi"), "density")


NEAR, EPS, MIN_PTS = [f"f{i}" for i in range(8)], 2.2, 18          # 2 d + 2 rows make a core
Z = ", ".join(f"({f} - (SELECT AVG({f}) FROM vec)) / (SELECT STDDEV_SAMP({f}) FROM vec) AS z{i}" for i, f in enumerate(NEAR))
NEAR_SQL = f""", z AS (SELECT vec_id, {Z} FROM vec),
    d AS (SELECT a.vec_id AS a, b.vec_id AS b, {" + ".join(f"(a.z{i} - b.z{i}) * (a.z{i} - b.z{i})" for i in range(len(NEAR)))} AS d2 FROM z a, z b)"""


@query("density_cluster", VEC_SQL.replace("WITH vec", "WITH RECURSIVE vec") + NEAR_SQL + f""", near AS (SELECT a, b FROM d WHERE d2 <= {EPS}::DOUBLE * {EPS}::DOUBLE),
    core AS (SELECT a FROM near GROUP BY 1 HAVING COUNT(*) >= {MIN_PTS}),
    ce AS (SELECT a, b FROM near WHERE a IN (SELECT a FROM core) AND b IN (SELECT a FROM core)),
    reach(a, root) AS (SELECT a, a FROM core UNION SELECT ce.b, r.root FROM reach r JOIN ce ON ce.a = r.a WHERE r.root < ce.b),
    comp AS (SELECT a, MIN(root) AS cluster FROM reach GROUP BY 1),
    border AS (SELECT n.a, MIN(c.cluster) AS cluster FROM near n JOIN comp c ON c.a = n.b GROUP BY 1)
    SELECT z.vec_id, COALESCE(comp.cluster, border.cluster, -1) AS cluster FROM z LEFT JOIN comp ON comp.a = z.vec_id LEFT JOIN border ON border.a = z.vec_id""")
def density_cluster(spark, sf):
    return dn.density_cluster(vectors(spark, sf), "vec_id", NEAR, EPS, MIN_PTS)


@query("kdist_curve", VEC_SQL + NEAR_SQL + f""", k AS (SELECT a, d2 FROM (SELECT a, d2, row_number() OVER (PARTITION BY a ORDER BY d2) AS rn FROM d) WHERE rn = {MIN_PTS} + 1),
    c AS (SELECT ROUND(SQRT(d2), 6) AS distance, COUNT(*) AS n FROM k GROUP BY 1)
    SELECT distance, CAST(n AS BIGINT) AS n, CAST(SUM(n) OVER (ORDER BY distance) - n AS BIGINT) AS before FROM c""")
def kdist_curve(spark, sf):
    """The sorted curve as steps: distance, how many rows have it, how many have less."""
    made = dn.kth_distance(vectors(spark, sf), "vec_id", NEAR, MIN_PTS).select("vec_id", F.round(F.sqrt("d2"), 6).alias("distance"))
    return ranked_values(made, ["distance"]).select(F.col("value").alias("distance"), "n", "before")


def over(template: str, by: str = " + ") -> str:
    """The template for each feature number, joined."""
    return by.join(template.replace("#", str(i)) for i in range(len(FEATURES)))


@query("cluster_quality", VEC_SQL + f""", c AS (SELECT cluster, COUNT(*) AS n, {over("AVG(f#) AS m#", ", ")}, SUM({over("f#*f#")}) AS sq, {over("SUM(f#) AS s#", ", ")} FROM vec GROUP BY 1),
    g AS (SELECT {over("AVG(f#) AS g#", ", ")}, COUNT(*) AS n FROM vec),
    pt AS (SELECT v.vec_id, v.cluster AS own, c.cluster AS other, c.n, ({over("v.f#*v.f#")}) * c.n + c.sq - 2 * ({over("v.f#*s#")}) AS total FROM vec v, c),
    ab AS (SELECT vec_id, MAX(CASE WHEN own = other THEN n END) AS own_n, MAX(CASE WHEN own = other THEN total / (n - 1) END) AS a, MIN(CASE WHEN own <> other THEN total / n END) AS b FROM pt GROUP BY 1),
    sil AS (SELECT AVG(CASE WHEN own_n = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END) AS s FROM ab),
    dd AS (SELECT v.cluster, SUM(dsq) AS w, AVG(SQRT(dsq)) AS s FROM (SELECT v.cluster, {over("(f#-m#)*(f#-m#)")} AS dsq FROM vec v JOIN c USING (cluster)) v GROUP BY 1),
    ch AS (SELECT (SUM(c.n * ({over("(m#-g#)*(m#-g#)")})) / (COUNT(*) - 1)) / (SUM(w) / (MAX(g.n) - COUNT(*))) AS ch FROM c JOIN dd USING (cluster), g),
    db AS (SELECT AVG(r) AS db FROM (SELECT a.cluster, MAX((da.s + ds.s) / SQRT({over("(a.m#-b.m#)*(a.m#-b.m#)")})) AS r
        FROM c a JOIN c b ON a.cluster <> b.cluster JOIN dd da ON da.cluster = a.cluster JOIN dd ds ON ds.cluster = b.cluster GROUP BY 1))
    SELECT ROUND(s, 6) AS silhouette, ROUND(ch, 6) AS calinski_harabasz, ROUND(db, 6) AS davies_bouldin FROM sil, ch, db""")
def cluster_quality(spark, sf):
    return rnd(cl.cluster_quality(vectors(spark, sf), "cluster", FEATURES), 6, "silhouette", "calinski_harabasz", "davies_bouldin")


@query("rand_index", VEC_SQL + """, x AS (SELECT cluster AS a, vec_id * 3 % 8 AS b FROM vec), p AS (SELECT (SELECT SUM(n * (n - 1) / 2) FROM (SELECT COUNT(*) AS n FROM x GROUP BY a, b)) AS in_both,
    (SELECT SUM(n * (n - 1) / 2) FROM (SELECT COUNT(*) AS n FROM x GROUP BY a)) AS in_a, (SELECT SUM(n * (n - 1) / 2) FROM (SELECT COUNT(*) AS n FROM x GROUP BY b)) AS in_b,
    (SELECT COUNT(*) * (COUNT(*) - 1) / 2 FROM x) AS total) SELECT in_both, in_a, in_b, ROUND((total + 2 * in_both - in_a - in_b) / total, 6) AS rand_index FROM p""")
def rand_index(spark, sf):
    return rnd(cl.rand_index(vectors(spark, sf).select(F.col("cluster").alias("a"), (F.col("vec_id") * 3 % 8).alias("b")), "a", "b"), 6, "rand_index")

"""Queries over train / validation splits and samples."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from riskspark.operators import sampling as sp
from riskspark.plans.base_sql import with_tables
from riskspark.plans.registry import query
from riskspark.sources import tables as t

OUT = ["id", "is_valid"]
HASH = "md5(CAST(id AS VARCHAR)), id"


@query("sample_random", with_tables("scored", f"SELECT id, row_number() OVER (ORDER BY {HASH}) <= CEIL(COUNT(*) OVER () * 20.0 / 100) AS is_valid FROM scored"))
def sample_random(spark, sf):
    return sp.split_random(t.scored_alerts(spark, sf), "id", 20.0).select(OUT)


def strat_sql(source: str, pct: float) -> str:
    return f"SELECT id, row_number() OVER (PARTITION BY label ORDER BY {HASH}) <= FLOOR(COUNT(*) OVER (PARTITION BY label) * {pct} / 100 + 0.5) AS is_valid FROM {source}"


@query("sample_stratified", with_tables("scored", strat_sql("scored", 30.0)))
def sample_stratified(spark, sf):
    return sp.split_stratified(t.scored_alerts(spark, sf), "id", 30.0, "label").select(OUT)


CUT = "(SELECT MAX(run_date) FROM scored) - {days}"


@query("sample_lookback", with_tables("scored", f", recent AS (SELECT * FROM scored WHERE run_date > {CUT.format(days=180)}) {strat_sql('recent', 40.0)} UNION ALL SELECT id, FALSE FROM scored WHERE run_date <= {CUT.format(days=180)}"))
def sample_lookback(spark, sf):
    return sp.split_lookback(t.scored_alerts(spark, sf), "id", 40.0, "label", "run_date", 6.0).select(OUT)


MEMORY_SQL = f""", part AS (SELECT *, CASE WHEN segment = '3-MEDIUM' AND run_date > {CUT.format(days=360)} THEN 'old'
        WHEN run_date > DATE '2001-03-01' THEN 'fresh' ELSE 'rest' END AS p FROM scored),
    fresh AS (SELECT * FROM part WHERE p = 'fresh'), old AS (SELECT * FROM part WHERE p = 'old'),
    res AS ({strat_sql('fresh', 25.0)} UNION ALL {strat_sql('old', 80.0)} UNION ALL SELECT id, FALSE FROM part WHERE p = 'rest')"""


@query("sample_lookback_memory", with_tables("scored", MEMORY_SQL + " SELECT id, is_valid FROM res"))
def sample_lookback_memory(spark, sf):
    df = t.scored_alerts(spark, sf)
    return sp.split_memory(df, "id", 25.0, "label", "run_date", 12.0, df.filter("segment = '3-MEDIUM'"), date(2001, 3, 1), 80.0).select(OUT)


@query("sample_mode_fallback", with_tables("scored", f", recent AS (SELECT * FROM scored WHERE run_date > {CUT.format(days=720)}), res AS ({strat_sql('recent', 45.0)} UNION ALL SELECT id, FALSE FROM scored WHERE run_date <= {CUT.format(days=720)}) SELECT id, is_valid, 'lookback' AS mode FROM res"))
def sample_mode_fallback(spark, sf):
    """Memory is asked for, but no former validation alerts exist; 60 percent is above the
    allowed maximum."""
    df = t.scored_alerts(spark, sf)
    made, mode, _ = sp.split(df, "lookback_memory", sp.SplitParams("id", "label", "run_date", valid_pct=60.0, months=24.0))
    return made.select(*OUT, F.lit(mode).alias("mode"))


@query("sample_by_fraction", with_tables("cust", """, n AS (SELECT region, COUNT(*) AS n FROM cust GROUP BY 1)
    SELECT party, region FROM cust JOIN n USING (region) WHERE ('0x' || substr(md5(CAST(party AS VARCHAR) || 'strata'), 1, 8))::BIGINT / 4294967296.0::DOUBLE < CASE WHEN n < 290 THEN 1.0::DOUBLE ELSE n / (SELECT COUNT(*) FROM cust) / 0.4::DOUBLE END"""))
def sample_by_fraction(spark, sf):
    return sp.sample_strata(t.customers(spark, sf).select("party", "region"), "party", "region", 0.4, keep_below=290)


@query("sample_apply", with_tables("scored", f""", v AS (SELECT id FROM ({strat_sql('scored', 30.0)}) WHERE is_valid)
    SELECT 'train' AS part, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(label) AS BIGINT) AS trues FROM scored WHERE id NOT IN (SELECT id FROM v)
    UNION ALL SELECT 'challenger', COUNT(*), SUM(label) FROM scored WHERE id IN (SELECT id FROM v) UNION ALL SELECT 'champion', COUNT(*), SUM(label) FROM scored WHERE id IN (SELECT id FROM v) AND score >= 0.3"""))
def sample_apply(spark, sf):
    df = t.scored_alerts(spark, sf)
    valid = sp.split_stratified(df, "id", 30.0, "label").filter("is_valid")
    parts = sp.apply_split(df, df.filter("score >= 0.3"), valid, "id")
    out = None
    for name, part in zip(("train", "challenger", "champion"), parts):
        row = part.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("trues")).select(F.lit(name).alias("part"), "n", "trues")
        out = row if out is None else out.unionByName(row)
    return out

"""Rows at the edges: without dates, of any script, empty and infinite columns, texts under numeric rules."""

from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from riskspark.functions import names as nm
from riskspark.operators import branches, clusters, enrich, explain, features as ft, lookback as lb, ranks, rules as ru, sampling as sp

DAY = date(2001, 6, 30)


def scored(spark, n=400):
    rows = [(i, i % 3 == 0, None if i % 10 == 0 else DAY - timedelta(days=i)) for i in range(n)]
    return spark.createDataFrame([(i, int(y), d) for i, y, d in rows], "id long, label int, d date")


def parts(df):
    return Counter(r.is_valid for r in df.collect()), {r.id for r in df.collect()}


def test_lookback_split_keeps_rows_without_date(spark):
    df = scored(spark)
    got, ids = parts(sp.split_lookback(df, "id", 50.0, "label", "d", 3.0))
    assert sum(got.values()) == 400 == len(ids) and got[True] == 41            # half of 81 dated rows of 90 days, by label
    assert sp.split_lookback(df, "id", 100.0, "label", "d", 3.0).filter("is_valid AND d IS NULL").count() == 0


def test_memory_split_keeps_newer_former_rows(spark):
    df = scored(spark)
    former = df.filter("id % 2 = 0")
    out = sp.split_memory(df, "id", 25.0, "label", "d", 6.0, former, DAY - timedelta(days=100), 80.0)
    got, ids = parts(out)
    assert sum(got.values()) == 400 == len(ids)
    newer = out.filter((F.col("d") > F.lit(DAY - timedelta(days=100))) & (F.col("id") % 2 == 0))
    assert newer.filter("is_valid").count() > 0
    all_stay = sp.split_memory(df, "id", 25.0, "label", "d", 6.0, former, DAY, 80.0)
    kept = all_stay.filter((F.col("id") % 2 == 0) & (F.col("d") > F.lit(DAY - timedelta(days=180))))
    assert kept.filter("NOT is_valid").count() == 0 and kept.count() > 0


def test_share_widens_without_a_loop(spark):
    rows = [(i, i % 2, DAY if i < 3 else DAY - timedelta(days=700)) for i in range(100)] + [(1000 + i, 0, None) for i in range(5000)]
    df = spark.createDataFrame(rows, "id long, label int, d date")
    months, pct = sp._lookback_share(df, sp.SplitParams("id", "label", "d"), 1.0, DAY)
    assert (DAY - timedelta(days=int(months * 30))) < DAY - timedelta(days=700) <= DAY - timedelta(days=int((months - 1) * 30))
    assert pct == 20.0
    mode, _ = sp.resolve_mode(df.withColumn("d", F.lit(None).cast("date")), "lookback", sp.SplitParams("id", "label", "d"))
    assert mode == "stratified"


@pytest.mark.parametrize("raw,plain", [("José  Núñez-Ögur", "JOSE NUNEZ OGUR"), ("José", "JOSE"), ("王小明", "王小明"), ("Иван Петров!", "ИВАН ПЕТРОВ"), ("--", None), ("", None), (None, None)])
def test_names_of_any_script(spark, raw, plain):
    df = spark.createDataFrame([(raw,)], "n string")
    assert df.select(nm.normalise(F.col("n"))).first()[0] == plain


def test_longest_common_run(spark):
    cases = [("banana", "ananas", 5 / 6), ("abc", "xyz", 0.0), ("a", "", 0.0), ("", "", None), (None, "a", None), ("xabcy", "zzabcz", 0.5), ("漢字漢", "字漢字", 2 / 3)]
    df = spark.createDataFrame([c[:2] for c in cases], "a string, b string")
    assert [r[0] for r in df.select(nm.subset_ratio(F.col("a"), F.col("b"))).collect()] == [pytest.approx(c[2]) if c[2] is not None else None for c in cases]


def test_ranks_of_empty_and_infinite_columns(spark):
    rows = [(None, float("inf"), 1.0), (None, float("-inf"), 1.0), (None, 2.0, 1.0), (None, 3.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.feature, r.value): r.before for r in ranks.ranked_values(df, ["a", "b", "c"]).collect()}
    assert got == {("b", float("-inf")): 0, ("b", 2.0): 1, ("b", 3.0): 2, ("b", float("inf")): 3, ("c", 1.0): 0}
    assert ranks.quantile_lists(df, ["a", "c"], [0.5]) == {"a": [None], "c": [1.0]}
    assert [ranks.range_count(n) for n in (0, 10**6, 10**12, 10**16)] == [16, 32, 31623, 65536]


def test_pair_counts_do_not_overflow(spark):
    cells = spark.range(1).select(F.lit("a").alias("a"), F.lit("b").alias("b"))
    assert clusters.rand_index(cells, "a", "b").first()["in_both"] == 0.0
    from riskspark.operators import assoc

    big = spark.createDataFrame([("f", "g", x, y, 4 * 10**9) for x in "ab" for y in "cd"], "f1 string, f2 string, a string, b string, n long")
    assert assoc.cramers_from_cells(big).first()["r"] == pytest.approx(0.0, abs=1e-3)


def test_numeric_rules_on_texts(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "v string")
    for condition, value, want in ((">", "5", [True, False, False]), ("==", "12", [True, False, False]), ("IN BETWEEN", "1,20", [True, False, False])):
        rule = ru.Rule("r", "Static", "i", condition, value, "v", 1.0)
        assert [r[0] for r in df.select(ru.hit(rule, df.columns)).collect()] == want


def test_outer_merge(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (None, "n")], "k long, a string")
    b = spark.createDataFrame([(2, 5), (3, 6), (None, 7)], "k long, b int")
    got = {tuple(r) for r in enrich.outer_all([a, b], "k").collect()}
    assert got == {(1, "x", None), (2, None, 5), (3, None, 6), (None, "n", None), (None, None, 7)}
    with pytest.raises(Exception, match="twice"):
        enrich.outer_all([a.union(a), b], "k").collect()


def test_facts_are_cut_before_they_are_summed(spark):
    facts = spark.createDataFrame([(1, DAY), (1, DAY - timedelta(days=500)), (2, DAY)], "party long, txn_date date")
    refs = spark.createDataFrame([(1, DAY)], "party long, ref_date date")
    assert [tuple(r) for r in lb.referenced(facts, refs, 360).collect()] == [(1, DAY)]
    assert lb.referenced(facts, refs.limit(0), 360).count() == 0


def test_tokens_of_feature_names():
    spec = ft.parse_first("all_90DAY_20kto30k_greater-than-7k_VOL_ACCOUNT", {"all": []}, level="ACCOUNT")
    assert spec.flags == ("amount_20k_30k", "amount_over_7k")
    with pytest.raises(ValueError, match="level"):
        ft.parse_first("all_90DAY_VOL_ACCOUNT", {"all": []}, level="CUSTOMER")
    assert not explain.needs_breakdown("internet-card_90DAY_AMT", {"card": ["card"]})
    assert explain.needs_breakdown("net_in_90DAY_AMT_out_90DAY_AMT", {}) and explain.needs_breakdown("card_90DAY_AMT", {"card": ["a", "b"]})


def test_class_probabilities(spark):
    df = spark.createDataFrame([(0.4,)], "p1 double")
    assert branches.ensure_prob(df, "p0", "p1", 0.2).first().asDict() == {"p1": 0.4, "p0": 0.2}
    with pytest.raises(ValueError):
        branches.ensure_prob(df, "x", "y")

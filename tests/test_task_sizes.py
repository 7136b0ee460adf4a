"""Work is dealt out to a number of tasks that grows with the rows."""

import datetime as dt

from pyspark.sql import functions as F

from riskspark.operators import features as ft
from riskspark.operators import lookback as lb
from riskspark.operators.metric import Cells
from riskspark.sources import generate as gen
from riskspark.sources.session import ensure_checkpoint_dir

DAY0 = dt.date(2020, 1, 1)


def test_facts_of_many_references_meet_in_many_tasks(spark, monkeypatch):
    day = lambda c: F.date_add(F.lit(DAY0), c.cast("int"))
    key = F.when(F.col("id") % 5 > 0, F.col("id") % 40)                       # a fifth has no key
    facts = spark.range(2000).select(key.alias("party"), day(F.col("id") % 300).alias("txn_date"), (F.col("id") % 7).alias("amount"), (F.col("id") % 11).alias("opp"))
    refs = spark.range(100).select((F.col("id") % 50).alias("party"), day(F.col("id") * 3).alias("ref_date"))
    specs = [lb.Spec("a", "AMT", 90), lb.Spec("m", "MAX", 30, 7)]
    made = lambda: (sorted(map(str, lb.lookback_features(facts, refs, specs).collect())),
                    sorted(map(str, lb.distinct_in_lookback(facts, refs, "opp", [lb.DistinctSpec("d", 60)]).collect())))
    few = made()
    monkeypatch.setattr(lb, "MANY_POINTS", 50)
    monkeypatch.setattr(lb, "POINTS_OF_A_TASK", 4)
    assert lb.referenced(facts, refs, 90).rdd.getNumPartitions() == 25
    assert made() == few


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_of_several_passes_are_joined_once(spark, monkeypatch):
    """Totals, steps and distinct values read one stored view, and no step is shuffled."""
    day = lambda c: F.date_add(F.lit(DAY0), c.cast("int"))
    opp = F.col("id") % 11
    facts = spark.range(2000).select(
        F.when(F.col("id") % 5 > 0, F.col("id") % 40).alias("party"), day(F.col("id") % 300).alias("txn_date"), (F.col("id") % 7).cast("decimal(18,2)").alias("amount"),
        F.when(F.col("id") % 3 == 0, "in").otherwise("out").alias("direction"), opp.alias("opp_party"), (opp * 10).alias("opp_account"),
        F.when(opp != 5, F.date_add(F.lit(dt.date(2000, 1, 1)), (opp * 40).cast("int"))).alias("birth_date"))
    refs = spark.range(100).select((F.col("id") % 50).alias("party"), day(F.col("id") * 3).alias("ref_date"))
    names = ["all_180DAY_OPP-PARTY-AGE-UNDER-20_AMT_CUSTOMER", "in_90DAY_OFFSET_30DAY_OPP-PARTY-AGE-UNDER-20_VOL_CUSTOMER", "all_90DAY_OPP-PARTY-AGE-UNDER-20_MAX_CUSTOMER",
             "all_60DAY_DISTINCT-COUNT_CUSTOMER", "in_30DAY_SD_CUSTOMER", "in_180DAY_TXN-GAP_AVG_CUSTOMER"]
    source = ft.Source(facts, "txn_date", {"CUSTOMER": "party"}, "amount")

    def made(asked):
        return ft.mixed_matrix({"transactions": source}, refs, asked, {"all": [], "in": ["in"]}, {"CUSTOMER": "party"})

    read = "Range (0, 2000"
    assert plan_of(made(names)).count(read) == 0 and plan_of(made(names[:1])).count(read) == 1
    rows = lambda df: sorted(map(str, df.collect()))
    few, apart = rows(made(names)), [rows(made([n])) for n in names]
    monkeypatch.setattr(lb, "MANY_POINTS", 50)
    monkeypatch.setattr(lb, "POINTS_OF_A_TASK", 4)
    assert rows(made(names)) == few and [rows(made([n])) for n in names] == apart
    assert [rows(made(names).select("party", "ref_date", n)) for n in names] == apart
    distinct = lb.distinct_in_lookback(facts, refs, "opp_party", [lb.DistinctSpec("d", 60)])
    assert plan_of(distinct).count("ENSURE_REQUIREMENTS") <= 1          # the keys of the points


def test_generated_rows_come_from_many_tasks(spark):
    few = spark.range(25_000, numPartitions=1).select(F.col("id").alias("party"))
    made = gen.transactions(gen.accounts(few))
    assert made.rdd.getNumPartitions() == 3
    one = gen.transactions(gen.accounts(few.filter("party < 50")))
    assert sorted(map(str, made.filter("party < 50").collect())) == sorted(map(str, one.collect()))


def test_the_own_cell_bounds_where_a_point_looks(spark):
    """A bound of its own sends a point into fewer cells than the nearest points of all pivots do."""
    ensure_checkpoint_dir(spark)
    points = spark.range(3000).select("id", F.array(F.rand(1) * 9, F.rand(2) * 9, F.rand(3) * 9).alias("x"), F.lit(1).cast("long").alias("w")).checkpoint()
    cells = Cells(points, first=3)
    far = cells.visits(cells.points, k=3).count()
    near = cells.visits(cells.points.withColumn("bound", F.lit(0.1)), k=3, bound="bound").count()
    unbounded = cells.visits(cells.points.withColumn("bound", F.lit(None).cast("double")), k=3, bound="bound").count()
    assert 3000 <= near < far / 2 and unbounded == far

"""Exact ranks, charts and splits with heavy ties and hot strata, against brute force."""

import datetime as dt
import hashlib
import random
from collections import Counter
from math import ceil, floor

import pytest

from riskspark.operators import deciles as dc
from riskspark.operators import ranks
from riskspark.operators import sampling as sp


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(3)
    rows = [(i, 0.5 if i % 3 == 0 else round(rnd.random(), 2), int(rnd.random() < 0.3)) for i in range(1000)]
    return rows, spark.createDataFrame(rows, "id int, score double, label int")


def brute_chart(rows, bins, descending, ntile):
    order = sorted(rows, key=lambda r: (-r[1] if descending else r[1], -r[2]))
    n, out = len(order), {}
    for rank, r in enumerate(order, 1):
        if ntile:
            q, rem = divmod(n, bins)
            b = ceil(rank / (q + 1)) if rank <= rem * (q + 1) else rem + ceil((rank - rem * (q + 1)) / q)
        else:
            b = -(-rank * bins // n)
        out.setdefault(b, []).append(r)
    return {b: (len(v), sum(r[2] for r in v), min(r[1] for r in v), max(r[1] for r in v)) for b, v in out.items()}


@pytest.mark.parametrize("bins,descending,rule", [(10, True, "row_number"), (7, True, "row_number"), (100, False, "ntile"), (64, False, "ntile")])
def test_charts(scored, bins, descending, rule):
    rows, df = scored
    chart = dc.decile_chart(df, bins, rule=rule, descending=descending).collect()
    got = {r.decile: (r.total_rows, r.true_alerts, r.min_score, r.max_score) for r in chart}
    assert got == brute_chart(rows, bins, descending, rule == "ntile")
    assert max(r.cum_total for r in chart) == len(rows)


def test_more_bins_than_rows(spark):
    df = spark.createDataFrame([(1, 0.1, 0), (2, 0.2, 1), (3, 0.3, 1)], "id int, score double, label int")
    got = dc.decile_chart(df, 10, rule="ntile", descending=False).orderBy("decile").collect()
    assert [(r.decile, r.total_rows) for r in got] == [(1, 1), (2, 1), (3, 1)]


def test_several_columns_and_nulls(spark):
    rows = [(float(i % 5), None if i % 2 else float(i)) for i in range(50)]
    got = ranks.ranked_values(spark.createDataFrame(rows, "a double, b double"), ["a", "b"]).collect()
    a = {r.value: (r.n, r.before, r.total) for r in got if r.feature == "a"}
    assert a == {float(v): (10, 10 * v, 50) for v in range(5)}
    assert sum(r.n for r in got if r.feature == "b") == 25


def test_quantiles(scored):
    rows, df = scored
    values = sorted(r[1] for r in rows)
    got = ranks.quantile_lists(df, ["score"], [0.1, 0.25, 0.5, 0.99])["score"]
    assert got == [values[ceil(len(values) * p) - 1] for p in (0.1, 0.25, 0.5, 0.99)]


def test_missing_cutoff_turns_conservative(spark):
    rows = [(i, i / 100, 1 if i > 97 or i < 3 else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, score double, label int")
    got = dc.tuned(dc.decile_chart(df, 10), 10).first()
    assert got.conservative and got.high > got.low


def ordered(ids):
    return sorted(ids, key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))


def test_splits(scored, spark):
    rows, df = scored
    got = {r.id for r in sp.split_random(df, "id", 20.0).filter("is_valid").collect()}
    assert got == set(ordered([r[0] for r in rows])[:ceil(len(rows) * 0.2)])
    strat = {r.id for r in sp.split_stratified(df, "id", 30.0, "label").filter("is_valid").collect()}
    want = set()
    for label in (0, 1):
        ids = ordered([r[0] for r in rows if r[2] == label])
        want |= set(ids[:floor(len(ids) * 0.3 + 0.5)])
    assert strat == want
    one_class = df.filter("label = 0")
    assert Counter(r.is_valid for r in sp.split_stratified(one_class, "id", 50.0, "label").collect())[True] == ceil(one_class.count() / 2)


def test_mode_fallback(spark):
    rows = [(i, i % 2, dt.date(2020, 1, 1) + dt.timedelta(days=i)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, label int, day date")
    p = sp.SplitParams("id", "label", "day", valid_pct=30.0, months=3.0)
    assert sp.resolve_mode(df, "lookback_memory", p)[0] == "lookback"
    assert sp.resolve_mode(df, "lookback", sp.SplitParams("id", "label", "nothing", 30.0))[0] == "stratified"
    assert sp.resolve_mode(df.withColumn("label", df.label * 0), "stratified", p)[0] == "random"
    previous = df.filter("id between 350 and 360")
    mode, q = sp.resolve_mode(df, "lookback_memory", sp.SplitParams("id", "label", "day", 99.0, 3.0, previous, dt.date(2021, 1, 1)))
    assert (mode, q.valid_pct, q.months) == ("lookback_memory", 45.0, 3.0)
    made, _, _ = sp.split(df, "lookback_memory", q)
    valid = {r.id for r in made.filter("is_valid").collect()}
    assert set(range(350, 361)) <= valid and made.count() == 400
    with pytest.raises(ValueError):
        sp.resolve_mode(df, "lookback_memory", sp.SplitParams("id", "label", "day", 30.0, 3.0, previous, dt.date(2030, 1, 1)))

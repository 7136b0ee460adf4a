"""Look-back operators against brute force, with a party that holds a third of all rows."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from riskspark.operators import enrich
from riskspark.operators import features as ft
from riskspark.operators import lookback as lb
from riskspark.operators import static

DAY0 = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(5)
    facts = []
    for i in range(900):
        party = 0 if i % 3 == 0 else rnd.randint(1, 25)
        facts.append((party, DAY0 + dt.timedelta(days=rnd.randint(0, 700)), rnd.randint(1, 900), rnd.choice(["in", "out"]), rnd.randint(1, 6)))
    refs = sorted({(rnd.choice([0, 0, *range(1, 28)]), DAY0 + dt.timedelta(days=rnd.randint(0, 720))) for _ in range(120)})
    f = spark.createDataFrame(facts, "party int, txn_date date, amount int, direction string, opp int").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    r = spark.createDataFrame(refs, "party int, ref_date date")
    return facts, refs, f, r


def inside(facts, party, ref, days, offset=0, cat=None):
    return [x for x in facts if x[0] == party and offset <= (ref - x[1]).days < days and (cat is None or x[3] == cat)]


def test_sums_counts_max_spread(data):
    facts, refs, f, r = data
    specs = [lb.Spec("amt", "AMT", 90), lb.Spec("vol", "VOL", 360, 30, ("in",)), lb.Spec("top", "MAX", 180), lb.Spec("sd", "SD", 360), lb.Spec("day", "VOL", 1)]
    got = {(x.party, x.ref_date): x for x in lb.lookback_features(f, r, specs).collect()}
    assert len(got) == len(refs)
    for party, ref in refs:
        x = got[party, ref]
        assert x.amt == sum(v[2] for v in inside(facts, party, ref, 90))
        assert x.vol == len(inside(facts, party, ref, 360, 30, "in"))
        assert x.top == max((v[2] for v in inside(facts, party, ref, 180)), default=None)
        assert x.day == len(inside(facts, party, ref, 1))
        values = [v[2] for v in inside(facts, party, ref, 360)]
        assert x.sd == pytest.approx(statistics.stdev(values), rel=1e-9) if len(values) > 1 else x.sd is None


def test_window_borders(spark):
    ref = dt.date(2021, 6, 30)
    rows = [(1, ref - dt.timedelta(days=d), 1) for d in (-1, 0, 1, 29, 30, 359, 360)]
    f = spark.createDataFrame(rows, "party int, txn_date date, amount int")
    r = spark.createDataFrame([(1, ref), (2, ref)], "party int, ref_date date")
    specs = [lb.Spec("d1", "VOL", 1), lb.Spec("d30", "VOL", 30), lb.Spec("d360", "VOL", 360), lb.Spec("off", "VOL", 360, 30)]
    got = {x.party: (x.d1, x.d30, x.d360, x.off) for x in lb.lookback_features(f, r, specs).collect()}
    assert got == {1: (1, 3, 5, 2), 2: (0, 0, 0, 0)}
    inner = lb.lookback_join(f, r, "txn_date", days=360)
    assert sorted(x.days_before for x in inner.collect()) == [0, 1, 29, 30, 359]
    right = lb.lookback_join(f, r, "txn_date", days=30, how="right")
    assert sorted((x.party, x.days_before if x.days_before is not None else -9) for x in right.collect()) == [(1, 0), (1, 1), (1, 29), (2, -9)]


def test_distinct_counts(data):
    facts, refs, f, r = data
    specs = [lb.DistinctSpec("a", 30), lb.DistinctSpec("b", 360), lb.DistinctSpec("c", 180, 30, "direction = 'in'"), lb.DistinctSpec("d", 1)]
    got = {(x.party, x.ref_date): x for x in lb.distinct_in_lookback(f, r, "opp", specs).collect()}
    assert len(got) == len(refs)
    for party, ref in refs:
        x = got[party, ref]
        want = [len({v[4] for v in inside(facts, party, ref, *w)}) for w in ((30,), (360,), (180, 30, "in"), (1,))]
        assert [x.a, x.b, x.c, x.d] == want


def test_gaps(data):
    facts, refs, f, r = data
    got = {(x.party, x.ref_date): x for x in lb.gap_features(f, r, [90, 180]).collect()}
    for party, ref in refs:
        for w in (90, 180):
            days = sorted({v[1] for v in inside(facts, party, ref, w)})
            gaps = [(b - a).days for a, b in zip(days, days[1:])]
            mean, sd = got[party, ref][f"TXN-GAP_{w}DAY_AVG"], got[party, ref][f"TXN-GAP_{w}DAY_SD"]
            assert mean == (pytest.approx(statistics.mean(gaps)) if gaps else None)
            assert sd == (pytest.approx(statistics.stdev(gaps), abs=1e-9) if len(gaps) > 1 else None)


def test_skew_safe_aggregate_equals_plain(data):
    facts, _, f, _ = data
    got = {x.party: x for x in lb.skew_safe_agg(f, "party", "amount", "opp").collect()}
    for party in {v[0] for v in facts}:
        rows = [v for v in facts if v[0] == party]
        x = got[party]
        assert (x.vol, x.amt, x.max, x.distinct_count) == (len(rows), sum(v[2] for v in rows), max(v[2] for v in rows), len({v[4] for v in rows}))
        assert x.sd == (pytest.approx(statistics.stdev([v[2] for v in rows])) if len(rows) > 1 else None)


def test_plan_shares_first_level():
    plan = ft.plan_features(["in_90DAY_AVG", "in_3MONTH_MONTHLY_AVG", "ratio_in_90DAY_AMT_in_180DAY_OFFSET_30DAY_AMT_CUSTOMER", "TXN-GAP_30DAY_AVG"], {"in": ["in"]})
    assert [s.name for s in plan.first] == ["in_90DAY_AMT", "in_90DAY_VOL", "in_180DAY_OFFSET_30DAY_AMT_CUSTOMER"]
    assert plan.second == [("ratio_in_90DAY_AMT_in_180DAY_OFFSET_30DAY_AMT_CUSTOMER", "ratio", "in_90DAY_AMT", "in_180DAY_OFFSET_30DAY_AMT_CUSTOMER")]
    assert (plan.first[2].days, plan.first[2].offset, [(g.days, g.op) for g in plan.gaps]) == (180, 30, [(30, "AVG")])


@pytest.mark.parametrize("name", ["in_90DAY_FOO", "in_AMT", "in_90DAY_OFFSET_AMT", "in_90DAY_AMT_VOL", "in_90DAY_COUNT", "ALERT_90DAY_VOL", "STR_90DAY_TO-FOREIGN_COUNT",
                                  "in_ALERT_90DAY_COUNT", "in_90DAY_TXN-GAP_MAX", "in_90DAY_TXN-GAP", "in_90DAY_OPP-PARTY-AGE-UNDER-x_AMT", "CDD_90DAY_COUNT"])
def test_names_that_raise(name):
    with pytest.raises(ValueError):
        ft.plan_features([name], {"in": ["in"]})


def test_mixed_names_against_brute_force(spark):
    """Two levels, three sources, gaps, distinct values by flag, ages; one party holds a third of all rows."""
    rnd = random.Random(11)
    day = lambda n: DAY0 + dt.timedelta(days=n)
    born = {o: None if o == 5 else dt.date(2000, 1, 1) + dt.timedelta(days=rnd.randint(-400, 1200)) for o in range(9)}
    facts = []
    for i in range(700):
        party = 0 if i % 3 == 0 else rnd.randint(1, 8)
        opp = rnd.randint(0, 8)
        facts.append((party, 100 + 2 * party + rnd.randint(0, 1), day(rnd.randint(0, 500)), rnd.randint(1, 900), rnd.choice(["in", "out"]), opp,
                      opp * 10 + rnd.randint(0, 1), "XY"[opp % 2], rnd.random() < 0.5, opp % 3 == 0, born[opp]))
    past = [(rnd.randint(0, 8), day(rnd.randint(0, 500)), rnd.choice([True, False, None])) for _ in range(200)]
    refs = sorted({(p := rnd.randint(0, 10), 100 + 2 * p + rnd.randint(0, 1), day(rnd.randint(100, 520))) for _ in range(40)})
    f = spark.createDataFrame(facts, "party int, account long, txn_date date, amount int, direction string, opp_party int, opp_account int, opp_country string, "
                                     "to_foreign boolean, with_pep boolean, birth_date date").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    a = spark.createDataFrame([(p, d, t, None if t is None else not t) for p, d, t in past], "party int, alert_date date, is_true boolean, is_false boolean")
    r = spark.createDataFrame([*refs, (3, None, day(300))], "party int, account long, ref_date date")
    names = ["in_90DAY_AMT_CUSTOMER", "out_180DAY_OFFSET_30DAY_VOL_ACCOUNT", "ALERT_360DAY_COUNT_CUSTOMER", "STR_180DAY_COUNT_CUSTOMER", "CDD-FSTR_360DAY_OFFSET_30DAY_COUNT_CUSTOMER",
             "ratio_FSTR_360DAY_COUNT_CUSTOMER_ALERT_360DAY_COUNT_CUSTOMER", "in_180DAY_TXN-GAP_AVG_CUSTOMER", "all_90DAY_TXN-GAP_SD_ACCOUNT", "all_360DAY_DISTINCT-COUNT_CUSTOMER",
             "in_360DAY_TO-FOREIGN_DISTINCT-COUNT_CUSTOMER", "all_180DAY_OFFSET_30DAY_WITH-PEP_DISTINCT-COUNT_CUSTOMER", "all_360DAY_OPP-PARTY-AGE-UNDER-19_DISTINCT-COUNT_CUSTOMER",
             "all_360DAY_OPP-PARTY-AGE-UNDER-19_AMT_CUSTOMER", "in_180DAY_OPP-PARTY-AGE-UNDER-20_AVG_ACCOUNT", "all_360DAY_OPP-PARTY-AGE-UNDER-19_MAX_CUSTOMER", "all_360DAY_200kto300k_VOL_CUSTOMER"]
    alerts = ft.Source(a, "alert_date", {"CUSTOMER": "party"})
    made = ft.mixed_matrix({"transactions": ft.Source(f, "txn_date", {"CUSTOMER": "party", "ACCOUNT": "account"}, "amount"), "alerts": alerts, "cdd_alerts": alerts},
                           r, names, {"all": [], "in": ["in"], "out": ["out"]}, {"CUSTOMER": "party", "ACCOUNT": "account"})
    assert made.columns == ["party", "account", "ref_date", *names]
    got = {tuple(x)[:3]: tuple(x)[3:] for x in made.collect()}
    assert len(got) == len(refs) + 1

    def gaps(days):
        days = sorted(set(days))
        return [(y - x).days for x, y in zip(days, days[1:])]

    for party, account, ref in [*refs, (3, None, day(300))]:
        def win(k, n, o=0):
            key = (0, party) if k == "C" else (1, account)
            return [x for x in facts if x[key[0]] == key[1] and o <= (ref - x[2]).days < n]
        young = lambda x, n: x[10] is not None and int((ref - x[10]).days / 365.25) < n
        al = lambda n, o=0, t=None: sum(1 for p, d, v in past if p == party and o <= (ref - d).days < n and (t is None or v is t))
        g1, g2 = gaps(x[2] for x in win("C", 180) if x[4] == "in"), gaps(x[2] for x in win("A", 90))
        y20 = [x[3] for x in win("A", 180) if x[4] == "in" and young(x, 20)]
        want = [sum(x[3] for x in win("C", 90) if x[4] == "in"), sum(1 for x in win("A", 180, 30) if x[4] == "out"), al(360), al(180, 0, True), al(360, 30, False),
                al(360, 0, False) / al(360) if al(360) else None, statistics.mean(g1) if g1 else None, statistics.stdev(g2) if len(g2) > 1 else None,
                len({x[6] for x in win("C", 360)}), len({x[7] for x in win("C", 360) if x[4] == "in" and x[8]}), len({x[5] for x in win("C", 180, 30) if x[9]}),
                len({x[5] for x in win("C", 360) if young(x, 19)}), sum(x[3] for x in win("C", 360) if young(x, 19)), statistics.mean(y20) if y20 else None,
                max((x[3] for x in win("C", 360) if young(x, 19)), default=None), 0]
        for name, w, v in zip(names, want, got[party, account, ref]):
            assert v == (pytest.approx(w) if w is not None else None), (party, account, ref, name)


def test_second_level_without_denominator(spark):
    df = spark.createDataFrame([(4.0, 0.0), (0.0, 0.0), (2.0, 8.0)], "a double, b double")
    got = df.select(ft.ratio(F.col("a"), F.col("b")), ft.net(F.col("a"), F.col("b")), ft.flow_through(F.col("a"), F.col("b"))).collect()
    assert [tuple(x) for x in got] == [(None, 4.0, 0.0), (None, 0.0, 0.0), (0.25, -6.0, 0.25)]


def test_disjoint_intervals_cover_the_same_days(spark):
    rows = [(1, dt.date(2020, 1, 1), dt.date(2020, 1, 10)), (1, dt.date(2020, 1, 5), dt.date(2020, 1, 7)), (1, dt.date(2020, 1, 9), dt.date(2020, 1, 20)),
            (1, dt.date(2020, 2, 1), None), (2, dt.date(2020, 1, 1), dt.date(2020, 1, 1))]
    got = static.disjoint_intervals(spark.createDataFrame(rows, "party int, start_date date, expiry_date date"), "party").orderBy("party", "on").collect()
    assert [(x.party, x.on, x.off) for x in got] == [
        (1, dt.date(2020, 1, 1), dt.date(2020, 1, 11)), (1, dt.date(2020, 1, 11), dt.date(2020, 1, 21)),
        (1, dt.date(2020, 2, 1), dt.date(9999, 12, 31)), (2, dt.date(2020, 1, 1), dt.date(2020, 1, 2))]


def joined_rows(df):
    """Rows that come out of the joins of a run plan."""
    total = 0
    nodes = [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
            continue
        if node.nodeName() in ("ShuffleQueryStage", "BroadcastQueryStage", "TableCacheQueryStage"):
            nodes.append(node.plan())
            continue
        if "Join" in node.nodeName() and node.metrics().contains("numOutputRows"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def test_valid_intervals_against_brute_force(spark):
    rnd = random.Random(3)
    spans = [(rnd.choice([0, 0, 1, 2, None]), i, None if i == 7 else DAY0 + dt.timedelta(days=s), None if i % 9 == 0 else DAY0 + dt.timedelta(days=s + rnd.randint(-3, 120)))
             for i, s in enumerate(rnd.choices(range(-50, 300), k=120))]
    points = [(rnd.choice([0, 1, 2, 3, None]), None if i == 5 else DAY0 + dt.timedelta(days=rnd.randint(0, 330))) for i in range(150)]
    iv = spark.createDataFrame(spans, "party int, interval_id int, start_date date, expiry_date date")
    got = {(r.party, r.day): (r.start_date, r.interval_id) for r in enrich.valid_intervals(spark.createDataFrame(points, "party int, day date"), iv, "party", "day").collect()}
    assert set(got) == set(points)
    far = dt.date(9999, 12, 31)
    for party, day in points:
        ok = [(s, e or far, i) for p, i, s, e in spans if None not in (party, p, day, s) and p == party and s <= day <= (e or far)]
        best = max(ok, default=None)
        assert got[party, day] == ((best[0], best[2]) if best else (None, None)), (party, day)
    none = enrich.valid_intervals(spark.createDataFrame([], "party int, day date"), iv, "party", "day")
    assert none.columns == ["party", "day", "start_date", "interval_id"] and none.count() == 0


def test_valid_intervals_of_a_hot_key_make_no_product(spark):
    day = lambda n: F.date_add(F.lit(DAY0), n.cast("int"))
    points = spark.range(1000).select(F.lit(1).alias("party"), day(F.col("id")).alias("day"))
    iv = spark.range(1000).select(F.lit(1).alias("party"), F.col("id").alias("interval_id"), day(F.col("id")).alias("start_date"), day(F.col("id") + 900).alias("expiry_date"))
    out = enrich.valid_intervals(points, iv, "party", "day")
    assert all((r.day - DAY0).days == r.interval_id for r in out.collect())
    assert 0 < joined_rows(out) < 20_000


def test_links_against_brute_force(spark):
    rnd = random.Random(8)
    day = lambda n: DAY0 + dt.timedelta(days=n)
    links = [(0 if i % 3 == 0 else rnd.randint(1, 6), 9 if i % 4 == 0 else rnd.randint(7, 14), rnd.choice([None, day(rnd.randint(100, 600))])) for i in range(120)]
    alerts = [(9 if i % 3 == 0 else rnd.randint(7, 13), day(rnd.randint(0, 600)), rnd.choice("FOP")) for i in range(150)]
    spans = [(9 if i % 3 == 0 else rnd.randint(7, 13), day(s := rnd.randint(0, 500)), rnd.choice([None, day(s + rnd.randint(0, 200))])) for i in range(25)]
    refs = sorted({(rnd.choice([0, 0, *range(1, 8)]), day(rnd.randint(0, 620))) for _ in range(60)})
    lk = spark.createDataFrame(links, "party int, linked_party int, end_date date")
    rf = spark.createDataFrame(refs, "party int, ref_date date")
    a = {(r.party, r.ref_date): r for r in static.linked_alerts(lk, spark.createDataFrame(alerts, "party int, alert_date date, result string"), rf).collect()}
    risky = spark.createDataFrame([(8,), (9,), (9,)], "party int")
    k = {(r.party, r.ref_date): r for r in static.linked_risk(lk, spark.createDataFrame(spans, "party int, start_date date, expiry_date date"), risky, rf).collect()}
    assert set(a) == set(k) == set(refs)
    far = dt.date(9999, 12, 31)
    for party, ref in refs:
        active = {q for q in range(7, 15) if max((e or far for p, l, e in links if (p, l) == (party, q)), default=ref) > ref}
        near = [(p, r) for p, d, r in alerts if p in active and 0 <= (ref - d).days < 360]
        assert (a[party, ref].linked_alerts, a[party, ref].linked_true_alerts, a[party, ref].linked_with_true_alert) == (
            len(near), sum(r == "F" for _, r in near), len({p for p, r in near if r == "F"}))
        assert (k[party, ref].linked_high_risk_party, k[party, ref].linked_high_risk_country) == (
            len({p for p, s, e in spans if p in active and s <= ref <= (e or far)}), len(active & {8, 9}))


@pytest.mark.parametrize("hub", ["linked", "linking"])
def test_hub_of_links_makes_no_product(spark, hub):
    """10,000 links of one party against 1,000 dates on the other side."""
    n, day = 10_000, lambda c: F.date_add(F.lit(DAY0), c.cast("int"))
    many, one = F.col("id").alias, F.lit(-1).alias
    links = spark.range(n).select(*((many("party"), one("linked_party")) if hub == "linked" else (one("party"), many("linked_party"))), F.lit(None).cast("date").alias("end_date"))
    wide = lambda d: spark.range(1000).select(F.lit(-1).cast("long").alias("party"), day(F.col("id")).alias(d))
    thin = lambda d: spark.range(n).select(F.col("id").alias("party"), F.lit(DAY0).alias(d))
    alerts = (wide if hub == "linked" else thin)("alert_date").withColumn("result", F.lit("F"))
    refs = (thin if hub == "linked" else wide)("ref_date")
    out = static.linked_alerts(links, alerts, refs)
    first = [r.linked_alerts for r in out.collect() if r.ref_date == DAY0]
    assert first == ([1] * n if hub == "linked" else [n])
    assert 0 < joined_rows(out) < 120_000

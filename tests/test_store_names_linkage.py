"""The keyed store, pairs of names by edit distance and average linkage against brute force."""

import os
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import assoc as ac, sampling as sp, screening as sc
from riskspark.operators.store import KeyedStore


def rows_of(df):
    return {r.k: r.v for r in df.collect()}


@pytest.fixture
def store(spark, tmp_path):
    made = KeyedStore(spark, f"{tmp_path}/store", "k", 100)
    made.create(spark.range(5_000).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    return made


def replaced(delta):
    return lambda before: delta.join(before.select("k", F.col("v").alias("was")), "k", "left").select(
        "k", F.concat_ws(">", "was", "v").alias("v"))


def test_store_reads_and_writes_touched_buckets_only(spark, store):
    delta = spark.createDataFrame([(7, "a"), (4_999, "b"), (9_000, "c")], "k long, v string")
    assert store.upsert(delta, replaced(delta)) == 1
    got = rows_of(store.read())
    assert len(got) == 5_001 and (got[7], got[4_999], got[9_000], got[8]) == ("old>a", "old>b", "c", "old")
    written = [d for d in os.listdir(f"{store.folder}/data/version=1") if d.startswith("_bucket=")]
    touched = {r[0] for r in delta.select(store.bucket()).collect()}
    assert {int(d.split("=")[1]) for d in written} == touched and len(touched) <= 3
    assert sum(v == 1 for v in store.placed().values()) == len(touched) and len(store.placed()) == 100
    assert rows_of(store.read(0))[7] == "old" and store.versions() == [0, 1]


def test_store_broken_run_changes_nothing(spark, store):
    delta = spark.createDataFrame([(1, "x")], "k long, v string")

    def breaks(before):
        return replaced(delta)(before).withColumn("v", F.raise_error(F.lit("broken")))

    with pytest.raises(Exception, match="broken"):
        store.upsert(delta, breaks)
    assert store.versions() == [0] and len(rows_of(store.read())) == 5_000
    assert store.upsert(delta, replaced(delta)) == 1 and rows_of(store.read())[1] == "old>x"


def test_store_empty_and_null_deltas_and_deletion(spark, store):
    none = spark.createDataFrame([(None, "x")], "k long, v string")
    assert store.upsert(none, replaced(none.filter("k IS NOT NULL"))) == 1
    assert len(rows_of(store.read())) == 5_000
    every = spark.range(5_000).select(F.col("id").alias("k"), F.lit("y").alias("v"))
    store.upsert(every.select("k"), lambda before: before.limit(0))
    assert store.read().count() == 0 and store.read().columns == ["k", "v"]
    with pytest.raises(ValueError):
        store.create(every)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def spoilt(rnd, name):
    chars = list(name)
    for _ in range(rnd.randrange(4)):
        at = rnd.randrange(len(chars) + 1)
        how = rnd.randrange(3)
        if how == 0:
            chars.insert(at, rnd.choice("ABCÉ "))
        elif at < len(chars):
            chars[at : at + 1] = [] if how == 1 else [rnd.choice("ABCÉ ")]
    return "".join(chars)


@pytest.mark.parametrize("ratio,spare", [(0.8, 2), (0.9, 2), (0.7, 0), (0.8, 4), (1.0, 1), (0.55, 1)])
def test_edit_join_equals_all_pairs(spark, ratio, spare):
    rnd = random.Random(int(ratio * 100) + spare)
    base = ["".join(rnd.choices("ABCÉ ", k=rnd.randrange(1, 30))) for _ in range(60)] + ["A", "AB", "B", "", None]
    base += ["".join(rnd.choices("ABC", k=12)) + " LIMITED COMPANY" for _ in range(15)]
    other = [x if x is None else spoilt(rnd, x) for x in base * 2]
    l, r = spark.createDataFrame([(x,) for x in base * 3], "n string"), spark.createDataFrame([(x,) for x in other], "m string")
    got = {(x.l_name, x.r_name): x.similarity for x in sc.edit_join(l, r, "n", "m", ratio, spare).collect()}
    want = {}
    for a in {x for x in base if x}:
        for b in {x for x in other if x}:
            s = 1 - edits(a, b) / max(len(a), len(b))
            if s >= ratio - 1e-9:
                want[a, b] = s
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_edit_join_hot_piece_and_hot_name(spark):
    """A name on a third of all rows counts once, and a word that all names share is not looked up."""
    def coded(n, salt):
        return [f"{(i * 7919 + salt) * 104729 % 10**9:09d} TRADING" for i in range(n)]

    l = spark.createDataFrame([(x,) for x in coded(600, 0) + ["SAME NAME"] * 300], "n string")
    r = spark.createDataFrame([(x,) for x in coded(600, 0)[:300] + coded(300, 5) + ["SAME NAME"] * 300], "n string")
    made = sc.edit_join(l, r, "n", "n", 0.9)
    got = {(x.l_name, x.r_name) for x in made.collect()}
    assert len(got) == made.count() and ("SAME NAME", "SAME NAME") in got
    assert {(x, x) for x in coded(600, 0)[:300]} <= got
    with pytest.raises(ValueError):
        sc.edit_join(l, r, "n", "n", 0.5)


def plain_linkage(d, n):
    """One merge after the other; heights and members."""
    groups, out = [[i] for i in range(n)], []
    while len(groups) > 1:
        h, i, j = min((np.mean([d[a][b] for a in x for b in y]), i, j) for (i, x), (j, y) in combinations(enumerate(groups), 2))
        out.append((h, frozenset(groups[i] + groups[j])))
        groups[i] = groups[i] + groups[j]
        del groups[j]
    return out


def cut(merges, n, keep):
    groups = {frozenset([i]) for i in range(n)}
    for h, whole in merges:
        if keep(h):
            groups = {g for g in groups if not g <= whole} | {whole}
    return groups


def sets(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.group, set()).add(int(r.feature[1:]))
    assert all(min(g) == int(name[1:]) for name, g in found.items())
    return {frozenset(g) for g in found.values()}


def test_average_linkage_equals_plain_run_on_40_features(spark):
    n, rng = 40, np.random.default_rng(3)
    centre = rng.normal(size=(7, 60))
    r = np.corrcoef(centre[rng.integers(0, 7, n)] + rng.normal(size=(n, 60)))
    names = [f"f{i:02d}" for i in range(n)]
    rows = [(names[i], names[j], float(r[i, j])) for i, j in combinations(range(n), 2)]
    assoc = spark.createDataFrame(rows, "f1 string, f2 string, r double")
    m = np.abs(r)
    np.fill_diagonal(m, 1.0)
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    merges = plain_linkage(1 - unit @ unit.T, n)
    made = ac.average_linkage(ac.cosine_distances(assoc, names), names)
    heights = sorted(x.height for x in made.collect())
    assert np.allclose(heights, sorted(h for h, _ in merges))
    for below in (0.2, 0.35):
        assert sets(ac.linkage_groups(assoc, names, below=below)) == cut(merges, n, lambda h, b=below: h < b)
    assert sets(ac.linkage_groups(assoc, names, groups=7)) == cut(merges, n, lambda h: h <= sorted(x for x, _ in merges)[n - 8])


def test_average_linkage_ties_and_unknown(spark):
    names = ["f0", "f1", "f2", "f3"]
    assoc = spark.createDataFrame([("f0", "f1", 1.0), ("f2", "f3", -1.0), ("f0", "f2", None)], "f1 string, f2 string, r double")
    assert sets(ac.linkage_groups(assoc, names, below=0.5)) == {frozenset({0, 1}), frozenset({2, 3})}
    assert sets(ac.linkage_groups(assoc, names, groups=1)) == {frozenset(range(4))}
    assert sets(ac.linkage_groups(assoc, ["f0"], below=0.5)) == {frozenset({0})}
    with pytest.raises(ValueError):
        ac.linkage_groups(assoc, names)


def test_splits_by_seed_are_independent(spark):
    df = spark.range(2_000).select(F.col("id"), (F.col("id") % 2).cast("int").alias("y"))
    def taken(seed):
        out, _, _ = sp.split(df, "stratified", sp.SplitParams("id", "y", valid_pct=20.0, seed=seed))
        return {r.id for r in out.filter("is_valid").collect()}
    a, b = taken(""), taken("2")
    assert len(a) == len(b) == 400 and len(a & b) < 160 and a == taken("")

"""Components, density clustering and neighbour distances against brute force."""

import random
import statistics

import pytest

from riskspark.operators import components, density, metric


def test_components_chain_star_and_loner(spark):
    nodes = [(f"n{i:03d}", i) for i in range(60)]
    edges = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(0, 24)] + [("n040", f"n{i:03d}") for i in range(30, 50) if i != 40]
    got = components.connected_components(spark.createDataFrame(nodes, "node string, label long"), spark.createDataFrame(edges, "src string, dst string"))
    labels = {r.node: r.label for r in got.collect()}
    assert {labels[f"n{i:03d}"] for i in range(25)} == {0}
    assert {labels[f"n{i:03d}"] for i in range(30, 50)} == {30}
    assert labels["n055"] == 55


def label_sets(spark, edges, **kw):
    frame = spark.createDataFrame(edges, "src long, dst long")
    return {r.node: r.root for r in components.component_roots(frame, **kw).collect()}


def test_edges_fall_every_round_and_rounds_are_few(spark, monkeypatch):
    """A chain and a star of 20,000 and a clique, by rounds alone."""
    n = 20_000
    chain = [(i, i + 1) for i in range(n - 1)]
    star = [(n + 5_000, n + i) for i in range(n) if i != 5_000]
    clique = [(3 * n + i, 3 * n + j) for i in range(40) for j in range(i)]
    counts, rewritten = [], components._rewritten

    def counted(edges, parents):
        out = rewritten(edges, parents)
        counts.append((edges.count(), out.count()))
        return out

    monkeypatch.setattr(components, "_rewritten", counted)
    roots = label_sets(spark, chain + star + clique, one_task=0)
    assert all(b < a for a, b in counts) and len(counts) < 25
    assert len(roots) == 2 * n + 40
    for part in (range(n), range(n, 2 * n), range(3 * n, 3 * n + 40)):
        assert len({roots[i] for i in part}) == 1
    assert len(set(roots.values())) == 3


def test_rounds_and_one_task_agree(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(7, 7), (None, 3)]
    def groups(roots):
        found = {}
        for i, r in roots.items():
            found.setdefault(r, set()).add(i)
        return sorted(map(sorted, found.values()))
    assert groups(label_sets(spark, edges, one_task=0)) == groups(label_sets(spark, edges)) == groups(label_sets(spark, edges, one_task=40))
    assert label_sets(spark, [(1, 1)]) == {}


def scaled(rows):
    out = []
    for k in range(1, len(rows[0])):
        values = [r[k] for r in rows]
        m, s = statistics.mean(values), statistics.stdev(values) or 1.0
        out.append([(v - m) / s for v in values])
    return list(zip(*out))


def gaps(rows):
    z = scaled(rows)
    return [[sum((x - y) * (x - y) for x, y in zip(p, q)) for q in z] for p in z]


def points(seed=11, n=240, dims=2):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append((i, *[1.0] * dims))                      # a third are copies
        elif i % 3 == 1:
            rows.append((i, *[rnd.gauss(4 * (k % 2), 0.3) for k in range(dims)]))
        else:
            rows.append((i, *[rnd.uniform(-6, 6) for _ in range(dims)]))
    return rows


def plain_clusters(rows, eps, k):
    n, d = len(rows), gaps(rows)
    near = [[j for j in range(n) if d[i][j] <= eps * eps] for i in range(n)]
    core = {i for i in range(n) if len(near[i]) >= k}
    label = {}
    for i in sorted(core):
        if i in label:
            continue
        stack, label[i] = [i], i
        while stack:
            for j in near[stack.pop()]:
                if j in core and j not in label:
                    label[j] = i
                    stack.append(j)
    return {i: label[i] if i in core else min((label[j] for j in near[i] if j in core), default=-1) for i in range(n)}


@pytest.mark.parametrize(("dims", "eps", "cell"), [(2, 0.3, 20), (9, 0.9, 512)])
def test_density_clusters(spark, monkeypatch, dims, eps, cell):
    monkeypatch.setattr(metric, "CELL", cell)
    monkeypatch.setattr(metric, "CHUNK", 50)
    monkeypatch.setattr(metric, "SLICE", 70)
    rows = points(dims=dims)
    want = plain_clusters(rows, eps, 6)
    names = [f"v{k}" for k in range(dims)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in names))
    assert {r.id: r.cluster for r in density.density_cluster(df, "id", names, eps, 6).collect()} == want
    assert len(set(want.values())) > 2 and -1 in want.values()


@pytest.mark.parametrize(("dims", "cell"), [(2, 10), (12, 30)])
def test_kth_distance(spark, monkeypatch, dims, cell):
    monkeypatch.setattr(metric, "CELL", cell)
    monkeypatch.setattr(metric, "CHUNK", 40)
    rows, k = points(4, 120, dims), 5
    want = {i: sorted(d)[k] for i, d in enumerate(gaps(rows))}
    names = [f"v{c}" for c in range(dims)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in names))
    got = {r.id: r.d2 for r in density.kth_distance(df, "id", names, k).collect()}
    assert got == pytest.approx(want, abs=1e-9) and len(got) == len(rows)
    assert all(r.d2 is None for r in density.kth_distance(df.limit(3), "id", names, k).collect())


def test_density_of_odd_rows(spark):
    rows = [(1, 0.0, 1.0), (2, None, 1.0), (3, float("nan"), 1.0), (4, -0.0, 1.0), (5, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    assert {r.id: r.cluster for r in density.density_cluster(df, "id", ["x", "y"], 0.5, 3).collect()} == {1: 1, 2: -1, 3: -1, 4: 1, 5: 1}
    assert {r.id: r.d2 for r in density.kth_distance(df, "id", ["x", "y"], 2).collect()} == {1: 0.0, 2: None, 3: None, 4: 0.0, 5: 0.0}
    assert density.density_cluster(df.limit(0), "id", ["x"], 1.0, 2).collect() == []


def test_categories_keep_clusters_apart(spark):
    rows = [(i, (i // 2) % 5 * 0.01, (i // 2) % 7 * 0.01, "ab"[i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, x double, y double, kind string")
    plain = density.density_cluster(df, "id", ["x", "y"], 4.0, 5).collect()
    assert {r.cluster for r in plain} == {0}
    apart = {r.id: r.cluster for r in density.density_cluster(df, "id", ["x", "y"], 1.9, 3, {"kind": ["a"]}).collect()}
    assert {apart[i] for i in range(0, 60, 2)}.isdisjoint({apart[i] for i in range(1, 60, 2)} - {-1})

"""Vector searches against brute force."""

import numpy as np
import pytest

from riskspark.llm import kmeans_tree, neighbours, va_file
from riskspark.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)


def brute(rows, k, zero, whole):
    rows = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and (zero or any(v))]
    if whole:
        rows = [(i, np.floor(64 * v)) for i, v in rows]
    out = {}
    for i, v in rows:
        if i % 20 == 0:
            near = sorted((-float((v * w).sum()), j) for j, w in rows if j != i)[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def odd_rows(n=600, d=8):
    rng = np.random.default_rng(4)
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(rng.normal(size=(n, d)))]
    hot = rows[5][1]
    rows += [(n + i, hot) for i in range(n // 2)]                    # a third of all rows
    rows += [(n * 2, None), (n * 2 + 1, [0.0] * d), (n * 2 + 2, [float("nan")] * d), (n * 2 + 3, [float("inf")] + hot[1:]), (n * 2 + 4, [None] + hot[1:]), (None, hot)]
    return rows


@pytest.mark.parametrize("chunk,part", [(4_096, 4_096), (100, 7)])
def test_va_file_is_exact(spark, monkeypatch, chunk, part):
    monkeypatch.setattr(neighbours, "CHUNK", chunk)
    monkeypatch.setattr(neighbours, "SLICE", part)
    rows = odd_rows()
    assert lists(va_file.search(frame(spark, rows), 20)) == brute(rows, 20, True, True)


def test_va_file_reads_few_exact_vectors():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(4_000, 64))
    v = np.floor(64 * v / np.linalg.norm(v, axis=1, keepdims=True))
    who, row, score, read = va_file.top(v[:20], v, np.arange(len(v)), 21)
    assert read < 0.25 * 20 * len(v)
    for i in range(20):
        want = sorted((-int(s), j) for j, s in enumerate(v @ v[i]))[:21]
        assert [(-s, j) for s, j in zip(np.array(score)[who == i], row[who == i], strict=True)] == want


def test_va_file_large_numbers():
    v = np.floor(np.array([[2.0**40, 3.0, 1.0], [2.0**40, 2.0, 5.0], [-(2.0**40), 1.0, 1.0], [2.0**60, 2.0**60, 1.0]]))
    who, row, score, _ = va_file.top(v[:1], v, np.arange(4), 4)
    want = sorted(((max(-(2**63), min(2**63 - 1, sum(int(a) * int(b) for a, b in zip(v[0], x, strict=True)))), -j) for j, x in enumerate(v)), reverse=True)
    assert [(s, -j) for s, j in zip(score, row, strict=True)] == want


def test_tree_recall_and_copies(spark):
    rows = odd_rows()
    got, want = lists(kmeans_tree.search(frame(spark, rows), 20)), brute(rows, 20, False, False)
    assert got.keys() == want.keys()
    found = [len({j for j, _ in got[i]} & {j for j, _ in want[i]}) / 20 for i in want]
    assert np.mean(found) >= 0.9
    vectors = {i: np.array(v, np.float64) for i, v in rows if i is not None and v and None not in v}
    for i, near in got.items():
        assert len(near) == 20 and i not in {j for j, _ in near}
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        assert np.allclose([s for _, s in near], [vectors[i] @ vectors[j] for j, _ in near])


def test_tree_recall_on_given_vectors(spark):
    df = table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got, want = lists(kmeans_tree.search(df, 20)), brute(rows, 20, False, False)
    assert np.mean([len({j for j, _ in got[i]} & {j for j, _ in want[i]}) / 20 for i in want]) >= 0.9


@pytest.mark.parametrize("search", [kmeans_tree.search, va_file.search])
def test_small_and_empty_tables(spark, search):
    assert search(frame(spark, []), 20).count() == 0
    assert search(frame(spark, [(0, None), (20, [float("nan")])]), 20).count() == 0
    assert lists(search(frame(spark, [(0, [1.0, 2.0])]), 20)) == {}
    got = lists(search(frame(spark, [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, 1.0]), (3, [1.0])]), 20))
    assert [j for j, _ in got[0]] in ([1, 2], [2, 1]) and len(got) == 1


def test_leaves_hold_every_row():
    tree = kmeans_tree.grow(np.random.default_rng(2).normal(size=(3_000, 6)), 5.0)
    x = np.random.default_rng(3).normal(size=(500, 6))
    assert ((0 <= tree.place(x)) & (tree.place(x) < tree.leaves)).all()
    assert (np.sort(tree.order(x[:5], tree.leaves), axis=1) == np.arange(tree.leaves)).all()

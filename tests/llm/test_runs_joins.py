"""Periodic runs, the n-gram Jaccard join and hard negatives against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from riskspark.llm import mining, periods, setjoin

DOCS = "doc_id long, text string, source string, n long, class long, fragment string"


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1, 2, "f") for i, t in rows], DOCS)


# -- periodic runs ---------------------------------------------------------------------------
def plain_runs(w):
    out, n = [], len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(i, j + q - p)) for p in range(1, q)):
                out.append((i, j + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda x: (x[0], x[2]))


def odd_words(rnd):
    kind, k = rnd.randrange(5), rnd.choice([1, 2, 2, 3, 5, 50])
    out = [rnd.randrange(k) for _ in range(rnd.randrange(20))]
    for _ in range(rnd.randrange(1, 5)):
        q = rnd.randrange(1, 50)
        unit = [rnd.randrange(k) for _ in range(q)]
        if kind == 2 and q > 6:
            unit = (unit[:3] * (q // 3 + 1))[:q]                # periodic, but not throughout
        if kind == 3:
            unit = (unit[: rnd.randrange(1, 4)] * 30)[: q - 1] + [99]
        out += (unit * 9)[: int(q * rnd.uniform(1, 8))]
    if kind == 4:
        a, b = [0], [0, 1]
        for _ in range(9):
            a, b = b, b + a
        out += b                                                # a Fibonacci word
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_brute_force(seed):
    rnd = random.Random(seed)
    for _ in range(20):
        texts = [odd_words(rnd) for _ in range(rnd.randrange(1, 6))]
        found = periods.periodic([" ".join(map(str, w)).encode() for w in texts])
        for w, (runs, words) in zip(texts, found, strict=True):
            assert [tuple(r) for r in runs.tolist()] == plain_runs(w)
            assert words == [str(x).encode() for x in w]


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    lost = {i for b, e, q in runs for i in range(b + q, e)}
    top = min(runs, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    best = (top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2]) if top else (None,) * 4
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, sha("".join(f"{b},{e - b},{q}\n" for b, e, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in lost)))


def test_run_digests(spark, monkeypatch):
    rnd = random.Random(8)
    rows = [(i, " ".join(f"w{x}é" for x in odd_words(rnd))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (None, "a b " * 9), (203, "no break x y " * 5), (204, "A a " * 8), (204, "A a " * 8), (205, "x" * 100_000)]
    monkeypatch.setattr(periods, "CHUNK", 500)
    got = periods.query(docs_frame(spark, rows).repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((plain_row(*r) for r in rows), key=str)
    assert sum(r.n_runs for r in got) > 50 and any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(120))
    assert periods.query(docs_frame(spark, [])).collect() == []
    listed = periods.runs(docs_frame(spark, [(1, "a b a b a b a b c"), (2, None)])).collect()
    assert [tuple(r) for r in listed] == [(1, 0, 8, 2)]


def test_long_text_with_nested_repetitions():
    rnd = random.Random(1)
    unit = [str(rnd.randrange(9)) for _ in range(700)]
    w = unit * 5 + ["x"] * 300 + [str(i) for i in range(20_000)]
    runs = [tuple(r) for r in periods.periodic([" ".join(w).encode()])[0][0].tolist()]
    assert (0, 3_500, 700) in runs and (3_500, 3_800, 1) in runs


# -- n-gram join ---------------------------------------------------------------------------
def plain_components(rows, words, percent):
    sets = []
    for _, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets.append({tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(root(k), []).append(i)
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[k][0], len(sets[k]), least[root(k)]) for k in range(len(rows))), key=str)


def near_texts(seed):
    """A third of the texts are edits of one text, and a passage is in a third of the others."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(3_000)}"
    base, passage = [word() for _ in range(90)], [word() for _ in range(30)]
    rows = []
    for i in range(240):
        if i % 3 == 0:
            w = list(base)
            for _ in range(rnd.randrange(5)):
                w[rnd.randrange(len(w))] = word()
        elif i % 3 == 1:
            w = [word() for _ in range(rnd.randrange(12))] + passage + [word() for _ in range(rnd.randrange(8))]
        else:
            w = [word() for _ in range(rnd.randrange(40))]
        rows.append((1_000 - i, " ".join(w)))
    rows += [(5, None), (4, ""), (3, "one two"), (2, "One  TWO"), (1, "one"), (None, rows[0][1]), (None, "quite alone here it is"), (0, rows[0][1]), (0, rows[0][1])]
    return rows


@pytest.mark.parametrize(("words", "percent", "fragment"), [(4, 85, 1 << 20), (5, 80, 300), (1, 60, 2_000)])
def test_join_components(spark, monkeypatch, words, percent, fragment):
    monkeypatch.setattr(setjoin, "FRAGMENT", fragment)
    rows = near_texts(words)
    got = setjoin.components(docs_frame(spark, rows).repartition(5), words, percent).collect()
    assert sorted(map(tuple, got), key=str) == plain_components(rows, words, percent)


def test_join_of_empty_tables(spark):
    assert setjoin.components(docs_frame(spark, [])).collect() == []
    assert [tuple(r) for r in setjoin.components(docs_frame(spark, [(7, None)])).collect()] == [(7, 0, 7)]


def test_rounds_take_few_jobs(spark):
    """The driver keeps track of every job; each round deals the sets out once and looks labels up once."""
    spark.sparkContext.setJobGroup("rounds", "near texts")
    try:
        setjoin.components(docs_frame(spark, near_texts(4)).repartition(5)).collect()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("rounds"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs < 165


def test_a_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(f"x{i}" if k == at else w for k, w in enumerate(base))) for i, at in enumerate(rnd.randrange(120) for _ in range(300))]
    pairs, counted = [], setjoin.overlaps

    def count(p, cut):
        pairs.append(p.count())
        return counted(p, cut)

    monkeypatch.setattr(setjoin, "overlaps", count)
    got = setjoin.components(docs_frame(spark, rows)).collect()
    assert {r.component_id for r in got} == {0}
    assert sum(pairs) < 10 * len(rows) < 300 * 299 / 2


def test_parts_of_bounded_size_keep_every_text(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(setjoin, "PART_BYTES", 50)
    texts = ["a" * 60, "b" * 20, None, "c" * 30, "d" * 200, "e"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["i", "t"])
    parts = [(ids.to_pylist(), [x.decode() for x in t]) for ids, t in setjoin.parts_of([batch])]
    assert [i for ids, _ in parts for i in ids] == list(range(6)) and len(parts) > 2
    assert [x for _, t in parts for x in t] == [x or "" for x in texts]


# -- hard negatives ------------------------------------------------------------------------
VECTORS = "vec_id long, embedding array<float>, label int, rep string, score string, part int"


def plain_negatives(rows, step):
    w = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], label) for i, v, label in rows
         if i is not None and v and label is not None and None not in v and np.isfinite(v).all()]
    out = []
    for i, v, label in w:
        if i % step:
            continue
        near = sorted((-sum(a * b for a, b in zip(v, x, strict=True)), j, lab) for j, x, lab in w if j != i)
        for p, pid, _ in [n for n in near if n[2] == label][:5]:
            hard = [n for n in near if n[2] != label and 80 * -p <= 100 * -n[0] <= 100 * -p][:5]
            out += [(i, pid, k + 1, j, -p, -s) for k, (s, j, _) in enumerate(hard)]
    return sorted(out)


@pytest.mark.parametrize("read", [1, 16])
def test_hard_negatives(spark, monkeypatch, read):
    monkeypatch.setattr(mining, "READ", read)
    rng = np.random.default_rng(read)
    rows = [(i, np.float32(v).tolist(), int(i % 4)) for i, v in enumerate(rng.normal(size=(400, 6)) / 4 + 0.2)]
    rows += [(400 + i, rows[3][1], i % 2) for i in range(200)]              # a third of all rows is one vector
    rows += [(600 + i, [0.25 * (i % 3), 0.5, 0.0, 0.25, 0.0, 0.0], i % 3) for i in range(60)]  # many ties
    odd = [(700, None, 1), (701, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (702, [float("nan")] * 6, 1), (703, [1.0] * 6, None), (None, [1.0] * 6, 1),
           (704, [1.0] * 3, 1), (705, [], 1), (706, [0.0] * 6, 2), (720, [0.0] * 6, 2)]
    frame = spark.createDataFrame([(i, v, label, "r", "s", 0) for i, v, label in rows + odd], VECTORS)
    got = sorted(map(tuple, mining.mine(frame, anchor_step=20).collect()))
    assert got == plain_negatives([r for r in rows + odd if r[1] is None or len(r[1]) == 6], 20)
    assert mining.mine(frame.limit(0)).collect() == []


def test_threshold_stops_early():
    """Rows that are all but parallel to one axis: the lists end after a few steps."""
    rng = np.random.default_rng(0)
    v = np.floor(rng.normal(size=(5_000, 4)) * np.array([1_000, 3, 3, 3]))
    q = np.array([900.0, 1, -1, 0])
    best, met = [], 0
    for rows, last in mining.Lists(v).walk(q):
        met += len(rows)
        best = sorted([*best, *(v[rows] @ q)], reverse=True)[:5]
        if last < best[-1]:
            break
    assert met < 1_000 and best == sorted(v @ q, reverse=True)[:5]


def test_scores_beyond_a_double(spark):
    rows = [(0, [1e15, 1.0], 1), (1, [1e15, 2.0], 1), (2, [1e15, 0.0], 2), (3, [0.0, 1.0], 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = [tuple(r) for r in mining.mine(frame).collect()]
    assert got == [(0, 1, 1, 2, 2**63 - 1, 2**63 - 1)]


@pytest.mark.parametrize("fragment, parts", [(1 << 20, 1), (100, 4), (7, 3)])
def test_segments_come_from_packed_parts(spark, monkeypatch, fragment, parts):
    """Order, positions and cuts as made one by one; no row for each shingle goes round."""
    import random
    from collections import Counter

    monkeypatch.setattr(setjoin, "FRAGMENT", fragment)
    rng = random.Random(5)
    pool = [rng.getrandbits(64) - (1 << 63) for _ in range(80)]
    held = {k: sorted(set(rng.sample(pool, rng.randint(1, 60)) + [rng.getrandbits(64) - (1 << 63) for _ in range(k % 30)]), key=lambda x: x % (1 << 64))
            for k in range(60)}
    sets = spark.createDataFrame([(k, len(x), x) for k, x in held.items()], "class long, n long, hashes array<long>").repartition(parts).localCheckpoint()
    df = Counter(x for s in held.values() for x in s)
    place = {x: (df[x], x % (1 << 64)) for x in df if df[x] > 1}
    want = {}
    for k, s in held.items():
        items = sorted((x for x in s if x in place), key=place.get)
        if 100 * len(items) >= 70 * len(s):
            want[k] = (len(s), len(s) - len(items), items)
    got, fragments = {}, {}
    for r in sorted(setjoin.segments(sets, 70).collect(), key=lambda r: (r["class"], r.start)):
        n, start, items = got.setdefault(r["class"], (r.n, r.start, []))
        assert r.start == start + len(items) and r.hashes
        items += r.hashes
        for x in r.hashes:
            assert fragments.setdefault(x, r.fragment) == r.fragment
    assert got == want
    in_order = [fragments[x] for x in sorted(fragments, key=place.get)]
    assert in_order == sorted(in_order) and len(set(in_order)) > 3 * (fragment < 1000)
    if fragment > 1000:
        assert setjoin.counted(sets).count() < 60 + parts + 80
    assert setjoin.segments(sets.limit(0), 70).collect() == []

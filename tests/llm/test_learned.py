"""Classifiers, packing and the pipeline."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskspark.llm import cotrain, nbsvm, packing
from riskspark.llm.common import table

SF = "/root/testdata/sf0.01"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score string, y string"


def odd_docs(spark, n=6):
    texts = [None, "", "   ", "\n\n", "word " * 40_000, "Ein Satz."]
    return spark.createDataFrame([(i if i else None, texts[i % 6], None, None, None, "x", "y") for i in range(n)], COLUMNS)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


@pytest.mark.parametrize("target,scores", [("toxic", nbsvm.scores), ("quality", cotrain.scores)])
def test_held_out_accuracy(spark, target, scores):
    labels = table(spark, SF, "labels")
    got = scores(table(spark, SF, "documents"), labels)
    assert got.count() == table(spark, SF, "documents").count()
    rows = got.filter("held_out").join(labels, "doc_id").select("score", "predicted", target).collect()
    assert len(rows) > 30
    assert np.mean([r.predicted == r[target] for r in rows]) >= 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


@pytest.mark.parametrize("scores", [nbsvm.scores, cotrain.scores])
def test_odd_documents_and_labels(spark, scores):
    docs = odd_docs(spark)
    for rows in ([], [(1, 1, 1, "t")], [(1, 1, 0, "t"), (2, 0, 1, "t"), (2, 0, 1, "t"), (None, 1, 1, "t"), (3, None, None, None), (4, 1, 0, "t"), (6, 1, 1, "")]):
        got = scores(docs, labels_of(spark, rows)).collect()
        assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert scores(docs.limit(0), labels_of(spark, [])).count() == 0


def test_filters_keep_columns(spark):
    docs = odd_docs(spark)
    assert nbsvm.keep_clean(docs, labels_of(spark, [])).schema == docs.schema
    assert cotrain.keep_good(docs, labels_of(spark, [])).count() == 6


def test_scores_do_not_read_held_out_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.withColumn("toxic", F.when(nbsvm.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in nbsvm.scores(docs, x).collect()} for x in (labels, turned))
    assert a == b


def plain_newton(x, y, weight, w, steps, still):
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w)))
        h = sum(c * max(q * (1 - q), 1e-6) * np.outer(r, r) for r, q, c in zip(x, p, weight, strict=True)) + cotrain.L2 * np.eye(len(w))
        step = np.linalg.solve(h, sum(c * (q - t) * r for r, q, t, c in zip(x, p, y, weight, strict=True)) + cotrain.L2 * w)
        w = w - step
        if np.abs(step).max() < still:
            break
    return w


def test_cotraining_equals_a_run_over_rows_in_memory(spark):
    """Every unlabelled row takes part, copies as often as they occur, in any partition."""
    rng = np.random.default_rng(4)
    n, m = 900, 900
    y = rng.integers(0, 2, n + m).astype(float)
    a = y[:, None] * 3 + rng.normal(size=(n + m, 3))
    b = np.column_stack([rng.integers(0, cotrain.LANGS, n + m), np.where(rng.random(n + m) < 0.9, y, 1 - y) * 3, y * 4 + rng.normal(size=n + m)])
    a[n : n + 200], b[n : n + 200] = a[n], b[n]                                   # a hot group of copies
    views = cotrain.View(), cotrain.View({0: cotrain.LANGS, 1: cotrain.SOURCES})
    for v, x in zip(views, (a, b), strict=True):
        v.prepare(x[:n])
        v.weights = cotrain.regression(v.wide(v.bins(x[:n])), y[:n], np.ones(n))
    wide = [v.wide(v.bins(x)) for v, x in zip(views, (a, b), strict=True)]
    want, mine = [v.weights for v in views], [{}, {}]                              # row -> what the view was told
    before = None
    for _ in range(cotrain.ROUNDS - 1):
        p = [1 / (1 + np.exp(-(x[n:] @ w))) for x, w in zip(wide, want, strict=True)]
        for i in range(2):
            for row, q in enumerate(p[i]):
                if q >= cotrain.SURE or q <= 1 - cotrain.SURE:
                    mine[1 - i].setdefault(row, float(q >= 0.5))
        counts = [len(t) for t in mine]
        if counts == before:
            break
        before, start = counts, want
        # both views move in step, as the sums of both come from one pass
        for steps in range(1, cotrain.STEPS + 1):
            trial = []
            for i in range(2):
                at = np.array(sorted(mine[i]), int)
                share = cotrain.PSEUDO_WEIGHT * n / max(n, len(at))
                trial.append(plain_newton(np.vstack([wide[i][:n], wide[i][n + at]]), np.concatenate([y[:n], [mine[i][r] for r in at]]),
                                          np.concatenate([np.ones(n), np.full(len(at), share)]), start[i], steps, 0))
            moved = max(np.abs(t - w).max() for t, w in zip(trial, want, strict=True))
            want = trial
            if moved < cotrain.STILL:
                break
    assert min(before) > 100
    codes = np.hstack([v.bins(x[n:]) for v, x in zip(views, (a, b), strict=True)])
    for parts, grouped in ((3, False), (7, True)):
        for v, x in zip(views, (a, b), strict=True):
            v.weights = cotrain.regression(v.wide(v.bins(x[:n])), y[:n], np.ones(n))
        pool = spark.createDataFrame([(c.tobytes(),) for c in codes], "code binary").repartition(parts)
        pool = pool.groupBy("code").agg(F.count(F.lit(1)).alias("n")) if grouped else pool.withColumn("n", F.lit(1).cast("long"))
        cotrain.taught(pool, views, [(x[:n], y[:n]) for x in wide])
        for v, w in zip(views, want, strict=True):
            assert np.allclose(v.weights, w, atol=1e-3)


def test_cotraining_copies_score_alike(spark):
    docs, labels = table(spark, "/root/testdata/sf0.001", "documents"), table(spark, "/root/testdata/sf0.001", "labels")
    twice = cotrain.scores(docs.unionByName(docs), labels).collect()
    found = defaultdict(set)
    for r in twice:
        found[r.doc_id].add((r.score, r.predicted))
    assert len(twice) == 2 * docs.count() and all(len(v) == 1 for v in found.values())


def plain_best_fit(length, source, cluster, capacity, per_source):
    """Looks at every bin for each item."""
    bins, out = [], []
    for n, s, c in zip(length, source, cluster, strict=True):
        fit = [(b["left"], i) for i, b in enumerate(bins)
               if b["left"] >= n and (s < 0 or b["s"][s] < per_source) and (c < 0 or c not in b["c"])]
        if fit:
            i = min(fit)[1]
        else:
            i = len(bins)
            bins.append({"left": capacity, "s": Counter(), "c": set()})
        bins[i]["left"] -= n
        bins[i]["s"][s] += 1
        bins[i]["c"] |= {c} - {-1}
        out.append(i)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_is_the_tightest_bin(seed):
    rng = random.Random(seed)
    n = 400
    length = sorted((rng.randrange(0, 101) for _ in range(n)), reverse=True)
    source = [rng.choice([-1, 0, 0, 0, 1, 2, 3]) for _ in range(n)]
    cluster = [rng.choice([-1, -1, 0, 0, 1, 2, 3, 4]) for _ in range(n)]
    assert packing.best_fit(length, source, cluster, 100, 2)[0] == plain_best_fit(length, source, cluster, 100, 2)


def test_packing_whole_table(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 300)
    rng = random.Random(2)
    rows = [(i, rng.choice([0, 5, 50, 100, 101, 250, 1_000]) + rng.randrange(5), rng.choice(["a", "a", "b", None]), rng.choice([None, 1, 1, 2]), "x") for i in range(1_500)]
    rows += [(None, None, None, None, "x"), *rows[:5]]
    items = spark.createDataFrame(rows, "doc_id long, n_tokens long, source string, cluster long, bin_id string")
    got = packing.pack(items, capacity=100, per_source=2).collect()
    total, bins = defaultdict(int), defaultdict(list)
    for r in got:
        total[r.doc_id] += r.n_tokens
        bins[r.bin_id].append(r)
    want = defaultdict(int)
    for i, n, *_ in rows:
        want[i] += n or 0
    assert total == want
    of = {i: (s, c) for i, _, s, c, _ in rows}
    assert sum(len(b) for b in bins.values()) == sum(max(1, math.ceil((n or 0) / 100)) for _, n, *_ in rows)
    for b in bins.values():
        b.sort(key=lambda r: r.bin_offset)
        assert all(x.bin_offset + x.n_tokens <= y.bin_offset for x, y in zip(b, b[1:]))  # noqa: B905
        assert b[-1].bin_offset + b[-1].n_tokens <= 100
        assert max(Counter(of[r.doc_id][0] for r in b if of[r.doc_id][0]).values(), default=0) <= 2
        assert max(Counter(of[r.doc_id][1] for r in b if of[r.doc_id][1]).values(), default=0) <= 1
    assert packing.pack(items.limit(0)).count() == 0


def test_packed_documents(spark):
    from riskspark.llm.queries import vocabulary

    got = packing.pack_documents(odd_docs(spark), vocabulary("piece_bpe_32k.model")).collect()
    assert {r.doc_id for r in got} == {None, 1, 2, 3, 4, 5} and max(r.piece for r in got) > 2


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
        assert docs.columns == columns and 0 < docs.count() <= n, name
        n = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert corpus_pipeline.run(spark, sf).count() == packed.count()


@pytest.mark.parametrize("fragment", [50, 1_000_000])
def test_near_copies_share_no_bin(spark, monkeypatch, fragment):
    from riskspark.llm import setjoin
    from riskspark.llm.queries import vocabulary

    monkeypatch.setattr(setjoin, "FRAGMENT", fragment)
    base = [f"w{k}" for k in range(100)]
    # two words changed in each: the second and third are below 0.8 to each other, both near the first
    texts = [base, [*base[:20], "x", *base[21:40], "x", *base[41:]], [*base[:60], "y", *base[61:80], "y", *base[81:]], [f"v{k}" for k in range(100)]]
    docs = spark.createDataFrame([(i, " ".join(t), f"s{i}") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    bins = {r.doc_id: r.bin_id for r in packing.pack_documents(docs, vocabulary("piece_bpe_32k.model")).collect()}
    assert len({bins[0], bins[1], bins[2]}) == 3 and bins[3] in (bins[0], bins[1], bins[2])


def test_tokens_are_counted_in_the_pass_of_the_join(spark, monkeypatch):
    """Copies, null texts and null or repeated ids keep their own tokens and source."""
    from riskspark.llm.queries import vocabulary

    path = vocabulary("piece_bpe_32k.model")
    texts = [None, "", " \n", "eins zwei drei", " ".join(f"w{k}" for k in range(50)), "Ein▁Satz ä \U0001f600."]
    rows = [(None if i == 4 else i // 2, texts[i % 6], None if i % 7 == 0 else f"s{i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    want = sorted(map(str, packing.items_of(docs, path).collect()))
    packed = sorted(str((r.doc_id, r.n_tokens)) for r in packing.items_of(docs, path).collect())
    monkeypatch.setattr(packing, "items_of", None)
    assert sorted(map(str, packing.near_items(docs, path).collect())) == want
    assert sorted(str((r.doc_id, r.n_tokens)) for r in packing.pack_documents(docs, path).collect()) == packed


def test_words_are_hashed_and_counted_many_at_a_time():
    """Shingles by XXH64 of the words, tokens as the library counts them; Python sees neither word by word."""
    import random

    import numpy as np
    import xxhash

    from riskspark.llm import setjoin, tokens
    from riskspark.llm.queries import vocabulary

    rng = random.Random(7)
    plain = [" ".join("".join(rng.choices("abcXYZ019.,", k=rng.randint(1, 12))) for _ in range(300)) for _ in range(40)]
    odd = ["".join(rng.choices(" ▁\n\r\tabC.1ä中\U0001f600​　\x00\x1c", k=rng.randint(0, 30))) for _ in range(2000)]
    long = [" ".join(c * n for n in (30, 31, 32, 33, 70)) for c in "abä"]
    texts = [t.encode() for t in [*plain, *odd, *long, "", " ", "\n", "  a  ", "<s> a<0x0A>"]]
    known = setjoin.WordHashes()
    for x, got in zip(texts, setjoin.shingle_sets(texts, 2, known), strict=True):
        words = x.lower().split()
        w = np.array([xxhash.xxh64_intdigest(b, setjoin.SEED) for b in words], np.uint64)
        assert np.array_equal(got, setjoin.sets_in(w, [len(w)], 2)[0])
    assert all(len(w) > 31 for w in known)

    class Counting:
        def __init__(self, model):
            self.model, self.calls = model, 0

        def encode(self, text):
            self.calls += 1
            return self.model.encode(text)

    pieces = tokens.Pieces(vocabulary("piece_bpe_32k.model"))
    model = pieces.model
    pieces.model = Counting(model)
    want = [len(model.encode(t.decode())) for t in texts]
    assert pieces.counts(texts[: len(plain)]) == want[: len(plain)] and pieces.model.calls < 40
    assert pieces.counts(texts) == want == pieces.counts(texts)


def test_parts_that_give_way_are_counted_again(monkeypatch):
    from riskspark.llm import tokens
    from riskspark.llm.queries import vocabulary

    monkeypatch.setattr(tokens, "PLACES", 4)
    pieces = tokens.Pieces(vocabulary("piece_bpe_32k.model"))
    texts = [f"word{k} other{k % 3}\nlast {k}" for k in range(100)]
    want = [len(pieces.model.encode(t)) for t in texts]
    assert [pieces.counts([t.encode()])[0] for t in texts] == want == pieces.counts([t.encode() for t in texts])

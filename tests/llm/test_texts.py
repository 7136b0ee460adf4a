"""Tokens, fingerprints and lines against plain versions and the libraries."""

import hashlib
import math
import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riskspark.llm import bpe, lines, simhash, tokens
from riskspark.llm.queries import vocabulary

DOCS = "doc_id long, text string, source string, score double, rank int"


def docs_of(spark, texts):
    """With further columns of clashing names."""
    return spark.createDataFrame([(i, t, "s", 0.5, 1) for i, t in texts], DOCS)


def odd_texts(n=150, size=60):
    rng = random.Random(7)
    pick = lambda: rng.choice([" ", "\n", "\t", "a", "The", "don't", "é", "漢", "1", ".", "!!", "▁", " ", "\x1c", "<|endoftext|>", "Σ",
                               chr(rng.randrange(32, 127)), chr(rng.randrange(0xA0, 0xD7FF)), chr(rng.randrange(0x10000, 0x1FFFF))])
    made = ["".join(pick() for _ in range(rng.randrange(size))) for _ in range(n)]
    return [None, "", " ", "\n", "<|startoftext|>", "aaaaaaaaaa aaa", "İstanbul ΑΣ", *made, "ab cd " * 20_000, "x" * 50_000]


def test_bpe_equals_library(spark):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = list(enumerate(odd_texts()))
    got = {r.doc_id: r for r in bpe.encode(docs_of(spark, texts + texts[:3]), path).collect()}
    for i, t in texts:
        want = library.encode(t or "", add_special_tokens=False).ids
        assert list(got[i].ids) == want
        assert got[i].decoded == library.decode(want, skip_special_tokens=False)


def test_bpe_cache_can_overflow(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe, "CACHE", 20)
    path = vocabulary("word_bpe_49k.json")
    coder, library = bpe.WordBpe(path), Tokenizer.from_file(path)
    texts = [t or "" for t in odd_texts(60)]
    for t, ids in zip(texts, coder.encode_batch(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_bpe_digest(spark):
    path = vocabulary("word_bpe_49k.json")
    row = bpe.encode_digest(docs_of(spark, [(1, None)]), path).first()
    assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest())
    assert bpe.encode_digest(docs_of(spark, []), path).count() == 0


def test_token_counts_equal_library(spark):
    import sentencepiece

    path = vocabulary("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = list(enumerate(odd_texts(400)))
    got = {r.doc_id: r for r in tokens.count_tokens(docs_of(spark, texts), path, limit=10).collect()}
    for i, t in texts:
        n = len(library.encode(t or ""))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 10)
    assert tokens.count_tokens(docs_of(spark, []), path, limit=10).count() == 0


def plain_fingerprint(text, words):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    parts = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, radius):
    """{id: component} from {id: fingerprint}."""
    ids = sorted(prints)
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in ids:
        for b in ids:
            if b < a and (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {i: top(i) for i in ids}


def near_copies(rng, n, words=300):
    base = [rng.choice("abcdefghijk") + str(rng.randrange(99)) for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(3)):
            own[rng.randrange(words)] = "w" + str(rng.randrange(999))
        out.append(" ".join(own))
    return out


def test_simhash_against_brute_force(spark):
    rng = random.Random(5)
    texts = [t for t in odd_texts(40) if t is None or len(t) < 3_000]
    for n in (2, 5, 40):
        texts += near_copies(rng, n)
    texts += texts[:4] + ["same text of five words"] * 30
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in simhash.query(docs_of(spark, rows)).collect()}
    prints = {i: plain_fingerprint(t, 4) for i, t in rows}
    want = brute_components(prints, 4)
    assert {i: (int(r.fingerprint, 16), r.component_id) for i, r in got.items()} == {i: (prints[i], want[i]) for i in prints}
    assert simhash.query(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("tree", [8, 4096])
def test_links_of_hot_shards(spark, monkeypatch, tree):
    monkeypatch.setattr(simhash, "TREE", tree)
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = {b ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(7))) for b in base for _ in range(40)}
    prints = dict(enumerate(sorted(prints)))
    signed = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints.values()], "fp long")
    want = brute_components(prints, 4)
    number = {x: i for i, x in prints.items()}
    up = {i: i for i in prints}
    for r in simhash.links(signed, 4).collect():
        a, b = r.src % (1 << 64), r.dst % (1 << 64)
        assert 0 < (a ^ b).bit_count() <= 4
        x, y = up[number[a]], up[number[b]]
        up = {i: min(x, y) if c in (x, y) else c for i, c in up.items()}
    assert up == want


def brute_candidates(texts, radius, similarity=0.8):
    """Smallest node of each component; ``texts``: (node, n, fps)."""
    size = {i: math.floor(math.log(max(n, 1)) / math.log(1.0001 / similarity)) for i, n, _ in texts}
    up = {i: i for i, _, _ in texts}
    for k, (a, _, x) in enumerate(texts):
        for b, _, y in texts[:k]:
            near = abs(size[a] - size[b]) <= 1 and any(((p ^ q) % (1 << 64)).bit_count() <= radius for p, q in zip(x, y, strict=True))
            if near and up[a] != up[b]:
                low, high = sorted((up[a], up[b]))
                up = {i: low if c == high else c for i, c in up.items()}
    ends = [c for c in set(up.values()) if sum(x == c for x in up.values()) > 1]
    return {i: c for i, c in up.items() if c in ends}


def printed(rng, groups, least, most, prints):
    """Groups of texts whose fingerprints stray from those of the first by up to 6 bits, of about as many shingles."""
    out = []
    for g in groups:
        base, n = [rng.getrandbits(64) for _ in range(prints)], rng.randrange(least, most)
        for _ in range(g):
            own = [b ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(7))) for b in base]
            out.append((len(out), n + rng.randrange(9), [x - (1 << 64) if x >> 63 else x for x in own]))
    return out


@pytest.mark.parametrize(("shard", "whole", "rows"), [(500_000, 4, 1), (60, 1000, None), (60, 1, None), (700, 0, 9)])
def test_candidates_in_one_task_chunks_or_blocks(spark, monkeypatch, shard, whole, rows):
    """All deals find the same components: whole classes, chunks of them, blocks of bits with hot shards, and without."""
    monkeypatch.setattr(simhash, "SHARD", shard)
    monkeypatch.setattr(simhash, "WHOLE", whole)
    texts = printed(random.Random(4), [1] * 20 + [2] * 15 + [70], 90, 140, 2)
    texts += [(1000 + i, n, x) for i, n, x in texts[20:40]]                 # equal fingerprints
    given = spark.createDataFrame(texts, "node long, n long, fps array<long>")
    got = {r.node: r.label for r in simhash.candidates(given, 8, 0.8).collect()}
    assert got == brute_candidates(texts, 8)
    if rows:
        assert simhash.meetings(given, 8, 0.8).count() == len(texts) * 2 * 2 * rows
    assert simhash.candidates(given.limit(0), 8, 0.8).count() == 0


def test_candidates_of_more_texts_shuffle_no_more_for_each(spark, monkeypatch):
    """Shards as small as if a thousand times as many texts were there: a text still goes to a task once for each seed and class."""
    monkeypatch.setattr(simhash, "SHARD_ROWS", simhash.SHARD_ROWS / 10_000)
    dirs = [Path(str(d)) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f: f.stat().st_size for d in dirs for f in d.rglob("shuffle_*.data")}
    given = spark.createDataFrame(printed(random.Random(9), [1] * 300, 90, 140, simhash.PRINTS), "node long, n long, fps array<long>")
    before = files()
    simhash.candidates(given, 8, 0.8)
    assert sum(n for f, n in files().items() if f not in before) < 300 * 2 * simhash.PRINTS * 64


def test_links_within_one_task():
    """Long runs of equal bits, short ones, and fingerprints that are all far apart."""
    rng = np.random.default_rng(2)

    def labels(n, a, b):
        forest = simhash.Forest(n)
        forest.join(a, b)
        return forest.label.tolist()

    for n, bases, flips in ((3_000, 3, 6), (2_000, 300, 5), (2_500, 2_500, 0)):
        fp = rng.integers(0, 1 << 63, bases, dtype=np.uint64)[rng.integers(0, bases, n)]
        for _ in range(flips):
            fp = fp ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
        fp = np.unique(fp)
        a, b = simhash.near_links(fp, 8)
        assert (np.bitwise_count(fp[a] ^ fp[b]) <= 8).all()
        assert labels(len(fp), a, b) == labels(len(fp), *np.nonzero(np.bitwise_count(fp[:, None] ^ fp) <= 8))


def test_one_of_each(spark):
    texts = [(1, "a b c d e f"), (2, "A b  c d e f"), (3, "other words that stand here"), (3, "other words that stand here"), (None, "a b c d e f")]
    kept = simhash.one_of_each(docs_of(spark, texts))
    assert kept.columns == ["doc_id", "text", "source", "score", "rank"]
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3]


def plain_lines(texts, least_chars=40, least_docs=5):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, t in texts:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= least_chars:
                holders[key(line)].add(i)
    out = []
    for i, t in texts:
        every = (t or "").split("\n")
        stay = [x for x in every if i is None or len(holders.get(key(x), ())) < least_docs or i == max(holders[key(x)])]
        out.append((i, len(every), len(every) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


def line_texts():
    rng = random.Random(11)
    shared = [f"Line number {k} of all that are shared, é漢 long enough" for k in range(12)]
    texts = [(i, "\n".join(rng.choice(["  " + s.upper() + "\t", s, s, "short", f"own line {i} of its document, which is long enough {rng.random()}", ""])
                           for s in rng.sample(shared, rng.randrange(12)))) for i in range(60)]
    return texts + [(60, None), (61, ""), (62, "\n\n"), (63, (shared[0] + "\n") * 3_000), (None, shared[1]), *texts[:3]]


def test_lines_against_plain_version(spark):
    texts = line_texts()
    got = lines.query(docs_of(spark, texts)).collect()
    assert sorted(map(tuple, got), key=str) == plain_lines(texts)
    assert lines.query(docs_of(spark, [])).count() == 0


def test_lines_without_broadcast_filters(spark, monkeypatch):
    monkeypatch.setattr(lines, "FILTER_BYTES", -1)
    texts = line_texts()
    assert sorted(map(tuple, lines.query(docs_of(spark, texts)).collect()), key=str) == plain_lines(texts)


@pytest.mark.parametrize("filter_bytes,rows", [(300, 1_000_000), (64 << 20, 3), (300, 3)])
def test_lines_with_filters_in_parts_and_rare_counts(spark, monkeypatch, filter_bytes, rows):
    monkeypatch.setattr(lines, "FILTER_BYTES", filter_bytes)
    monkeypatch.setattr(lines, "COUNT_ROWS", rows)
    asked, before = [], lines.screened
    monkeypatch.setattr(lines, "screened", lambda refs, bits, shards: asked.append(len(bits.value)) or before(refs, bits, shards))
    texts = line_texts()
    assert sorted(map(tuple, lines.query(docs_of(spark, texts)).collect()), key=str) == plain_lines(texts)
    assert (len(asked) > 1) == (filter_bytes == 300) and sum(asked) >= 1


def test_lines_clashing_columns(spark):
    docs = spark.createDataFrame([(i, "A line that all of these documents share, long enough\nown", i, "x") for i in range(6)],
                                 "doc_id long, text string, _lost_of long, `_LOST` string")
    made = lines.dedup(docs)
    assert made.columns == docs.columns
    assert sorted((r.doc_id, r.text.count("\n"), r["_LOST"]) for r in made.collect()) == [(i, int(i == 5), "x") for i in range(6)]


def test_lines_can_be_taken_out_again(spark):
    texts = [t for t in line_texts() if t[0] is not None]
    state = lambda index: (sorted(map(tuple, index._read("counts").select("hi", "lo", "n_docs", "last_doc").collect())),
                           sorted(map(tuple, index.drops().collect())))
    half = lines.LineIndex(spark).insert(docs_of(spark, texts[:30]))
    before = state(half)
    half.insert(docs_of(spark, texts[30:] + texts[:2]))
    assert state(half) == state(lines.LineIndex(spark).insert(docs_of(spark, texts)))
    gone = {i for i, _ in texts[30:]} - {i for i, _ in texts[:30]}
    half.delete(spark.createDataFrame([(i,) for i in gone], "doc_id long"))
    assert state(half) == before


def test_dedup_keeps_columns(spark):
    long = "A line that stands in every one of these documents."
    docs = spark.createDataFrame([(i, f"{long}\nown {i}", "en", "s", 9, "x") for i in range(6)], "doc_id long, text string, lang string, source string, n_chars long, hi string")
    out = lines.dedup(docs)
    assert out.schema == docs.schema
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got[0] == ("own 0", 5) and got[5] == (f"{long}\nown 5", 9)


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    hi, lo = rng.integers(-(2**63), 2**63 - 1, (2, 5_000))
    made = lines.Cuckoo.holding(hi, lo)
    assert made.contains(hi, lo).all()
    x, y = rng.integers(-(2**63), 2**63 - 1, (2, 100_000))
    assert made.contains(x, y).mean() < 1e-3
    made.remove(hi[:2_500], lo[:2_500])
    made = lines.Cuckoo.from_bytes(made.to_bytes())
    assert made.contains(hi[2_500:], lo[2_500:]).all() and np.count_nonzero(made.tags) == 2_500


def test_held_out_rule(spark):
    import zlib

    from riskspark.llm.nbsvm import held_out

    got = spark.range(50).select(F.col("id"), held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def test_groups_in_one_task_or_in_rounds(spark, monkeypatch):
    rng = random.Random(8)
    texts = [t for n in (1, 3, 30) for t in near_copies(rng, n, 120)] + near_copies(rng, 10, 12) + ["", None, " ", "a b", "A  b"]
    docs = docs_of(spark, list(enumerate(texts)))
    plain = sorted(r.doc_id for r in simhash.one_of_each(docs).collect())
    monkeypatch.setattr(simhash, "GROUP_ROWS", 0)
    assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == plain
    # what went is near something that stays
    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    for i, t in enumerate(texts):
        s = shingles(t)
        near = [j for j in plain if len(s & shingles(texts[j])) >= 0.8 * len(s | shingles(texts[j]))]
        assert i in plain or near


def test_pairs_just_above_the_threshold(spark):
    rng = random.Random(21)
    texts = []
    for n in range(80):
        words = [f"{n}x{k}" for k in range(300)]
        other = list(words)
        for k in range(3, 3 + rng.randrange(4, 7) * 45, 45):       # 4 to 6 words: 20 to 30 of about 300 shingles
            other[k] = "new"
        texts += [" ".join(words), " ".join(other)]
    kept = simhash.one_of_each(docs_of(spark, list(enumerate(texts)))).count()
    # one fingerprint leaves about a third of such pairs; twelve leave about one in a hundred
    assert kept <= 82

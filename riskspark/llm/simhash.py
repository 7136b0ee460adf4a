"""SimHash near-duplicates, linked through BK-trees.

Each text gets a 64-bit fingerprint: the majority of the bits of the hashes of its shingles.
Texts with one fingerprint are one node, so copies never meet each other. Two fingerprints
that differ in at most r bits agree in one of r + 1 blocks of bits; a block and its value
name a shard. Every shard holds its fingerprints as a BK-tree (children keyed by their
Hamming distance to the parent), and a search at distance d from a node follows only the
edges from d - r to d + r.

The trees are handed to the tasks that search them by a join on the shard, not from the
driver: one broadcast of all trees would pass all fingerprints through the driver. A shard
with many fingerprints is held as several trees of at most ``TREE`` entries, and its
fingerprints visit each of them in turn, so no task holds more than a tree and a slice of
visitors. A task hands on a spanning forest of the links that it finds, never all pairs.

Results: a null or empty text, or one without words, has fingerprint 0 and is linked as any
other; repeated rows get one row each; a row without id takes part and its component is the
smallest id of the others, or null; further columns are not read; an empty table gives an
empty table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, chain, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm import setjoin
from riskspark.llm.common import has_repeats, map_texts, row_count, staged
from riskspark.operators.components import connected_components

SEED = 42
#: entries of one tree, and rows of shards that share a task
TREE, TASK_ROWS = 4_096, 20_000
SHARD_ROWS = 64
#: texts, and distinct shingles of all of them, up to which a group of candidates is settled in one task
GROUP_ROWS, GROUP_SHINGLES = 2_000, 2_000_000
#: shingles that are held at once
BLOCK = 1 << 17
#: fingerprints by which candidates are found, and what their hashes are mixed with
PRINTS = 12
MIX = np.array([xxhash.xxh64_intdigest(bytes([k]), SEED) for k in range(PRINTS)], np.uint64)
#: fingerprints of a shard up to which all are measured directly, rows with equal bits that meet one by one, and pairs that are held at once
DIRECT, RUN, PAIRS = 512, 512, 1 << 20
#: fingerprints that one task searches, and how many times that a class may hold to be cut into chunks only
SHARD, WHOLE = 500_000, 4
#: hot shards whose sizes are broadcast, and ids
HOT_SENT, IDS_SENT = 100_000, 1_000_000


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of each shingle, as often as it occurs; of the whole sequence if it is shorter."""
    # A-Z in lower case; bytes.split() cuts at x20 and x09-x0D
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    starts = [0, *accumulate(len(p) + 1 for p in parts)]
    h = xxhash.xxh64_intdigest
    return np.array([h(joined[a : b - 1], SEED) for a, b in zip(starts, starts[words:])], np.uint64)  # noqa: B905


def fingerprint(text: str, words: int) -> int:
    """Bit i is set if it is set in over half of the hashes, repeats included."""
    h = shingle_hashes(text, words)
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), BLOCK):
        part = h[k : k + BLOCK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): one row for each text; fp as a signed long."""

    def rows(ids, texts):
        return [ids, np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, id_col, text_col, f"`{id_col}` {kind}, fp long", rows)


# -- BK-trees ----------------------------------------------------------------------------
def build(fp: np.ndarray) -> np.ndarray:
    """A BK-tree over distinct fingerprints: child[node, distance], -1 for none; node 0 is the root.

    Level by level: all that stand at a node measure their distance to it, and the first of
    each distance becomes the child that the others of that distance go to.
    """
    child = np.full((len(fp), 65), -1, np.int32)
    here, at = np.arange(1, len(fp)), np.zeros(max(len(fp) - 1, 0), np.int64)
    while len(here):
        d = np.bitwise_count(fp[here] ^ fp[at]).astype(np.int64)
        _, first, group = np.unique(at * 65 + d, return_index=True, return_inverse=True)
        child[at[first], d[first]] = here[first]
        to = here[first][group]
        rest = to != here
        here, at = here[rest], to[rest]
    return child


def search(tree: np.ndarray, child: np.ndarray, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, node) of fingerprints within ``radius``; each step goes one level down."""
    for k in range(0, len(queries), 1024):
        q = np.arange(k, min(k + 1024, len(queries)))
        node = np.zeros(len(q), np.int64)
        while len(q):
            d = np.bitwise_count(queries[q] ^ tree[node]).astype(np.int64)
            near = d <= radius
            yield q[near], node[near]
            edges = d[:, None] + np.arange(-radius, radius + 1)
            inside = (edges >= 0) & (edges <= 64)
            to = np.where(inside, child[node[:, None], np.clip(edges, 0, 64)], -1)
            row, col = np.nonzero(to >= 0)
            q, node = q[row], to[row, col].astype(np.int64)


class Forest:
    """Joins found links on the way; keeps one link for each join."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Positions of links that join what was apart and are enough for all of them."""
        kept = []
        left = np.arange(len(a))
        while len(left):
            x, y = self.label[a[left]], self.label[b[left]]
            apart = x != y
            left, high, low = left[apart], np.maximum(x, y)[apart], np.minimum(x, y)[apart]
            # each label goes over to one smaller label, so no ring can form
            tops, first = np.unique(high, return_index=True)
            kept.append(left[first])
            up = np.arange(len(self.label))
            up[tops] = low[first]
            while (up[up] != up).any():
                up = up[up]
            self.label = up[self.label]
        return np.concatenate(kept) if kept else np.zeros(0, np.int64)


def shard_links(owners: np.ndarray, visitors: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between a tree's entries and its visitors."""
    child = build(owners)
    both = np.concatenate([owners, visitors])
    names, where = np.unique(both, return_inverse=True)
    forest, left, right = Forest(len(names)), [], []
    for q, node in search(owners, child, visitors, radius):
        a, b = where[len(owners) + q], where[node]
        other = a != b
        a, b = a[other], b[other]
        if len(a):
            pair = np.unique(np.minimum(a, b) * len(names) + np.maximum(a, b))
            a, b = pair // len(names), pair % len(names)
            fresh = forest.join(a, b)
            left.append(names[a[fresh]])
            right.append(names[b[fresh]])
    none = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def small_links(fps: list[int], radius: int) -> list[tuple[int, int]]:
    """As ``shard_links`` of a shard with itself, for a handful of entries: search, then insert."""
    links: list[tuple[int, int]] = []
    root = fps[0]
    edges: dict[int, dict[int, int]] = {root: {}}
    for f in fps[1:]:
        stack = [root]
        while stack:
            node = stack.pop()
            d = (node ^ f).bit_count()
            if d <= radius:
                links.append((node, f))
            stack += [c for e, c in edges[node].items() if d - radius <= e <= d + radius]
        node = root
        while True:
            d = (node ^ f).bit_count()
            if d not in edges[node]:
                edges[node][d] = f
                edges[f] = {}
                break
            node = edges[node][d]
    return links


def agreeing(rows: int, radius: int) -> int:
    """In how many blocks of bits the fingerprints of a shard agree.

    With radius + k blocks, two fingerprints within the radius agree in k of them, whatever k.
    More blocks make more and smaller shards; taken are as few as keep a shard of evenly
    spread fingerprints below ``SHARD_ROWS``.
    """
    return next((k for k in range(1, 5) if rows / 2 ** (64 * k / (radius + k)) <= SHARD_ROWS), 5)


def shard_keys(radius: int, agree: int) -> list[Column]:
    """For each choice of ``agree`` blocks: its number and the bits in it."""
    blocks = radius + agree
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), agree)):
        value = F.lit(0).cast("long")
        for i in chosen:
            width = cuts[i + 1] - cuts[i]
            bits = F.shiftrightunsigned("fp", cuts[i]).bitwiseAND(F.lit((1 << width) - 1))
            value = F.shiftleft(value, width).bitwiseOR(bits)
        keys.append(F.struct(F.lit(n).cast("int").alias("block"), value.alias("value")))
    return keys


def links(prints: DataFrame, radius: int) -> DataFrame:
    """(src, dst): links between distinct fingerprints ``fp`` that differ in 1 to ``radius`` bits; enough of
    them to join all that are linked."""
    rows = row_count(prints)
    keys = shard_keys(radius, agreeing(rows, radius))
    entries = prints.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.block", "k.value")
    sizes = entries.groupBy("block", "value").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    tasks = max(1, math.ceil(rows * len(keys) / TASK_ROWS))
    sized = entries.join(sizes, ["block", "value"]).withColumn("trees", F.ceil(F.col("size") / (TREE / 2)).cast("int"))
    sized = sized.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int"))
    # a fingerprint stands in its own tree and visits that tree and the later ones
    placed = sized.withColumn("tree", F.explode(F.expr("sequence(own, trees - 1)")))
    placed = placed.withColumn("task", F.when(F.col("trees") == 1, F.pmod(F.xxhash64("block", "value"), F.lit(tasks))).otherwise(
        F.xxhash64("block", "value", "tree"))).withColumn("part", F.when(
            F.col("trees") == 1, F.lit(0)).otherwise(F.pmod(F.col("own"), F.lit(1 << 16))))
    # of a hot shard: the tree goes to every slice of its visitors
    owner = placed.filter((F.col("trees") > 1) & (F.col("own") == F.col("tree")))
    copies = owner.withColumn("part", F.explode(F.expr("sequence(0, own)"))).withColumn("visits", F.lit(False))
    visitors = placed.withColumn("visits", F.lit(True))
    dealt = visitors.unionByName(copies).select("task", "part", "block", "value", "fp", "visits", F.col("trees") == 1)
    dealt = dealt.toDF("task", "part", "block", "value", "fp", "visits", "whole")

    def found(pdf: pd.DataFrame) -> pd.DataFrame:
        src, dst = [], []
        pdf = pdf.sort_values(["block", "value", "fp"], kind="stable")
        fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        if pdf["whole"].iloc[0]:
            block, value = pdf["block"].to_numpy(np.int64), pdf["value"].to_numpy(np.int64)
            first = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (value[1:] != value[:-1])))
            for a, b in zip(first, np.append(first[1:], len(block)), strict=True):
                if b - a <= 64:
                    for x, y in small_links(fp[a:b].tolist(), radius):
                        src.append(np.uint64(x))
                        dst.append(np.uint64(y))
                else:
                    x, y = shard_links(fp[a:b], fp[a:b], radius)
                    src += x.tolist()
                    dst += y.tolist()
        else:
            visits = pdf["visits"].to_numpy(bool)
            x, y = shard_links(fp[~visits], fp[visits], radius) if (~visits).any() else ([], [])
            src, dst = list(x), list(y)
        return pd.DataFrame({"src": np.array(src, np.uint64).view(np.int64), "dst": np.array(dst, np.uint64).view(np.int64)})

    return dealt.groupBy("task", "part").applyInPandas(found, "src long, dst long")


def linked(nodes: DataFrame, radius: int) -> DataFrame:
    """(fp, label): the fingerprints that have links, with a label for each component."""
    found = staged(links(nodes.select("fp"), radius).distinct())
    ends = found.select("src").union(found.select("dst")).distinct().withColumnRenamed("src", "fp")
    # only fingerprints with a link go through the rounds
    joined = connected_components(ends.select(F.col("fp").alias("node"), F.col("fp").alias("label")), found)
    return joined.select(F.col("node").alias("fp"), "label")


def components(docs: DataFrame, words: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id): ``component_id`` is the smallest id that links lead to, itself included."""
    prints = staged(fingerprints(docs, words, id_col, text_col))
    nodes = staged(prints.groupBy("fp").agg(F.min(id_col).alias("first_id")))
    named = nodes.join(linked(nodes, radius), "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"), "first_id")
    least = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of = named.join(least, "label").select("fp", "component_id")
    return prints.join(of, "fp").select(id_col, "fp", "component_id")


def query(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id."""
    return components(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# -- candidates by several fingerprints ----------------------------------------------------
def seeded_fingerprints(h: np.ndarray) -> np.ndarray:
    """``PRINTS`` fingerprints of distinct shingle hashes, as signed longs; each mixes the hashes with a seed of its own."""
    ones = np.zeros((PRINTS, 64), np.int64)
    for k in range(0, len(h), 255):                   # so many ones fit a byte
        x = h[k : k + 255] ^ MIX[:, None]
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
        bits = np.unpackbits(x.view(np.uint8).reshape(PRINTS, -1, 8), axis=2, bitorder="little")
        ones += bits.sum(axis=1, dtype=np.uint8)
    return np.packbits(2 * ones > len(h), axis=1, bitorder="little").view(np.int64)[:, 0]


def long_run(fp: np.ndarray, label: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of links that join whatever labels the links within the radius join.

    A few rows at a time meet all others. Most near ones soon have one label; once all that have
    another one have met the others, no pair of different labels is left.
    """
    label = np.unique(label, return_inverse=True)[1]
    forest, unmet, left, right, rows = Forest(int(label.max()) + 1), np.ones(len(fp), bool), [], [], 1
    while True:
        now = forest.label[label]
        asking = np.flatnonzero(unmet & (now != np.bincount(now).argmax()))[:rows]
        if not len(asking):
            break
        unmet[asking] = False
        a, b = np.nonzero((np.bitwise_count(fp[asking, None] ^ fp) <= radius) & (now[asking, None] != now))
        a = asking[a]
        kept = forest.join(label[a], label[b])
        left.append(a[kept])
        right.append(b[kept])
        rows = max(1, min(4 * rows, PAIRS // len(fp)))
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def near_links(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of a spanning forest of the links among distinct fingerprints of any number.

    As the shards above, within one task: for each choice of blocks the fingerprints are sorted
    by the bits in them, and those with the same bits meet.
    """
    forest = Forest(len(fp))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def join(a: np.ndarray, b: np.ndarray) -> None:
        kept = forest.join(a, b)
        left.append(a[kept])
        right.append(b[kept])

    if len(fp) <= DIRECT:
        join(*np.nonzero(np.triu(np.bitwise_count(fp[:, None] ^ fp) <= radius, 1)))
        return left[-1], right[-1]
    agree = agreeing(len(fp), radius)
    blocks = radius + agree
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    for chosen in combinations(range(blocks), agree):
        bits = fp & np.uint64(sum((1 << cuts[i + 1]) - (1 << cuts[i]) for i in chosen))
        order = np.argsort(bits)
        bits, row = bits[order], fp[order]
        first = np.flatnonzero(np.append(True, bits[1:] != bits[:-1]))
        size = np.diff(np.append(first, len(row)))
        label = forest.label[order]
        apart = np.minimum.reduceat(label, first) != np.maximum.reduceat(label, first)
        long = apart & (size > RUN)
        later = np.repeat(first + size, size) - np.arange(len(row)) - 1         # how many of its run stand behind a row
        later[np.repeat(long | ~apart, size)] = 0
        at, k, found, n = np.flatnonzero(later), 1, [], 0
        while len(at):
            near = at[np.bitwise_count(row[at] ^ row[at + k]) <= radius]
            a, b = order[near], order[near + k]
            fresh = forest.label[a] != forest.label[b]
            found.append((a[fresh], b[fresh]))
            n += len(found[-1][0])
            k += 1
            at = at[later[at] >= k]
            if n > PAIRS or n and not len(at):
                join(*(np.concatenate(x) for x in zip(*found, strict=True)))
                found, n = [], 0
        for start, end in zip(first[long], (first + size)[long], strict=True):
            of = order[start:end]
            a, b = long_run(fp[of], forest.label[of], radius)
            found.append((of[a], of[b]))
        if found:
            join(*(np.concatenate(x) for x in zip(*found, strict=True)))
    return np.concatenate(left), np.concatenate(right)


def meetings(texts: DataFrame, radius: int, similarity: float) -> DataFrame:
    """(shard, pair, fp, node): each ``shard`` and ``pair`` names the fingerprints that one task searches.

    Only texts with numbers of shingles that ``similarity`` allows meet: a text stands in the class
    of its number and in the next, classes being 1 / ``similarity`` wide. Up to ``SHARD``
    fingerprints of a class and a seed go to one task, once each. Those of a larger class are cut
    into chunks by a hash of the text, and a task gets two chunks; beyond ``WHOLE`` times ``SHARD``
    they are first dealt out by each block of their bits, and only hot shards are cut. So a text
    goes to a bounded number of tasks, however many texts there are.
    """
    width = math.log(1.0001 / similarity)
    size = F.floor(F.log(F.greatest("n", F.lit(1)).cast("double")) / width)
    of_size = {r["size"]: r["count"] for r in texts.select(size.alias("size")).groupBy("size").count().collect()}
    rows = {c: of_size.get(c, 0) + of_size.get(c - 1, 0) for c in of_size.keys() | {c + 1 for c in of_size}}
    cut = {c: math.ceil(2 * n / SHARD) for c, n in rows.items() if SHARD < n <= WHOLE * SHARD}
    large = [c for c, n in rows.items() if n > WHOLE * SHARD]
    dealt = texts.select("node", F.explode(F.array(size, size + 1)).alias("class"), "fps").select(
        "node", "class", F.posexplode("fps").alias("seed", "fp"))
    keys = shard_keys(radius, 1)
    of = (F.col("class") * PRINTS + F.col("seed")) * len(keys)
    chunks = F.when(F.lit(False), 1)
    for c, n in cut.items():
        chunks = chunks.when(F.col("class") == c, n)
    placed = dealt.filter(~F.col("class").isin(large)).select(
        F.shiftleft(of, 40).alias("shard"), "fp", "node", chunks.otherwise(1).alias("chunks"))
    if large:
        shard = [F.shiftleft(of + n, 40).bitwiseXOR(k["value"]) for n, k in enumerate(keys)]
        entries = dealt.filter(F.col("class").isin(large)).select(F.explode(F.array(*shard)).alias("shard"), "fp", "node")
        hot = staged(entries.groupBy("shard").count().filter(F.col("count") > SHARD).select(
            "shard", F.ceil(F.col("count") * 2 / SHARD).cast("int").alias("hot")))
        placed = placed.unionByName(entries.join(F.broadcast(hot) if row_count(hot) <= HOT_SENT else hot, "shard", "left").select(
            "shard", "fp", "node", F.coalesce("hot", F.lit(1)).alias("chunks")))
    # a text of several chunks goes with each other chunk once, so all pairs of chunks meet
    placed = placed.withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    pairs = F.expr("transform(filter(sequence(0, chunks - 1), x -> x != own), x -> shiftleft(cast(least(x, own) as long), 32) + greatest(x, own))")
    return placed.select(
        "shard", F.explode(F.when(F.col("chunks") == 1, F.array(F.lit(-1).cast("long"))).otherwise(pairs)).alias("pair"), "fp", "node")


def candidates(texts: DataFrame, radius: int, similarity: float) -> DataFrame:
    """(node, label): texts that links lead to, with a label for each component.

    ``texts``: (node, n, fps) with the number of distinct shingles and ``PRINTS`` fingerprints.
    Texts are linked if any of their fingerprints differ in at most ``radius`` bits and their
    numbers of shingles let them meet.
    """
    kind = texts.schema["node"].dataType.simpleString()

    def found(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[["fp", "node"]].sort_values(["fp", "node"])
        fp, node = pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["node"].to_numpy()
        new = np.append(True, fp[1:] != fp[:-1])
        first = np.flatnonzero(new)
        a, b = near_links(fp[first], radius)
        # texts with one fingerprint hang on the least of them
        src = np.concatenate([node[first[a]], node[first[np.cumsum(new) - 1]][~new]])
        return pd.DataFrame({"src": src, "dst": np.concatenate([node[first[b]], node[~new]])})

    near = meetings(texts, radius, similarity).groupBy("shard", "pair").applyInPandas(found, f"src {kind}, dst {kind}")
    edges = staged(near.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct())
    ends = edges.select("src").union(edges.select("dst")).distinct()
    return connected_components(ends.select(F.col("src").alias("node"), F.col("src").alias("label")), edges)


# -- one document of each group ------------------------------------------------------------
def same_words(text: str) -> int:
    """One number for texts with the same words, A-Z in either case."""
    return xxhash.xxh3_64_intdigest(b" ".join(text.encode("utf-8", "surrogatepass").lower().split()))


def distinct_shingles(texts: list[str], words: int) -> list[np.ndarray]:
    return setjoin.shingle_sets([t.encode("utf-8", "surrogatepass") for t in texts], words, setjoin.WordHashes())


def print_rows(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, same, n, fps): ``same_words``, the number of distinct shingles and their fingerprints."""

    def rows(ids, texts):
        sets = distinct_shingles(texts, words)
        return [ids, np.array([same_words(t) for t in texts], np.uint64).view(np.int64), [len(h) for h in sets],
                [seeded_fingerprints(h) for h in sets]]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs, "doc_id", "text", f"doc_id {kind}, same long, n long, fps array<long>", rows)


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, shingles array<long>): distinct shingles by hash."""

    def rows(ids, texts):
        return [ids, [h.view(np.int64) for h in distinct_shingles(texts, words)]]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs, "doc_id", "text", f"doc_id {kind}, shingles array<long>", rows)


def sent(ids: DataFrame) -> DataFrame:
    """Up to ``IDS_SENT`` rows of ids go to the texts that they are joined with, so the texts meet no shuffle."""
    return F.broadcast(ids) if row_count(ids) <= IDS_SENT else ids


def near_others(docs: DataFrame, words: int, radius: int, similarity: float) -> DataFrame:
    """Ids (column ``other``) of documents that have a near copy with a smaller id which stays.

    Components of texts with a fingerprint within the radius are candidates. In each, the
    smallest id leads: those with at least ``similarity`` of its shingles (shared over all) go,
    it stays, and the rest look for a leader again, until none is left. So each row meets one
    leader a round, never its whole group, and what goes is near a document that stays. A group
    of at most ``GROUP_ROWS`` texts goes through its rounds in one task, with the same outcome.
    """
    prints = staged(print_rows(docs.filter(F.col("doc_id").isNotNull()), words))
    texts = staged(prints.groupBy("same").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("fps").alias("fps")))
    copies = prints.join(texts.select("same", F.col("node").alias("first_id")), "same").filter(F.col("doc_id") != F.col("first_id")).select(
        F.col("doc_id").alias("other"))
    members = staged(candidates(texts, radius, similarity).select(F.col("node").alias("doc_id"), "label"))
    ids, named = sent(members.select("doc_id")), sent(members)
    left = staged(shingle_sets(docs.join(ids, "doc_id", "left_semi"), words).join(named, "doc_id"))
    gone = []
    while not left.isEmpty():
        sizes = left.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("shingles")).alias("all"))
        small = sizes.filter((F.col("rows") <= GROUP_ROWS) & (F.col("all") <= GROUP_SHINGLES)).select("label")
        done = left.join(small, "label", "left_semi").groupBy("label").applyInPandas(
            lambda pdf: led_others(pdf, similarity), f"other {left.schema['doc_id'].dataType.simpleString()}")
        large = staged(left.join(small, "label", "left_anti"))
        gone.append(done)
        if large.isEmpty():
            break
        leaders = large.groupBy("label").agg(F.min("doc_id").alias("leader"), F.min_by("shingles", "doc_id").alias("led"))
        shared = F.size(F.array_intersect("shingles", "led"))
        met = staged(large.join(leaders, "label").filter(F.col("doc_id") != F.col("leader")).withColumn(
            "near", F.coalesce(F.try_divide(shared, F.size("shingles") + F.size("led") - shared), F.lit(1.0)) >= similarity).drop("led", "leader"))
        gone.append(met.filter("near").select(F.col("doc_id").alias("other")))
        left = met.filter("NOT near").drop("near")
    return reduce(DataFrame.union, gone, copies)


def led_others(group: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """The same rounds for one group of bounded size: in order of the ids, a row near an
    earlier leader goes, any other leads."""
    group = group.sort_values("doc_id")
    led_by: dict[int, list[int]] = {}                 # shingle -> leaders that have it
    sizes, gone = [], []
    for i, shingles in zip(group["doc_id"], group["shingles"], strict=True):
        shared = Counter(chain.from_iterable(led_by.get(h, ()) for h in shingles.tolist()))
        n = len(shingles)
        if any(k >= similarity * (n + sizes[leader] - k) for leader, k in shared.items()) or (not n and 0 in sizes):
            gone.append(i)
        else:
            for h in shingles.tolist():
                led_by.setdefault(h, []).append(len(sizes))
            sizes.append(n)
    return pd.DataFrame({"other": pd.Series(gone, dtype=group["doc_id"].dtype)})


def one_of_each(docs: DataFrame, words: int = 5, radius: int = 8, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs``, with all their columns, less those with a near copy that stays; of
    several rows of one id, the one with the least text (then the least other columns).

    Rows without id are kept.
    """
    if has_repeats(docs, "doc_id"):
        known = docs.filter(F.col("doc_id").isNotNull())
        rest = [c for c in docs.columns if c not in ("doc_id", "text")]
        least = known.groupBy("doc_id").agg(F.min(F.struct("text", *rest)).alias("row"))
        known = least.select(*[F.col(c) if c == "doc_id" else F.col("row")[c].alias(c) for c in docs.columns])
        docs = staged(known.unionByName(docs.filter(F.col("doc_id").isNull())))
    others = staged(near_others(docs.select("doc_id", "text"), words, radius, similarity).withColumnRenamed("other", "doc_id"))
    return docs.join(sent(others), "doc_id", "left_anti").select(*docs.columns)


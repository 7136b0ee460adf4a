"""Nearest neighbours by inner product through a hierarchical k-means tree.

The tree is grown on a bounded sample (``SAMPLE`` distinct vectors by hash of their id) and
every vector then goes down to its leaf. Inner products become distances by one more
coordinate, which fills each vector up to the largest length. A search walks the tree best
bin first: a priority queue of nodes by the distance of their centre gives the order of the
leaves. How many leaves are visited is calibrated: for ``CALIBRATE`` searched vectors the
true neighbours among all rows are found by brute force, and the visits are widened until
the mean recall of these reaches ``TARGET``.

Visits are grouped by subtrees (``PACKS`` of them), so a searched vector travels once to each
subtree that it visits, and meets there only the leaves on its list. Scores are taken on
the original vectors, in double precision.

Results: vectors that are null, zero, not finite, hold nulls or are not of the commonest
length take no part, nor do rows without id; a vec_id given several times counts once, with
its least vector; equal scores go by vec_id; equal vectors are all returned; further columns are
not read; fewer candidates than k give shorter lists; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import staged
from riskspark.llm.neighbours import answers, best_of, cells, entries, exact_best, matrix, usable

SAMPLE, CALIBRATE = 20_000, 200
BRANCHES, LEAF_ROWS = 8, 40
TARGET = 0.95
PACKS = 32
#: of a cell: searched vectors that are scored at once, scores that are held, and spare ones for ties in the last bits
BLOCK, HELD, SPARE = 512, 300_000, 4


@dataclass
class Tree:
    centres: np.ndarray                             # of every node, one more coordinate than the vectors
    children: list[list[int]]                       # of every node; none for a leaf
    leaf_of: np.ndarray                             # number of a leaf, -1 for an inner node
    longest: float                                  # largest length of all vectors

    @property
    def leaves(self) -> int:
        return int(self.leaf_of.max()) + 1

    def lifted(self, v: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.longest**2 - (v * v).sum(axis=1), 0)
        return np.column_stack([v, np.sqrt(rest)])

    def place(self, v: np.ndarray) -> np.ndarray:
        """Leaf of each vector: from each node to the nearest centre below it."""
        x = self.lifted(v)
        node = np.zeros(len(x), np.int64)
        open_ = np.arange(len(x)) if self.children[0] else np.zeros(0, np.int64)
        while len(open_):
            for n in np.unique(node[open_]).tolist():
                at, below = open_[node[open_] == n], np.array(self.children[n])
                c = self.centres[below]
                node[at] = below[((c * c).sum(axis=1) - 2 * x[at] @ c.T).argmin(axis=1)]
            open_ = open_[[bool(self.children[n]) for n in node[open_].tolist()]]
        return self.leaf_of[node]

    def order(self, v: np.ndarray, visits: int) -> np.ndarray:
        """The first ``visits`` leaves of each searched vector, best bin first."""
        length = np.linalg.norm(v, axis=1, keepdims=True)
        q = np.column_stack([v / np.where(length > 0, length, 1) * self.longest, np.zeros(len(v))])
        far = (self.centres * self.centres).sum(axis=1) - 2 * q @ self.centres.T
        out = np.zeros((len(v), visits), np.int64)
        for i, d in enumerate(far):
            queue, n = [(0.0, 0)], 0
            d = d.tolist()
            while n < visits:
                node = heapq.heappop(queue)[1]
                below = self.children[node]
                if below:
                    for c in below:
                        heapq.heappush(queue, (d[c], c))
                else:
                    out[i, n] = self.leaf_of[node]
                    n += 1
        return out


def split(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """k-means: the cluster of each row. Starts from rows far from those before."""
    centres = [x.mean(axis=0)]
    near = ((x - centres[0]) ** 2).sum(axis=1)
    for _ in range(k):
        centres.append(x[near.argmax()])
        near = np.minimum(near, ((x - centres[-1]) ** 2).sum(axis=1))
    c = np.array(centres[1:])
    for _ in range(rounds):
        own = ((c * c).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return ((c * c).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)


def grow(v: np.ndarray, longest: float) -> Tree:
    tree = Tree(np.zeros((0, 0)), [], np.zeros(0), longest)
    x = tree.lifted(v)
    centres, children, waiting = [x.mean(axis=0)], [[]], [(0, np.arange(len(x)))]
    while waiting:
        node, rows = waiting.pop()
        if len(rows) <= LEAF_ROWS:
            continue
        own = split(x[rows], BRANCHES)
        groups = [rows[own == j] for j in range(BRANCHES) if (own == j).any()]
        if len(groups) < 2:
            continue                                # all rows alike
        for g in groups:
            children[node].append(len(centres))
            children.append([])
            centres.append(x[g].mean(axis=0))
            waiting.append((children[node][-1], g))
    # leaves are numbered in the order of a walk, so neighbours in the tree get near numbers
    leaf_of, stack, n = np.full(len(centres), -1), [0], 0
    while stack:
        node = stack.pop()
        if children[node]:
            stack += reversed(children[node])
        else:
            leaf_of[node], n = n, n + 1
    return Tree(np.array(centres), children, leaf_of, longest)


def widened(tree: Tree, truth: pd.DataFrame, queries: pd.DataFrame, target: float) -> tuple[int, float]:
    """Visits after which the true neighbours are found often enough, and that recall."""
    every = tree.order(matrix(queries["v"]), tree.leaves)
    place = np.empty_like(every)
    np.put_along_axis(place, every, np.arange(tree.leaves)[None, :].repeat(len(every), 0), 1)
    row = {r: i for i, r in enumerate(queries["rep"])}
    at = place[[row[r] for r in truth["rep_q"]], truth["leaf"].to_numpy()]
    visits = 1
    while True:
        recall = float((at < visits).mean())
        if recall >= target or visits == tree.leaves:
            return visits, recall
        visits = min(tree.leaves, max(visits + 1, int(visits * 1.1)))


class Best:
    """The best vectors of each searched vector so far, in bounded memory."""

    def __init__(self, q: np.ndarray, v: np.ndarray, rep: np.ndarray, k: int):
        self.q, self.v, self.rep, self.k = q, v, rep, k
        self.parts, self.size = [], 0

    def offer(self, asks: np.ndarray, a: int, b: int) -> None:
        """Vectors a to b for the searched vectors ``asks``."""
        score = self.q[asks] @ self.v[a:b].T
        m = min(self.k + SPARE, b - a)
        top = np.argpartition(-score, m - 1, axis=1)[:, :m]
        self.parts.append((np.repeat(asks, m), a + top.ravel(), np.take_along_axis(score, top, 1).ravel()))
        self.size += top.size
        if self.size > HELD:
            self.prune()

    def prune(self) -> None:
        rows, at, score = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        pick = best_of(self.rep[at], score, rows, self.k + SPARE)
        self.parts, self.size = [(rows[pick], at[pick], score[pick])], 0

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.prune()
        rows, at, _ = self.parts[0]
        # summed row by row: the same for a pair whatever the block
        score = np.concatenate([(self.q[rows[i : i + HELD // 10]] * self.v[at[i : i + HELD // 10]]).sum(axis=1) for i in range(0, len(rows), HELD // 10)])
        pick = best_of(self.rep[at], score, rows, self.k)
        return rows[pick], at[pick], score[pick]


def search(embeddings: DataFrame, k: int = 20, target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: for every id divisible by 20 its k nearest found among the other rows."""
    spark = embeddings.sparkSession
    known, searched = entries(usable(embeddings, zero=False), k)
    longest = known.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()[0]
    if longest is None:
        return answers(spark.createDataFrame([], "rep_q long, rep long, score double"), known, searched, k)
    sample = known.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("v").toPandas()
    tree = spark.sparkContext.broadcast(grow(matrix(sample["v"]), float(longest)))

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaf = tree.value.place(matrix(b.column(1)))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf, pa.int64())], names=["rep", "v", "asked", "leaf"])

    placed = staged(known.select("rep", "v", "asked").mapInArrow(down, "rep long, v array<double>, asked boolean, leaf long"))
    asked = placed.filter("asked").select("rep", "v")
    trial = asked.orderBy(F.xxhash64("rep", F.lit(1)), "rep").limit(CALIBRATE)
    truth = exact_best(trial, placed, k).toPandas()
    if not len(truth):
        return answers(spark.createDataFrame([], "rep_q long, rep long, score double"), known, searched, k)
    visits, _ = widened(tree.value, truth, trial.toPandas(), target)
    leaves = tree.value.leaves
    packs = min(PACKS, leaves)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            order = np.sort(tree.value.order(matrix(b.column(1)), visits), axis=1)
            pack = order * packs // leaves
            row, first = np.nonzero(np.diff(pack, axis=1, prepend=-1))
            ends = np.append(first[1:], visits)
            ends[np.append(row[1:] != row[:-1], True)] = visits
            lists = [order[r, a:e] for r, a, e in zip(row, first, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(pack[row, first], pa.int64()), b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)),
                                              pa.array(lists, pa.list_(pa.int64()))], names=["part", "rep", "v", "leaves"])

    going = staged(asked.mapInArrow(walk, "part long, rep long, v array<double>, leaves array<long>"))
    held = placed.select(F.floor(F.col("leaf") * packs / leaves).alias("part"), "rep", "v", "leaf")

    def cell(have: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(have) or not len(ask):
            return pd.DataFrame({"rep_q": [], "rep": [], "score": []})
        have = have.sort_values(["leaf", "rep"], kind="stable")
        v, q, leaf = matrix(have["v"]), matrix(ask["v"]), have["leaf"].to_numpy()
        wanted = np.concatenate(ask["leaves"].to_list())
        who = np.repeat(np.arange(len(ask)), ask["leaves"].map(len))
        order = np.argsort(wanted, kind="stable")
        wanted, who = wanted[order], who[order]
        rep = have["rep"].to_numpy()
        best = Best(q, v, rep, k + 1)
        for n in np.unique(leaf).tolist():
            a, b = np.searchsorted(leaf, [n, n + 1])
            asks = who[slice(*np.searchsorted(wanted, [n, n + 1]))]
            for i in range(0, len(asks), BLOCK):
                best.offer(asks[i : i + BLOCK], a, b)
        rows, at, score = best.result()
        return pd.DataFrame({"rep_q": ask["rep"].to_numpy()[rows], "rep": rep[at], "score": score})

    return answers(cells(held, going, cell), known, searched, k)

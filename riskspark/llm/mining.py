"""Hard negatives by Fagin's threshold algorithm.

Components become whole numbers, floor(256 x); a score is the integer inner product with the
anchor. A block of rows holds, for each dimension, its rows in the order of that component.
For an anchor the lists are read from the end that its sign favours, some entries of every list
at a time (sorted access), and each row met is scored in full (random access). The components
read last bound the score of every row not met yet: once this threshold is strictly below
the last of the best rows found, none of the others can come among them, ties included.

First the positives: the best rows of the anchor's label. Each positive score opens a window
of negative scores, from ``LOW`` to ``HIGH`` percent of it, and a second walk over the lists
ends when the threshold is strictly below the kth score of every window, or below the window.

Equal rows of one label are one entry, with its smallest ids, as many as an answer can need;
rows of all blocks meet all anchors, every block answers exactly, so the merged answer is exact.

Results: rows with a null label, id or vector, an empty vector, a null or non-finite component,
or a vector not of the commonest length take no part; a component beyond a long is held at its
ends, and so is a score; a vec_id given several times counts once, with its least label and
vector; zero vectors take part; fewer rows than asked for give shorter lists; further columns
are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import has_repeats, staged
from riskspark.llm.neighbours import cells, matrix

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
#: a negative score lies between so many percent of the positive score
LOW, HIGH = 80, 100
ANCHOR_STEP = 100
#: entries of each list that are read first; every step reads twice as many
READ = 16
LONG = 2**63


class Lists:
    """A block of rows with its candidates of each dimension in order."""

    def __init__(self, v: np.ndarray):
        self.v = v
        self.order = np.argsort(v, axis=0, kind="stable").astype(np.int32)

    def walk(self, q: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
        """(rows met for the first time, what no row not met yet can exceed), the anchor's signs giving the direction."""
        n = len(self.v)
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        met, depth, step = np.zeros(n, bool), 0, READ
        while depth < n and len(up) + len(down):
            to = min(n, depth + step)
            now = np.zeros(n, bool)
            now[self.order[n - to : n - depth, up]] = True
            now[self.order[depth:to, down]] = True
            new = np.flatnonzero(now & ~met)
            met[new] = True
            last = self.v[self.order[n - to, up], up] @ q[up] + self.v[self.order[to - 1, down], down] @ q[down]
            yield new, float(last)
            if met.all():
                return
            depth, step = to, 2 * step
        yield np.flatnonzero(~met), -np.inf


def scored(v: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; ``exact``: sums may leave the whole numbers that a double holds."""
    if not exact:
        return (v @ q).astype(np.int64)
    x = [int(a) for a in q]
    return np.array([max(-LONG, min(LONG - 1, sum(a * int(b) for a, b in zip(x, row, strict=True)))) for row in v], np.int64)


def best(score: np.ndarray, rep: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties by rep."""
    return np.lexsort((rep, ~score))[:k]


def floor_of(positive: int) -> int:
    """Smallest negative score of a positive score's window."""
    return -(-LOW * positive // 100)


class Held:
    """A block as numbers: vectors, ids and labels, and whether doubles hold its scores."""

    def __init__(self, have: pd.DataFrame, ask: pd.DataFrame):
        self.v, self.q = matrix(have["v"]), matrix(ask["v"])
        self.rep, self.label = have["rep"].to_numpy(np.int64), have["label"].to_numpy(np.int64)
        largest = float(np.abs(self.q).max(initial=0)) * float(np.abs(self.v).max(initial=0)) * self.v.shape[1]
        self.exact = largest >= 2**53
        if self.exact:
            self.v, self.q = (np.array(x["v"].tolist(), object) for x in (have, ask))
        else:
            self.lists = Lists(self.v)

    def walk(self, i: int) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """(rows, scores, threshold); sums too large for a double are scored without a threshold."""
        if self.exact:
            yield np.arange(len(self.v)), scored(self.v, self.q[i], True), -np.inf
            return
        for rows, last in self.lists.walk(self.q[i]):
            yield rows, scored(self.v[rows], self.q[i], False), last


def block_positives(have: pd.DataFrame, ask: pd.DataFrame, k: int) -> pd.DataFrame:
    """(rep_q, rep, score): the first k entries of the anchor's label in this block."""
    out: list[tuple[int, np.ndarray, np.ndarray]] = []
    if len(have) and len(ask):
        held = Held(have, ask)
        for i, (name, label) in enumerate(zip(ask["rep"], ask["label"], strict=True)):
            score, rep = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for rows, s, last in held.walk(i):
                own = held.label[rows] == label
                score, rep = np.append(score, s[own]), np.append(rep, held.rep[rows[own]])
                first = best(score, rep, k)
                score, rep = score[first], rep[first]
                if len(score) == k and last < score[-1]:
                    break
            out.append((name, rep, score))
    return pd.DataFrame({"rep_q": np.repeat(np.array([x[0] for x in out], np.int64), [len(x[1]) for x in out]),
                         "rep": np.concatenate([x[1] for x in out] or [[]]).astype(np.int64),
                         "score": np.concatenate([x[2] for x in out] or [[]]).astype(np.int64)})


def block_negatives(have: pd.DataFrame, ask: pd.DataFrame, k: int) -> pd.DataFrame:
    """(rep_q, positive_score, rep, score): the first k entries of another label in each window of each anchor."""
    out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    if len(have) and len(ask):
        held = Held(have, ask)
        for i, (name, label, windows) in enumerate(zip(ask["rep"], ask["label"], ask["windows"], strict=True)):
            found = {int(p): (np.zeros(0, np.int64), np.zeros(0, np.int64)) for p in windows}
            for rows, s, last in held.walk(i):
                other = held.label[rows] != label
                s, rep = s[other], held.rep[rows[other]]
                open_ = False
                for p, (score, who) in found.items():
                    inside = (s >= floor_of(p)) & (s <= p)
                    if inside.any():
                        score, who = np.append(score, s[inside]), np.append(who, rep[inside])
                        first = best(score, who, k)
                        found[p] = score, who = score[first], who[first]
                    open_ |= last >= (score[-1] if len(score) == k else floor_of(p))
                if not open_:
                    break
            out += [(name, p, who, score) for p, (score, who) in found.items()]
    n = [len(x[2]) for x in out]
    return pd.DataFrame({"rep_q": np.repeat(np.array([x[0] for x in out], np.int64), n), "positive_score": np.repeat(np.array([x[1] for x in out], np.int64), n),
                         "rep": np.concatenate([x[2] for x in out] or [[]]).astype(np.int64),
                         "score": np.concatenate([x[3] for x in out] or [[]]).astype(np.int64)})


def labelled(embeddings: DataFrame, label: Column) -> DataFrame:
    """(id, label, v array<long>) of the rows that take part."""
    rows = embeddings.filter(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)).select(
        F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    rows = rows.filter(F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    rows = rows.select("id", "label", F.transform("x", lambda x: F.floor(x * SCALE).cast("long")).alias("v"))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(2).collect()
    if len(lengths) > 1:
        rows = rows.filter(F.size("v") == lengths[0].d)
    if has_repeats(rows, "id"):
        rows = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")
    return rows


def first_rows(found: DataFrame, known: DataFrame, by: list[str], k: int) -> DataFrame:
    """(by, rows): of the best entries the first k rows, each (falling, id, score)."""
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "rep"))
    few = found.withColumn("_n", nth).filter(F.col("_n") <= k)
    each = few.join(known.select("rep", "ids"), "rep").select(*by, "score", F.explode("ids").alias("id"))
    # at most k times as many ids as an entry keeps
    return each.groupBy(*by).agg(F.slice(F.sort_array(F.collect_list(
        F.struct(F.bitwise_not("score").alias("falling"), "id", "score"))), 1, k).alias("rows"))


def mine(embeddings: DataFrame, label: Column | None = None, anchor_step: int = ANCHOR_STEP, positives: int = POSITIVES,
         negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = labelled(embeddings, F.col("label") if label is None else label)
    most = max(positives + 1, negatives)
    nth = F.row_number().over(Window.partitionBy("v", "label").orderBy("id"))
    few = rows.withColumn("_n", nth).filter(F.col("_n") <= most)
    anchors = rows.filter(F.pmod("id", F.lit(anchor_step)) == 0)
    known = few.groupBy("v", "label").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids"))
    asks = anchors.groupBy("v", "label").agg(F.lit(True).alias("asked"))
    known = staged(known.join(asks, ["v", "label"], "left").withColumn("part", F.lit(0).cast("long")))
    named = staged(anchors.join(known.filter("asked").select("v", "label", "rep"), ["v", "label"]).select(F.col("id").alias("anchor_id"), F.col("rep").alias("rep_q")))
    held, asked = known.select("part", "rep", "v", "label"), known.filter("asked").select("part", "rep", "v", "label")

    own = cells(held, asked, lambda have, ask: block_positives(have, ask, positives + 1), "rep_q long, rep long, score long")
    near = staged(first_rows(own, known, ["rep_q"], positives + 1))        # one more, as the anchor itself may be among them
    windows = near.select(F.col("rep_q").alias("rep"), F.array_distinct(F.filter(F.transform("rows", lambda x: x["score"]), lambda s: s >= 0)).alias("windows"))
    open_ = asked.join(windows.filter(F.size("windows") > 0), "rep")
    others = cells(held, staged(open_), lambda have, ask: block_negatives(have, ask, negatives), "rep_q long, positive_score long, rep long, score long")
    hard = first_rows(others, known, ["rep_q", "positive_score"], negatives).select(
        "rep_q", F.col("positive_score").alias("p"), F.posexplode("rows").alias("pos", "n"))
    mine_ = F.slice(F.filter("rows", lambda x: x["id"] != F.col("anchor_id")), 1, positives)
    pairs = named.join(near, "rep_q").select("rep_q", "anchor_id", F.explode(mine_).alias("p")).select(
        "rep_q", "anchor_id", F.col("p.id").alias("positive_id"), F.col("p.score").alias("p"))
    return pairs.join(hard, ["rep_q", "p"]).select(
        "anchor_id", "positive_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("n.id").alias("negative_id"),
        F.col("p").alias("positive_score"), F.col("n.score").alias("negative_score"))


def query(embeddings: DataFrame) -> DataFrame:
    """Hard negatives after the labels of every seventh id have moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(embeddings, moved)

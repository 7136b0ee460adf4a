"""Exact top-k by integer inner product with vector approximations.

Each component is floor(64 x). A cell of the search holds a chunk of vectors twice: as
quantised cells of ``BITS`` bits a component and exactly. The scan of the quantised cells
gives every vector a lower and an upper bound of its score; exact vectors are then read in
the order of their upper bounds, a few at a time, until the kth score found is above every
bound that is left.

All rows meet all searched vectors, in blocks of bounded size; every block answers exactly,
so the merged answer is exact.

Results: vectors that are null, hold nulls or numbers that are not finite, or are not of the
commonest length take no part, nor do rows without id; zero vectors do; a vec_id given
several times counts once, with its least vector; equal scores go by vec_id; equal vectors
are all returned; scores beyond a long are held at its ends; further columns are not read;
fewer candidates than k give shorter lists; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.neighbours import answers, cells, entries, matrix, usable

SCALE, BITS = 64, 5
#: exact vectors that are read at a time
READ = 64
LONG = 2**63


class Approximation:
    """A chunk of vectors as cells: a number of ``BITS`` bits for each component."""

    def __init__(self, v: np.ndarray, bits: int = BITS):
        self.low = v.min(axis=0)
        span = v.max(axis=0) - self.low
        # whole numbers: a cell of width w holds w of them, so its ends are w - 1 apart
        self.width = np.maximum(np.ceil((span + 1) / (1 << bits)), 1)
        self.code = np.minimum((v - self.low) // self.width, (1 << bits) - 1).astype(np.uint8)
        self.half = (self.width - 1) / 2

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Middle of the bounds for each (query, vector), and what to add or take off for each query."""
        middle = (q * self.width) @ self.code.T.astype(np.float64) + (q @ (self.low + self.half))[:, None]
        reach = np.abs(q) @ self.half
        slack = (np.abs(q) @ (np.abs(self.low) + (1 << BITS) * self.width)) * 1e-12
        return middle, reach + slack


def exact_scores(q: np.ndarray, v: np.ndarray, small: bool) -> np.ndarray:
    if small:
        return v @ q                                # whole numbers below 2^53 throughout
    return np.array([max(-LONG, min(LONG - 1, sum(int(a) * int(b) for a, b in zip(q, x, strict=True)))) for x in v], object)


def top(q: np.ndarray, v: np.ndarray, rep: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, list[int], int]:
    """(query, row, score) of the k best rows for each query, and how many exact vectors were read."""
    approx = Approximation(v)
    small = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * v.shape[1] < 2**53
    middle, reach = approx.bounds(q)
    k = min(k, len(v))
    who, row, out, read = [], [], [], 0
    for i in range(len(q)):
        upper = middle[i] + reach[i]
        least = np.partition(middle[i], len(v) - k)[len(v) - k] - reach[i]       # k rows reach this for certain
        maybe = np.flatnonzero(upper >= least)
        maybe = maybe[np.argsort(-upper[maybe], kind="stable")]
        got_row, got = np.zeros(0, np.int64), np.zeros(0, np.int64 if small else object)
        for a in range(0, len(maybe), READ):
            if len(got) == k and upper[maybe[a]] < float(got.min()):
                break
            part = maybe[a : a + READ]
            read += len(part)
            s = exact_scores(q[i], v[part], small)
            got_row, got = np.append(got_row, part), np.append(got, s.astype(np.int64) if small else s)
            order = np.lexsort((rep[got_row], -got)) if small else np.array(sorted(range(len(got)), key=lambda j: (-got[j], rep[got_row[j]])))
            got_row, got = got_row[order[:k]], got[order[:k]]
        who.append(np.full(len(got), i))
        row.append(got_row)
        out += [int(x) for x in got]
    none = np.zeros(0, np.int64)
    return (np.concatenate(who) if who else none), (np.concatenate(row) if row else none), out, read


def search(embeddings: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for every id divisible by 20 its k highest scores among the other rows."""
    known, searched = entries(usable(embeddings, zero=True), k)
    held = known.select(F.lit(0).cast("long").alias("part"), "rep", "v")
    asked = known.filter("asked").select(F.lit(0).cast("long").alias("part"), "rep", "v")

    def cell(have: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(have) or not len(ask):
            return pd.DataFrame({"rep_q": [], "rep": [], "score": []})
        v, q = np.floor(SCALE * matrix(have["v"])), np.floor(SCALE * matrix(ask["v"]))
        rep = have["rep"].to_numpy()
        who, row, score, _ = top(q, v, rep, k + 1)
        return pd.DataFrame({"rep_q": ask["rep"].to_numpy()[who], "rep": rep[row], "score": np.array(score, np.int64)})

    return answers(cells(held, asked, cell, "rep_q long, rep long, score long"), known, searched, k)

"""Periodic runs of words, found through string synchronising sets.

A run is a longest stretch of words with smallest period q (words q apart are identical) that
is at least max(``LEAST``, ``POWER`` q) long. Periods below ``SMALL`` are found directly, as
stretches of words that equal the word q before them. Larger ones by scale t = ``SMALL``,
2 t, ...: a position is in the synchronising set of a scale if the smallest hash of the t-word
windows that start within t of it is at either end, so that equal surroundings choose equal
positions, about 2 in t. Windows inside a highly periodic region (period up to t / 4) are left
out of the choice; the regions are known by then, since each is a run of a smaller scale.

Why nothing is lost. In a run with t <= q < 2 t some position s of the set lies within the
first t words, since not all windows there are highly periodic; s + q has the same 2 t words
after it, so it is in the set too, and no position between has them. So each position proposes
its distance to the next one with the same context, and a proposal is stretched both ways by
comparing words, which makes the result exact.

The word numbers of many texts stand in one array with a word of its own after each text, and
every step works on all of them at once. Texts of like length share an array, so short texts
do not go through the scales of long ones. A text is never cut; it is held by one task.

Results: a null or empty text, or one without words, has no runs, nulls for the greatest run
and the hash of an empty string; a row without id gets no planted repetition; repeated rows
get a row each; further columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskspark.llm.common import to_arrow

#: shortest run, its least exponent, and the period from which synchronising sets are used
LEAST, POWER, SMALL = 6, 4, 8
#: words that stand in one array, unless a text alone has more
CHUNK = 1 << 16
NEVER = np.uint64(2**64 - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def doubled(h: np.ndarray, t: int) -> np.ndarray:
    """Hashes of windows of 2 t words from those of t words."""
    return mixed(h[:-t] * np.uint64(0x9E3779B97F4A7C15) + (h[t:] ^ np.uint64(0xD6E8FEB86659FD93)))


def least_within(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by running minima of blocks from both sides."""
    n = len(x) - width + 1
    padded = np.append(x, np.full(-len(x) % width, NEVER)).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each series of at least ``least`` true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).view(np.int8)))
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= least
    return begin[long], end[long]


def has_period(w: np.ndarray, begin: int, end: int, p: int) -> bool:
    return bool((w[begin : end - p] == w[begin + p : end]).all())


def smallest(w: np.ndarray, begin: int, end: int, q: int) -> bool:
    """Is ``q``, a period of the stretch, its smallest one? With this length a smaller one divides it."""
    rest, p = q, 2
    while p * p <= rest:
        if rest % p:
            p += 1
            continue
        if has_period(w, begin, end, q // p):
            return False
        while rest % p == 0:
            rest //= p
    return rest == 1 or not has_period(w, begin, end, q // rest)


def reach(w: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The longest stretch around ``at`` in which words q apart are identical."""
    end, step = at, 64
    while True:
        same = w[end : min(end + step, len(w) - q)] == w[end + q : end + q + step]
        if not same.all():
            end += int(np.argmin(same))
            break
        end += len(same)
        if end >= len(w) - q:
            break
        step *= 2
    begin, step = at, 64
    while begin:
        low = max(begin - step, 0)
        same = (w[low:begin] == w[low + q : begin + q])[::-1]
        if not same.all():
            begin -= int(np.argmin(same))
            break
        begin, step = low, step * 2
    return begin, end + q


def runs_of(w: np.ndarray, longest: int) -> np.ndarray:
    """(begin, end, period) of all runs of ``w``, in any order; none is longer than ``longest``."""
    found: list[tuple[int, int, int]] = []
    for q in range(1, min(SMALL, longest // POWER + 1)):
        begin, end = stretches(w[:-q] == w[q:], max(LEAST, POWER * q) - q)
        found += [(b, e, q) for b, e in zip(begin.tolist(), (end + q).tolist(), strict=True) if smallest(w, b, e, q)]
    h, t = mixed(w.astype(np.uint64)), 1
    while t < SMALL and len(h) > t:
        h, t = doubled(h, t), 2 * t
    while POWER * t <= longest:
        context = doubled(h, t)                             # 2 t words
        order = h.copy()                                    # of windows of t words
        for b, e, p in found:
            if 4 * p <= t <= e - b:
                order[b : e - t + 1] = NEVER
        low = least_within(order, t + 1)                    # from s to s + t
        n = min(len(low), len(context))
        low = low[:n]
        at = np.flatnonzero((low != NEVER) & ((low == order[:n]) | (low == order[t : t + n])))
        by = at[np.argsort(context[at], kind="stable")]
        near = (context[by[1:]] == context[by[:-1]]) & (by[1:] - by[:-1] >= t) & (by[1:] - by[:-1] < 2 * t)
        place, period = by[:-1][near], (by[1:] - by[:-1])[near]
        until: dict[int, int] = {}                          # by period: end of the stretch seen last
        for i in np.argsort(place, kind="stable").tolist():
            s, q = int(place[i]), int(period[i])
            if s + q < until.get(q, 0):
                continue
            b, e = reach(w, s, q)
            until[q] = e
            if e - b >= max(LEAST, POWER * q) and smallest(w, b, e, q):
                found.append((b, e, q))
        h, t = context, 2 * t
    return np.array(found, np.int64).reshape(-1, 3)


def planted(words: np.ndarray, doc_id: int | None) -> np.ndarray:
    """The words with the repetition that the id calls for."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([words[:a], words[a + np.arange(n - a) % p]])


def summary(runs: np.ndarray, words: list[bytes]) -> list:
    """The row of one text from its runs (start, end, period) in order of start and period."""
    n = len(words)
    listed = "".join(f"{b},{e - b},{q}\n" for b, e, q in runs.tolist())
    kept, best = words, [None] * 4
    if len(runs):
        lost = np.zeros(n + 1, np.int64)
        np.add.at(lost, runs[:, 0] + runs[:, 2], 1)
        np.add.at(lost, runs[:, 1], -1)
        kept = [words[i] for i in np.flatnonzero(np.cumsum(lost[:n]) == 0).tolist()]
        length = runs[:, 1] - runs[:, 0]
        top = np.lexsort((runs[:, 2], runs[:, 0], -(length / runs[:, 2])))[0]
        best = [int(runs[top, 0]), int(length[top]), int(runs[top, 2]), int(1000 * length[top] // runs[top, 2])]
    return [len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()]


def periodic(texts: list[bytes], change: Callable[[np.ndarray, int], np.ndarray] | None = None) -> list[tuple[np.ndarray, list[bytes]]]:
    """For each text its runs (start, end, period), in order, and its words; ``change`` gives other word numbers for text i."""
    out: list[tuple[np.ndarray, list[bytes]]] = [(np.zeros((0, 3), np.int64), [])] * len(texts)
    parts = [t.split() for t in texts]                      # at x20 and x09-x0D
    order, at = sorted(range(len(parts)), key=lambda i: len(parts[i])), 0
    while at < len(order):
        names: dict[bytes, int] = {}
        rows, of, total = [], [], 0
        while at < len(order) and (not of or total + len(parts[order[at]]) < CHUNK):
            i = order[at]
            numbers = np.array([names.setdefault(x, len(names)) for x in parts[i]], np.int64)
            rows.append(change(numbers, i) if change else numbers)
            of.append(i)
            total += len(numbers) + 1
            at += 1
        # a word of its own ends each text, so no run goes beyond it
        w = np.concatenate([np.append(x, -1 - k) for k, x in enumerate(rows)])
        first = np.cumsum([0, *(len(x) + 1 for x in rows)])
        runs = runs_of(w, max(map(len, rows)))
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
        cut = np.searchsorted(runs[:, 0], first)
        spelt = list(names)
        for k, i in enumerate(of):
            mine = runs[cut[k] : cut[k + 1]] - np.array([first[k], first[k], 0])
            out[i] = mine, [spelt[x] for x in rows[k].tolist()] if change else parts[i]
    return out


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, length, period): a row for each run of the texts as they are."""
    schema = T.StructType([docs.schema[id_col], *(T.StructField(c, T.LongType()) for c in ("start", "length", "period"))])
    arrow = to_arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [r for r, _ in periodic(raw(b.column(1)))]
            every = np.concatenate(made) if made else np.zeros((0, 3), np.int64)
            ids = b.column(0).take(pa.array(np.repeat(np.arange(len(made)), [len(r) for r in made])))
            yield pa.RecordBatch.from_arrays([ids, pa.array(every[:, 0]), pa.array(every[:, 1] - every[:, 0]), pa.array(every[:, 2])], schema=arrow)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def raw(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def query(docs: DataFrame) -> DataFrame:
    """The digests of each text, with its planted repetition, by row."""
    kinds = [*((c, T.LongType()) for c in ("n_runs", "start", "length", "period", "exponent_milli")),
             *((c, T.StringType()) for c in ("runs_sha256", "collapsed_sha256"))]
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(*x) for x in kinds)])
    arrow = to_arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            rows = [summary(r, words) for r, words in periodic(raw(b.column(1)), lambda x, i: planted(x, ids[i]))]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:], strict=True))], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, schema)

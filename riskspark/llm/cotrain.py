"""Quality by co-training of two views: the content of a text and the metadata of its page.

One classifier sees only measures of the text (shares of capitals, signs and repeated words,
overall and in its worst stretch, and so on), the other only language, source and length.
Both are fitted on labelled rows. In each round either classifier labels the unlabelled rows
that it is sure of (``SURE``), and these join the training rows of the other one. In the end
each view is calibrated on labelled rows that no round has seen, and a last small
regression over the two calibrated log-odds gives the score.

The labelled rows are a bounded sample (``MAX_LABELLED`` by hash of the id), on the driver. All
unlabelled rows take part: each is measured once and kept as a code of a byte for each
measure, equal codes as one row with a count. What a row has been told follows from its code and the
models of the rounds so far, so a lost task has nothing to remember; a Newton step adds up
gradient and curvature over all codes, in whole numbers, so the order of the sums does not
matter. However many rows are told, they weigh at most ``PSEUDO_WEIGHT`` of the labelled
ones, so the fit is alike at every size. Scores are given to all rows, map-side.

Results: a null or empty text measures 0 throughout; a null language, source or length is a
value of its own; ties and repeated rows are scored alike; rows without id are scored but
not learned from; null labels are left out; with labels of one class (or none) every score
is 1 or 0 (none: 1, so nothing is rejected); further columns are not read by the scores and
are kept by ``keep_good``; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import staged, text_batches, texts_of, to_arrow

MAX_LABELLED = 20_000
ROUNDS, SURE, PSEUDO_WEIGHT = 5, 0.98, 0.5
STRETCH = 100                                       # words of a stretch
BINS, L2 = 12, 1.0
STEPS, STILL = 12, 1e-3                            # Newton steps of a round at most, and the move that ends them
UNIT = 1 << 20                                      # sums over all rows are whole numbers of this part
SIGNS = b"!#$%&*+/<=>?@[\\]^_`{|}~"
UPPER, DIGITS, STOPS = bytes(range(65, 91)), b"0123456789", b".,;:"
SOURCES, LANGS = 64, 16


def share(raw: bytes, of: bytes) -> float:
    return 1 - len(raw.translate(None, of)) / len(raw) if raw else 0.0


def content(text: str) -> list[float]:
    """Measures of the text alone."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * 18
    n = len(words)
    lines = raw.split(b"\n")
    worst_signs = worst_upper = worst_same = 0.0
    fewest = 1.0
    for k in range(0, n, STRETCH):
        part = words[k : k + STRETCH]
        if k and len(part) < STRETCH // 2:
            break
        joined = b"".join(part)
        worst_signs = max(worst_signs, share(joined, SIGNS))
        worst_upper = max(worst_upper, share(joined, UPPER))
        worst_same = max(worst_same, sum(map(bytes.__eq__, part, part[1:])) / len(part))
        fewest = min(fewest, len(set(part)) / len(part))
    return [np.log1p(len(raw)), np.log1p(n), len(raw) / n, share(raw, SIGNS), share(raw, UPPER), share(raw, DIGITS), share(raw, STOPS),
            len(set(words)) / n, worst_signs, worst_upper, worst_same, fewest, np.log1p(len(lines)), n / len(lines),
            1 - len(set(lines)) / len(lines), raw.count(b"|") / n, raw.count(b"!") / n, max(map(len, words)) / 64]


def metadata(lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    """Two hashed names and the length; the first two are taken as they are, not cut into ranges."""
    at = lambda x, size: 0 if x is None else 1 + zlib.crc32(str(x).encode("utf-8", "surrogatepass")) % (size - 1)
    return [at(lang, LANGS), at(source, SOURCES), -1.0 if n_chars is None else float(np.log1p(max(0, n_chars)))]


@dataclass
class View:
    """Additive logistic model: each measure is cut into ranges by its quantiles, or taken as a code."""

    codes: dict[int, int] = field(default_factory=dict)      # column -> number of codes
    cuts: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray | None = None
    scale: tuple[float, float] = (1.0, 0.0)

    def prepare(self, x: np.ndarray) -> None:
        self.cuts = [np.zeros(0) if j in self.codes else np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]

    def bins(self, x: np.ndarray) -> np.ndarray:
        """A byte for each measure."""
        at = [x[:, j] if j in self.codes else np.searchsorted(cuts, x[:, j], side="left") for j, cuts in enumerate(self.cuts)]
        return np.column_stack([np.clip(c, 0, size - 1) for c, size in zip(at, self.sizes, strict=True)]).astype(np.uint8)

    @property
    def sizes(self) -> list[int]:
        return [self.codes.get(j, len(cuts) + 1) for j, cuts in enumerate(self.cuts)]

    def wide(self, bins: np.ndarray) -> np.ndarray:
        return np.hstack([np.ones((len(bins), 1)), *[np.eye(size)[bins[:, j]] for j, size in enumerate(self.sizes)]])

    def odds(self, x: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return np.clip(a * (self.wide(self.bins(x)) @ self.weights) + b, -30, 30)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def slopes(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the logistic loss."""
    p = sigmoid(x @ w)
    return x.T @ (weight * (p - y)), (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x


def regression(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = L2) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        g, h = slopes(x, y, weight, w)
        step = np.linalg.solve(h + l2 * np.eye(len(w)), g + l2 * w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    text: View
    page: View
    mix: np.ndarray                                 # intercept, text, page

    def parts(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score by the text, by the page, and by both."""
        s, t = self.text.odds(a), self.page.odds(b)
        return sigmoid(s), sigmoid(t), sigmoid(self.mix[0] + self.mix[1] * s + self.mix[2] * t)


@dataclass
class Constant:
    value: float

    def parts(self, a, b):
        return (np.full(len(a), self.value),) * 3


def told(wide: list[np.ndarray], history: list[list[np.ndarray]]) -> list[np.ndarray]:
    """What each view has been told of unlabelled rows by the models of the rounds so far: the label
    that the other view was the first time sure of, else NaN."""
    out = [np.full(len(wide[0]), np.nan) for _ in wide]
    for weights in history:
        for i, w in enumerate(weights):
            p, other = sigmoid(wide[i] @ w), out[1 - i]
            sure = np.isnan(other) & ((p >= SURE) | (p <= 1 - SURE))
            other[sure] = (p[sure] >= 0.5).astype(float)
    return out


def pooled(pool: DataFrame, views: tuple[View, View], history: list[list[np.ndarray]], weights: list[np.ndarray]) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """For each view how many unlabelled rows it has been told of, and their gradient and curvature."""
    widths = [1 + sum(v.sizes) for v in views]
    starts = np.cumsum([0] + [1 + k + k * k for k in widths])
    columns = len(views[0].sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(starts[-1])
        for t in batches:
            if not t.num_rows:
                continue
            codes = np.frombuffer(b"".join(t.column(0).to_pylist()), np.uint8).reshape(t.num_rows, -1)
            n = t.column(1).to_numpy().astype(float)
            wide = [views[0].wide(codes[:, :columns]), views[1].wide(codes[:, columns:])]
            for i, labels in enumerate(told(wide, history)):
                have = ~np.isnan(labels)
                g, h = slopes(wide[i][have], labels[have], n[have], weights[i])
                total[starts[i] : starts[i + 1]] += np.concatenate([[n[have].sum()], g, h.ravel()])
        whole = np.rint(total * UNIT).astype(np.int64)
        slot = np.flatnonzero(whole)
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array(whole[slot], pa.int64())], names=["slot", "value"])

    # as many sums as the models have weights and pairs of weights
    got = pool.select("code", "n").mapInArrow(run, "slot long, value long").groupBy("slot").agg(F.sum("value").alias("value")).toPandas()
    total = np.zeros(starts[-1])
    total[got["slot"].to_numpy()] = got["value"].to_numpy() / UNIT
    out = []
    for k, start in zip(widths, starts, strict=False):
        g = total[start + 1 : start + 1 + k]
        out.append((float(total[start]), g, total[start + 1 + k : start + 1 + k + k * k].reshape(k, k)))
    return out


def taught(pool: DataFrame, views: tuple[View, View], rows: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Rounds of co-training; ``rows``: for each view its labelled rows, wide, and their labels."""
    history: list[list[np.ndarray]] = []
    before = None
    for _ in range(ROUNDS - 1):
        history.append([v.weights for v in views])
        weights = list(history[-1])
        for _ in range(STEPS):
            sums = pooled(pool, views, history, weights)
            counts = [k for k, _, _ in sums]
            if counts == before or not any(counts):
                return                                            # nobody was told anything new
            moved = 0.0
            for i, ((x, y), (k, g, h)) in enumerate(zip(rows, sums, strict=True)):
                own_g, own_h = slopes(x, y, np.ones(len(y)), weights[i])
                share = PSEUDO_WEIGHT * len(y) / max(len(y), k)
                step = np.linalg.solve(own_h + share * h + L2 * np.eye(len(g)), own_g + share * g + L2 * weights[i])
                weights[i] = weights[i] - step
                moved = max(moved, float(np.abs(step).max()))
            if moved < STILL:
                break
        before = counts
        for v, w in zip(views, weights, strict=True):
            v.weights = w


def fit(a: np.ndarray, b: np.ndarray, y: np.ndarray, for_scale: np.ndarray, unlabelled: Callable[[tuple[View, View]], DataFrame]) -> Model | Constant:
    """Co-training on the measures of both views of labelled rows, of which ``for_scale`` marks what
    calibrates; ``unlabelled`` gives the codes of the other rows (code binary, n) under two views."""
    if len(np.unique(y)) < 2:
        return Constant(float(y[0]) if len(y) else 1.0)
    scale = for_scale if len(np.unique(y[for_scale])) == 2 else np.ones(len(y), bool)
    learn = ~scale if len(np.unique(y[~scale])) == 2 else np.ones(len(y), bool)
    views, data = (View(), View({0: LANGS, 1: SOURCES})), (a, b)
    rows = []
    for v, x in zip(views, data, strict=True):
        v.prepare(x)
        rows.append((v.wide(v.bins(x[learn])), y[learn]))
        v.weights = regression(*rows[-1], np.ones(int(learn.sum())))
    taught(unlabelled(views), views, rows)
    one = np.ones(int(scale.sum()))
    for v, x in zip(views, data, strict=True):
        z = v.odds(x[scale])
        w = regression(np.column_stack([one, z]), y[scale], one)
        v.scale = (float(w[1]), float(w[0]))
    both = np.column_stack([one, views[0].odds(a[scale]), views[1].odds(b[scale])])
    return Model(*views, regression(both, y[scale], one))


def fifth(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5))


def measured(rows: DataFrame) -> DataFrame:
    """(a array<double>, b array<double>, y, part) of sampled rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            col = {n: t.column(i) for i, n in enumerate(t.schema.names)}
            a = [content(x) for x in texts_of(col["text"])]
            b = list(map(metadata, col["lang"].to_pylist(), col["source"].to_pylist(), col["n_chars"].to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.list_(pa.float64())), pa.array(b, pa.list_(pa.float64())),
                                              col["y"].cast(pa.float64()), col["part"].cast(pa.int64())], names=["a", "b", "y", "part"])

    return rows.select("text", "lang", "source", "n_chars", "y", "part").mapInArrow(run, "a array<double>, b array<double>, y double, part long")


def views_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Measures of a batch for both views."""
    col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
    a = np.array([content(x) for x in texts_of(col["text"])]).reshape(batch.num_rows, -1)
    b = np.array(list(map(metadata, col["lang"].to_pylist(), col["source"].to_pylist(), col["n_chars"].to_pylist()))).reshape(batch.num_rows, -1)
    return a, b


def coded(docs: DataFrame, views: tuple[View, View]) -> DataFrame:
    """(doc_id, code): a byte for each measure of every row."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("code", T.BinaryType())])
    arrow = to_arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if t.num_rows:
                codes = np.hstack([v.bins(x) for v, x in zip(views, views_of(t), strict=True)])
                yield pa.RecordBatch.from_arrays([t.column(0), pa.array([c.tobytes() for c in codes], arrow.field(1).type)], schema=arrow)

    return docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text", "lang", "source", "n_chars").mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, target: str = "quality") -> Model | Constant:
    """Labels of the fifth with remainder 0 are never read; remainder 1 calibrates."""
    text_batches(docs.sparkSession)
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(target).isNotNull()).groupBy("doc_id").agg(F.max(target).cast("double").alias("y"))
    # at most MAX_LABELLED pairs of numbers are broadcast
    taken = F.broadcast(known.filter(fifth() != 0).orderBy(F.xxhash64("doc_id"), F.col("doc_id")).limit(MAX_LABELLED))
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").join(taken, "doc_id").withColumn("part", fifth())
    got = measured(rows).toPandas()
    if not len(got):
        return Constant(1.0)

    def unlabelled(views: tuple[View, View]) -> DataFrame:
        others = coded(docs, views).join(known.select("doc_id"), "doc_id", "left_anti")
        return staged(others.groupBy("code").agg(F.count(F.lit(1)).alias("n")))

    a, b = np.array(got["a"].tolist()), np.array(got["b"].tolist())
    order = np.lexsort([*b.T, *a.T, got["y"].to_numpy()])         # the order in which tasks answer does not matter
    return fit(a[order], b[order], got["y"].to_numpy(float)[order], got["part"].to_numpy()[order] == 1, unlabelled)


def parts_of(model: Model | Constant, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return model.parts(*views_of(batch))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, text_score, page_score, score, predicted: the chance that a document is good."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)] + [
        T.StructField(c, T.DoubleType()) for c in ("text_score", "page_score", "score")] + [T.StructField("predicted", T.IntegerType())])
    arrow = to_arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if t.num_rows:
                s = parts_of(model.value, t)
                yield pa.RecordBatch.from_arrays([t.column(0), *map(pa.array, s), pa.array((s[2] >= 0.5).astype(np.int32))], schema=arrow)

    scored = docs.select("doc_id", "text", "lang", "source", "n_chars").mapInArrow(run, schema)
    return scored.select("doc_id", F.coalesce(fifth() == 0, F.lit(False)).alias("held_out"), "text_score", "page_score", "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a score of a half or more, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if t.num_rows:
                yield t.filter(pa.array(parts_of(model.value, t)[2] >= 0.5))

    return docs.mapInArrow(run, docs.schema)

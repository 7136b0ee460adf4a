"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

The n-grams of a text are those of its words in lower case, with a mark at both ends; a text
has an n-gram or not, however often. The ratio of an n-gram is the logarithm of its share
among toxic texts over its share among the others; a logistic regression with an L2 penalty
is fitted on features that are 0 or that ratio, so its weights start from naive Bayes and
move where the labels ask for it.

Labels are taken from a bounded sample (``MAX_LABELLED`` rows by hash of their id); only
``FEATURES`` n-grams, those with the largest share x ratio squared, get a weight, and none with
a ratio below ``LEAST_RATIO`` either way. Scores are
then given to every whole text, map-side.

Results: a null or empty text has no n-grams and gets the score of the intercept; ties and
repeated rows are scored alike; a row without id is scored and never held out or learned
from; null labels are left out; with labels of one class (or none) every score is their
mean (or 0); further columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import map_texts, staged, text_batches, texts_of

SIZES = (2, 3, 4, 5, 6)
MAX_LABELLED, FEATURES = 20_000, 5_000
#: an n-gram of fewer texts of the sample gets no weight
MIN_TEXTS = 4
#: an n-gram about as frequent in either class says nothing
LEAST_RATIO = 1.0
L2, ROUNDS = 0.1, 400
CACHE = 500_000
MAX_WORD = 64                                       # a longer run of letters is cut into pieces of this size

_words = regex.compile(rf"[\p{{L}}\p{{M}}\p{{N}}]{{1,{MAX_WORD}}}")


def words_of(text: str) -> set[str]:
    return set(_words.findall(text.lower()))


def grams(word: str) -> set[str]:
    marked = f"_{word}_"
    return {marked[i : i + n] for n in SIZES for i in range(len(marked) - n + 1)}


@dataclass
class Model:
    weights: dict[str, float]                       # n-gram -> ratio x weight
    intercept: float

    def __post_init__(self):
        self.known: dict[str, tuple[str, ...]] = {}

    def __getstate__(self):
        return {"weights": self.weights, "intercept": self.intercept, "known": {}}

    @cached_property
    def finder(self) -> ahocorasick.Automaton:
        """All n-grams with a weight in one pass over a word."""
        made = ahocorasick.Automaton()
        for g in self.weights:
            made.add_word(g, g)
        made.make_automaton()
        return made

    def features(self, text: str) -> set[str]:
        """What is known is kept by blank-free chunk, so a chunk is cut once and a text is a few set operations."""
        chunks, known = set(text.lower().split()), self.known
        if len(known) > CACHE:
            known.clear()
        for chunk in chunks.difference(known):
            # a mark stands between two words, and only at an end of an n-gram
            marked = f"_{'_'.join(_words.findall(chunk))}_"
            known[chunk] = tuple({g for _, g in self.finder.iter(marked)}) if self.weights else ()
        return set().union(*map(known.__getitem__, chunks))

    def score(self, text: str) -> float:
        z = self.intercept + sum(self.weights[g] for g in sorted(self.features(text)))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, rows: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text, y) of at most ``rows`` labelled documents outside the held-out fifth, by hash of the id."""
    picked = (labels.filter(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.max(target).cast("int").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # at most ``rows`` pairs of numbers are broadcast
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")


def gram_counts(sample: DataFrame) -> DataFrame:
    """(gram, toxic, clean): texts of either class that have the n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for b in batches:
            for text, y in zip(texts_of(b.column(0)), b.column(1).to_pylist(), strict=True):
                found: set[str] = set()
                for w in words_of(text):
                    found |= grams(w)
                seen[1 if y else 0].update(found)
        every = list(seen[0] | seen[1])
        for k in range(0, len(every), 50_000):
            part = every[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([seen[1][g] for g in part], pa.int64()),
                                              pa.array([seen[0][g] for g in part], pa.int64())], names=["gram", "toxic", "clean"])

    return (sample.select("text", "y").mapInArrow(run, "gram string, toxic long, clean long")
            .groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def logistic(rows: list[np.ndarray], x: np.ndarray, y: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """Weights and intercept for rows of feature numbers with values ``x[feature]``; Adam on all rows at once."""
    where = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    what = np.concatenate(rows).astype(np.int64) if len(where) else np.zeros(0, np.int64)
    value = x[what]
    w, b = np.ones(width), 0.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, ROUNDS + 1):
        z = np.bincount(where, w[what] * value, minlength=len(rows)) + b
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        e = (p - y) / len(y)
        g = np.append(np.bincount(what, e[where] * value, minlength=width) + L2 * w / len(y), e.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, target: str = "toxic") -> Model:
    text_batches(docs.sparkSession)
    sample = staged(labelled_sample(docs, labels, target))
    per_class = {r.y: r.n for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = per_class.get(1, 0), per_class.get(0, 0)
    if not pos or not neg:
        return Model({}, 500.0 if pos else -500.0)
    ratio = F.log((F.col("toxic") + 1) / F.lit(pos + 2)) - F.log((F.col("clean") + 1) / F.lit(neg + 2))
    top = (gram_counts(sample).filter(F.col("toxic") + F.col("clean") >= MIN_TEXTS).withColumn("ratio", ratio)
           .withColumn("gain", F.col("ratio") * F.col("ratio") * (F.col("toxic") / pos + F.col("clean") / neg))
           .filter(F.abs("ratio") >= LEAST_RATIO).orderBy(F.desc("gain"), "gram").limit(FEATURES).select("gram", "ratio").collect())
    number = {r.gram: i for i, r in enumerate(top)}
    seeker = Model(dict.fromkeys(number, 0.0), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(number[g] for g in seeker.features(t)) for t in texts_of(b.column(0))]
            yield pa.RecordBatch.from_arrays([b.column(1).cast(pa.int32()), pa.array(found, pa.list_(pa.int32()))], names=["y", "f"])

    rows = sample.orderBy("doc_id").select("text", "y").mapInArrow(run, "y int, f array<int>").toPandas()
    x = np.array([r.ratio for r in top])
    w, b = logistic([np.asarray(f, np.int64) for f in rows["f"]], x, rows["y"].to_numpy(float), len(top))
    return Model({r.gram: float(r.ratio * k) for r, k in zip(top, w, strict=True)}, b)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def rows(ids, texts):
        s = [model.value.score(t) for t in texts]
        return [ids, s, [int(x >= 0.5) for x in s]]

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = map_texts(docs, "doc_id", "text", f"doc_id {kind}, score double, predicted int", rows)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score is below a half, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = texts_of(b.column(b.schema.get_field_index("text")))
            yield b.filter(pa.array([model.value.score(t) < 0.5 for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

"""What the two vector searches share: clean vectors, equal vectors as one, grid cells, answers.

Equal vectors are one entry, named by its smallest id, with its ``k + 1`` smallest ids: no
answer of k rows needs more of them. So a vector that a third of all rows repeat is measured
once. Entries are dealt to cells by part and chunk, searched vectors by slice; a cell holds a
bounded number of either, and hands on its ``k + 1`` best entries for each searched vector.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import has_repeats, staged

#: entries and searched vectors of one cell
CHUNK, SLICE = 4_096, 4_096
QUERY_STEP = 20


def usable(embeddings: DataFrame, zero: bool, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, v array<double>): finite vectors of the commonest length (of two, the longer one); ``zero``: zero vectors too.

    Of several rows with one id the least vector counts.
    """
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    rows = embeddings.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) > 0)).select(
        F.col(id_col).cast("long").alias("id"), v.alias("v"))
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    if not zero:
        rows = rows.filter(F.exists("v", lambda x: x != 0))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(2).collect()
    if len(lengths) > 1:
        rows = rows.filter(F.size("v") == lengths[0].d)
    if has_repeats(rows, "id"):
        rows = rows.groupBy("id").agg(F.min("v").alias("v"))
    return rows


def entries(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (rep, v, ids, asked) and the searched ids (id, rep).

    ``asked``: some id of the entry is divisible by ``QUERY_STEP``.
    """
    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = rows.withColumn("_n", nth).filter(F.col("_n") <= k + 1)
    asks = rows.filter(F.pmod("id", F.lit(QUERY_STEP)) == 0)
    known = few.groupBy("v").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids"))
    asked = asks.groupBy("v").agg(F.lit(True).alias("asked"))
    known = staged(known.join(asked, "v", "left").select("rep", "v", "ids", F.coalesce("asked", F.lit(False)).alias("asked")))
    # ids beyond the k + 1 smallest of an entry are found by the vector itself
    searched = asks.join(known.filter("asked").select("v", "rep"), "v").select("id", "rep")
    return known, searched


def matrix(column: pa.Array | pd.Series) -> np.ndarray:
    if isinstance(column, pa.Array):
        flat = column.flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
    return np.array(column.tolist(), np.float64)


def cells(held: DataFrame, asked: DataFrame, search: Callable, schema: str = "rep_q long, rep long, score double") -> DataFrame:
    """``search(held rows, asked rows)`` for every pair of a chunk of entries and a slice of searched vectors.

    ``held`` (part, rep, v, ...), ``asked`` (part, rep, v, ...). The number of parts is bounded by the caller.
    """
    chunks = {r.part: max(1, math.ceil(r.n / CHUNK)) for r in held.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    slices = {r.part: max(1, math.ceil(r.n / SLICE)) for r in asked.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    spark = held.sparkSession
    sizes = F.broadcast(spark.createDataFrame([(p, n, slices[p]) for p, n in chunks.items() if p in slices], "part long, chunks int, slices int"))
    mine = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    left = held.join(sizes, "part").withColumn("chunk", mine).withColumn("slice", F.explode(F.expr("sequence(0, slices - 1)")))
    own = F.pmod(F.xxhash64("rep"), F.col("slices")).cast("int")
    right = asked.join(sizes, "part").withColumn("slice", own).withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)")))
    drop = ("chunks", "slices")
    key = ["part", "chunk", "slice"]
    left, right = left.drop(*drop), right.drop(*drop)
    right = right.toDF(*right.columns)              # both may come from one table
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(search, schema)


def best_of(rep: np.ndarray, score: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` of each q: highest score, then smallest rep."""
    order = np.lexsort((rep, -score, q))
    sorted_q = q[order]
    nth = np.arange(len(order)) - np.searchsorted(sorted_q, sorted_q, side="left")
    return order[nth < k]


def answers(found: DataFrame, known: DataFrame, searched: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score from (rep_q, rep, score) of the best entries."""
    nth = F.row_number().over(Window.partitionBy("rep_q").orderBy(F.desc("score"), "rep"))
    best = found.withColumn("_n", nth).filter(F.col("_n") <= k + 1)
    each = best.join(known.select("rep", "ids"), "rep").select("rep_q", "score", F.explode("ids").alias("vec_id"))
    # at most (k + 1)^2 of them; all but the query's own id of the first k + 1
    falling = F.bitwise_not("score") if dict(found.dtypes)["score"] == "bigint" else -F.col("score")
    lists = each.groupBy("rep_q").agg(F.slice(F.sort_array(F.collect_list(
        F.struct(falling.alias("falling"), "vec_id", "score"))), 1, k + 1).alias("near"))
    joined = searched.select(F.col("id").alias("query_id"), F.col("rep").alias("rep_q")).join(lists, "rep_q")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return joined.select("query_id", F.posexplode(others).alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def exact_best(asked: DataFrame, held: DataFrame, k: int, batch_rows: int = 2_000) -> DataFrame:
    """(rep_q, rep, score, leaf) by brute force for a few searched vectors (at most some hundred, collected)."""
    few = asked.select("rep", "v").toPandas()
    q, names = matrix(few["v"]) if len(few) else np.zeros((0, 0)), few["rep"].to_numpy()
    shared = held.sparkSession.sparkContext.broadcast((q, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, names = shared.value
        keep = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)]
        for b in batches:
            for at in range(0, b.num_rows, batch_rows):
                part = b.slice(at, batch_rows)
                v = matrix(part.column(1))
                score = q @ v.T
                m = min(k, score.shape[1])
                top = np.argpartition(-score, m - 1, axis=1)[:, :m]
                who = np.repeat(np.arange(len(q)), m)
                new = [who, part.column(0).to_numpy()[top.ravel()], np.take_along_axis(score, top, 1).ravel(), part.column(2).to_numpy()[top.ravel()]]
                keep = [np.concatenate(x) for x in zip(keep, new, strict=True)]
                pick = best_of(keep[1], keep[2], keep[0], k)
                keep = [x[pick] for x in keep]
        yield pa.RecordBatch.from_arrays([pa.array(names[keep[0]], pa.int64()), *map(pa.array, keep[1:])], names=["rep_q", "rep", "score", "leaf"])

    rows = held.select("rep", "v", "leaf").mapInArrow(run, "rep_q long, rep long, score double, leaf long")
    nth = F.row_number().over(Window.partitionBy("rep_q").orderBy(F.desc("score"), "rep"))
    return rows.withColumn("_n", nth).filter(F.col("_n") <= k).drop("_n")



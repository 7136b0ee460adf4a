"""Texts and their lines are held as Python objects in small parts."""

import pyarrow as pa
from pyspark.sql import functions as F

from riskspark.llm import common, cotrain, lines, nbsvm


def test_batches_come_in_small_parts():
    whole = pa.RecordBatch.from_pydict({"n": list(range(1000)), "l": [[i] * (i % 3) or None for i in range(1000)]})
    parts = list(lines.slices(iter([whole, whole.slice(0, 0)])))
    assert max(p.num_rows for p in parts) <= lines.TEXTS < 1000
    assert pa.Table.from_batches(parts).to_pylist() == whole.to_pylist()


def test_lines_are_dropped_across_parts(spark):
    line = "a line that many documents hold, long enough for a key"
    n = 2 * lines.TEXTS + 5
    docs = spark.createDataFrame([(i, f"{line}\nown {i}" if i % 3 else None) for i in range(n)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.n_dropped for r in lines.query(docs).collect()}
    last = max(i for i in range(n) if i % 3)
    assert got == {i: int(i % 3 > 0 and i != last) for i in range(n)}


def test_texts_reach_python_in_batches_bounded_by_bytes(spark):
    """4,000 texts of 10,000 bytes: 40 MB in one partition, which Spark's defaults hand over at once."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.range(4_000).select(F.col("id").alias("doc_id"), F.expr("repeat('some words ', 910)").alias("text")).coalesce(1)
    sizes = docs.select("text").mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long")
    for train in (nbsvm.train, cotrain.train):
        spark.conf.unset(name)
        assert max(r.n for r in sizes.collect()) > 30_000_000
        train(docs.withColumns({"lang": F.lit("x"), "source": F.lit("y"), "n_chars": F.lit(1)}), labels)
        assert max(r.n for r in sizes.collect()) < 8_000_000
    spark.conf.set(name, "9000000")                      # what a session has set stays
    common.text_batches(spark)
    assert spark.conf.get(name) == "9000000"
    spark.conf.unset(name)

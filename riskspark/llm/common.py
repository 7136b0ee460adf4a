"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.sources.session import ensure_checkpoint_dir


#: bytes of an Arrow batch of texts
BATCH_BYTES = 7_500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession) -> None:
    """From here on rows go to Python in Arrow batches of about ``BATCH_BYTES``, not Spark's 64 MB, of which a task
    holds several copies on both sides. A bound that the session has set itself stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder; what follows starts from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Whole texts; a null is an empty text."""
    return [x or "" for x in column.to_pylist()]


def map_texts(docs: DataFrame, id_col: str, text_col: str, schema: T.StructType | str,
              rows: Callable[[list, list[str]], Iterable[list]]) -> DataFrame:
    """``rows(ids, texts)`` gives the output columns for one Arrow batch, as lists.

    Only the two columns are read, so further columns of any name do no harm.
    """
    out = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                made = rows(b.column(0).to_pylist(), texts_of(b.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(made, arrow, strict=True)], schema=arrow)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, out)


def to_arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def signed(x: int) -> int:
    """An unsigned 64-bit number as the long with the same bits."""
    return x - (1 << 64) if x >= 1 << 63 else x


def has_repeats(df: DataFrame, key: str) -> bool:
    """Does a key occur on several rows? Reads the key column alone."""
    return not df.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").isEmpty()


def row_count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]

"""Best-fit packing of documents into training sequences, with conflicts.

A bin holds ``capacity`` tokens, no two documents of one duplicate cluster and at most
``per_source`` documents of one source. Bins are ordered by what they have left and carry
bitmaps of their sources and clusters. A document goes to the tightest bin that takes it:
the search starts at the first bin with room and goes on to its successors until one has no
conflict; if none has, a bin is opened. Documents go in by falling length.

A document over the capacity is cut: its full pieces are bins of their own, the rest is
packed. The documents are dealt to shards by hash of their id, about ``SHARD`` in each,
however many there are, and each shard packs its own; a hot source or cluster is so spread
over all shards.

Results: a document without tokens takes a place of length 0; null lengths count as 0; a
null source or cluster conflicts with nothing; repeated rows are packed each; a row without
id is packed as well; ties go by id; further columns are not read; an empty table gives an
empty table.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm import setjoin
from riskspark.llm.common import row_count, staged, text_batches, to_arrow
from riskspark.llm.periods import raw
from riskspark.llm.tokens import pieces

CAPACITY, PER_SOURCE = 8_192, 3
#: documents that one task packs, about
SHARD = 4_096
#: near copies: words of a shingle, and percent of the shingles of both that are shared
WORDS, PERCENT = 5, 80


def best_fit(length: list[int], source: list[int], cluster: list[int], capacity: int, per_source: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item; ``source`` and ``cluster`` number them from 0, -1 conflicts with nothing.

    Items come by falling length, each at most ``capacity`` long.
    """
    free: list[tuple[int, int]] = []                # (left, bin), ordered: the tightest bin with room is a successor
    full_sources: list[int] = []                    # bitmaps by bin: sources that may not come again
    levels: list[list[int]] = []                    # bitmaps by bin: sources with at least 1, 2, ... documents
    clusters: list[int] = []
    bins, offsets = [], []
    for n, s, c in zip(length, source, cluster, strict=True):
        s_bit, c_bit = (1 << s if s >= 0 else 0), (1 << c if c >= 0 else 0)
        at = bisect_left(free, (n, -1))
        while at < len(free) and (full_sources[free[at][1]] & s_bit or clusters[free[at][1]] & c_bit):
            at += 1
        if at < len(free):
            left, b = free.pop(at)
        else:
            left, b = capacity, len(clusters)
            full_sources.append(0)
            clusters.append(0)
            levels.append([0] * per_source)
        bins.append(b)
        offsets.append(capacity - left)
        clusters[b] |= c_bit
        for k, bitmap in enumerate(levels[b]):
            if not bitmap & s_bit:
                levels[b][k] = bitmap | s_bit
                break
        full_sources[b] = levels[b][-1]
        insort(free, (left - n, b))
    return bins, offsets


def numbered(values: pd.Series, repeated_only: bool) -> list[int]:
    """A number for each value, -1 for null (and for a value that occurs once, if it can't conflict)."""
    codes, names = pd.factorize(values)
    if repeated_only:
        n = np.bincount(codes[codes >= 0], minlength=len(names))
        again = np.cumsum(n > 1) - 1
        codes = np.where((codes >= 0) & (n[codes] > 1), again[codes], -1) if len(names) else codes
    return codes.tolist()


def pack(items: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> DataFrame:
    """(doc_id, piece, bin_id, bin_offset, n_tokens) from ``items`` (doc_id, n_tokens, source, cluster).

    ``bin_id`` is the shard and the bin in it.
    """
    kind = items.schema["doc_id"].dataType
    shards = max(1, math.ceil(row_count(items) / SHARD))
    # rows of one id, and those without, are spread too
    shard = F.pmod(F.xxhash64("doc_id", "n_tokens", "source", "cluster"), F.lit(shards)) if shards > 1 else F.lit(0).cast("long")
    schema = T.StructType([T.StructField("doc_id", kind), *(T.StructField(c, T.LongType()) for c in ("piece", "bin_id", "bin_offset", "n_tokens"))])

    def shard_bins(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = pdf["n_tokens"].fillna(0).astype(np.int64)
        pdf = pdf.assign(total=total, rest=np.where(total > 0, (total - 1) % capacity + 1, 0))
        pdf = pdf.sort_values(["rest", "doc_id", "total", "cluster"], ascending=[False, True, True, True], kind="stable")
        rest = pdf["rest"].tolist()
        bins, offsets = best_fit(rest, numbered(pdf["source"], False), numbered(pdf["cluster"], True), capacity, per_source)
        whole = ((pdf["total"] - pdf["rest"]) // capacity).to_numpy()
        ids = pdf["doc_id"].to_numpy()
        first = max(bins, default=-1) + 1
        row = np.repeat(np.arange(len(pdf)), whole)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(whole) - whole, whole)
        base = int(key[0]) << 32
        return pd.DataFrame({"doc_id": np.concatenate([ids, ids[row]]), "piece": np.concatenate([whole, piece]),
                             "bin_id": base + np.concatenate([np.array(bins, np.int64), first + np.arange(len(row))]),
                             "bin_offset": np.concatenate([np.array(offsets, np.int64), np.zeros(len(row), np.int64)]),
                             "n_tokens": np.concatenate([np.array(rest, np.int64), np.full(len(row), capacity)])})

    return items.withColumn("shard", shard).groupBy("shard").applyInPandas(shard_bins, schema)


def items_of(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, source, cluster): whole texts in tokens; texts with the same shingles are a cluster."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("source", docs.schema["source"].dataType), T.StructField("cluster", T.LongType())])
    arrow = to_arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, words = pieces(path), setjoin.WordHashes()
        for b in batches:
            texts = raw(b.column(1))
            n = known.counts(texts)
            sets = setjoin.shingle_sets(texts, WORDS, words)
            same = pa.array([setjoin.class_of(x) for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), b.column(2), same], schema=arrow)

    return docs.select("doc_id", "text", "source").mapInArrow(run, schema)


def near_items(docs: DataFrame, path: str) -> DataFrame:
    """``items_of`` with one cluster for each component of near copies (5 words, 0.8 or more), by the exact join.

    Tokens are counted in the pass over the texts that makes the shingles of the join."""
    def tokens_in(texts: list[bytes]) -> list[int]:
        return pieces(path).counts(texts)

    known, labels = setjoin.class_labels(docs, WORDS, PERCENT, "doc_id", "text", ("source",), tokens_in)
    return known.join(labels, "class", "left").select(
        "doc_id", F.col("measure").alias("n_tokens"), "source", F.coalesce("label", "class").alias("cluster"))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, per_source: int = PER_SOURCE, near: bool = True) -> DataFrame:
    """``near`` False is for documents that have no near copies any more."""
    text_batches(docs.sparkSession)
    return pack(staged(near_items(docs, path) if near else items_of(docs, path)), capacity, per_source)

"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

The index holds, in a folder that all executors share, one version after each change:

* ``refs``: which document holds which line key, one row each (the exact references);
* ``counts``: for each key its number of documents and the largest of them;
* ``filters``: for each shard of keys a cuckoo filter of those that at least ``min_docs``
  documents hold, so of the keys that are dropped somewhere.

``insert`` and ``delete`` take documents in and out; keys that come to ``min_docs`` or fall
below it go into or out of the filter of their shard, and a filter that is full is built
again from the counts. A document's lines are first looked up in the filters, inside the
task that holds them; what a filter lets through is joined with the exact counts, so a false
hit costs a look-up and never a line.

Results: a null or empty text is one empty line; lines that are too short for a key always
stay; a document given several times counts once, and each of its rows loses its lines; a
row without id holds no reference and keeps all lines; further columns pass through
untouched; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import row_count, texts_of, to_arrow
from riskspark.sources.session import ensure_checkpoint_dir

BLANKS = " \t\n\x0b\x0c\r"
SLOTS = 4
#: filters are broadcast in parts of so many bytes together
FILTER_BYTES = 64 << 20
#: the counts of so many lines at most, the most frequent ones, are broadcast; the others are joined by their key
COUNT_ROWS = 1_000_000
#: texts that a task holds as Python objects at once, with their lines
TEXTS = 256
#: keys of one shard when the index is laid out
SHARD_KEYS = 50_000


def keys_of(text: str, min_chars: int) -> list[tuple[int, int] | None]:
    """For each line its key as two longs, or None for a line that is too short."""
    out: list[tuple[int, int] | None] = []
    for line in text.split("\n"):
        key = line.strip(BLANKS) if len(line) >= min_chars else ""
        if len(key) >= min_chars:
            h = xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower())     # bytes.lower(): A-Z alone
            out.append((int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)))
        else:
            out.append(None)
    return out


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of ``TEXTS`` rows."""
    for b in batches:
        for at in range(0, b.num_rows, TEXTS):
            yield b.slice(at, TEXTS)


class Cuckoo:
    """A cuckoo filter with 16-bit tags; a key has two buckets, each the other's partner."""

    def __init__(self, buckets: int):
        self.mask = buckets - 1
        self.tags = np.zeros((buckets, SLOTS), np.uint16)

    @classmethod
    def holding(cls, hi: np.ndarray, lo: np.ndarray) -> Cuckoo:
        """A filter of these distinct keys, as small as they fit."""
        buckets = 1 << max(2, math.ceil(math.log2(max(1, len(hi)) / (0.85 * SLOTS))))
        while True:
            made = cls(buckets)
            if made.insert(hi, lo):
                return made
            buckets *= 2

    def places(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        tag = ((lo.astype(np.int64).view(np.uint64) & np.uint64(0xFFFF)) | np.uint64(1)).astype(np.uint16)
        first = (hi.astype(np.int64).view(np.uint64) & np.uint64(self.mask)).astype(np.int64)
        return tag, first, self.partner(first, tag)

    def partner(self, bucket, tag):
        return bucket ^ (np.int64(0x5BD1E995) * np.asarray(tag, np.int64) & self.mask)

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        tag, a, b = self.places(hi, lo)
        return ((self.tags[a] == tag[:, None]) | (self.tags[b] == tag[:, None])).any(axis=1)

    def insert(self, hi: np.ndarray, lo: np.ndarray) -> bool:
        """False if one found no place; the filter is then to be built anew."""
        tag, first, second = self.places(hi, lo)
        left = self._fill(tag, first)
        left = left[self._fill(tag[left], second[left])]
        return all(self._move(int(tag[i]), int(second[i])) for i in left)

    def _fill(self, tag: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Puts tags where a slot is free; positions of those that found none."""
        order = np.argsort(bucket, kind="stable")
        where = bucket[order]
        nth = np.arange(len(where)) - np.searchsorted(where, where, side="left")
        fits = nth < SLOTS - np.count_nonzero(self.tags[where], axis=1)
        where, which, nth = where[fits], order[fits], nth[fits]
        free_first = np.argsort(self.tags[where] != 0, axis=1, kind="stable")
        self.tags[where, free_first[np.arange(len(where)), nth]] = tag[which]
        return order[~fits]

    def _move(self, tag: int, bucket: int) -> bool:
        for step in range(500):
            row = self.tags[bucket]
            free = np.flatnonzero(row == 0)
            if len(free):
                row[free[0]] = tag
                return True
            slot = (step * 7 + tag) % SLOTS
            row[slot], tag = tag, int(row[slot])
            bucket = int(self.partner(bucket, tag))
        return False

    def remove(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Takes out keys that were put in."""
        tag, a, b = self.places(hi, lo)
        for t, x, y in zip(tag, a, b, strict=True):
            for bucket in (x, y):
                at = np.flatnonzero(self.tags[bucket] == t)
                if len(at):
                    self.tags[bucket, at[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        return self.tags.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Cuckoo:
        made = cls(len(raw) // (2 * SLOTS))
        made.tags = np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy()
        return made


def references(docs: DataFrame, min_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(hi, lo, id): each key of a document once."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("hi", T.LongType()), T.StructField("lo", T.LongType()), T.StructField(id_col, kind)])
    arrow = to_arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            hi, lo, who = [], [], []
            for i, text in zip(b.column(0).to_pylist(), texts_of(b.column(1)), strict=True):
                for h, low in {k for k in keys_of(text, min_chars) if k is not None}:
                    hi.append(h)
                    lo.append(low)
                    who.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(who, arrow.field(2).type)], schema=arrow)

    return docs.filter(F.col(id_col).isNotNull()).select(id_col, text_col).mapInArrow(run, schema)


class LineIndex:
    """References, counts and filters in ``folder``; each change writes a new version there."""

    def __init__(self, spark: SparkSession, folder: str | None = None, min_chars: int = 40, min_docs: int = 5,
                 id_col: str = "doc_id", text_col: str = "text"):
        self.spark, self.min_chars, self.min_docs, self.id_col, self.text_col = spark, min_chars, min_docs, id_col, text_col
        self.folder = folder or f"{ensure_checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
        self.version, self.shards = 0, 0

    def _path(self, name: str) -> str:
        return f"{self.folder}/v{self.version}/{name}"

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name))

    def _counted(self, refs: DataFrame) -> DataFrame:
        return refs.groupBy("hi", "lo").agg(F.count_distinct(self.id_col).alias("n_docs"), F.max(self.id_col).alias("last_doc"))

    def insert(self, docs: DataFrame) -> LineIndex:
        """Takes in documents; one that is there already may bring further lines."""
        fresh = references(docs, self.min_chars, self.id_col, self.text_col)
        before = self.version
        if before:
            old_refs, old = self._read("refs"), self._read("counts")
            fresh = fresh.join(old_refs, ["hi", "lo", self.id_col], "left_anti")
        self.version += 1
        fresh.write.parquet(self._path("new"))
        fresh = self._read("new")
        if before:
            old_refs.unionByName(fresh.distinct()).write.parquet(self._path("refs"))
            added = self._counted(fresh)
            joined = old.alias("o").join(added.alias("a"), ["hi", "lo"], "full").select(
                "hi", "lo", (F.coalesce("o.n_docs", F.lit(0)) + F.coalesce("a.n_docs", F.lit(0))).alias("n_docs"),
                F.greatest("o.last_doc", "a.last_doc").alias("last_doc"), F.coalesce("o.n_docs", F.lit(0)).alias("was"))
        else:
            fresh.distinct().write.parquet(self._path("refs"))
            joined = self._counted(self._read("refs")).withColumn("was", F.lit(0).cast("long"))
        return self._settle(joined, before)

    def delete(self, ids: DataFrame) -> LineIndex:
        """Takes out all references of the documents in ``ids`` (a column named like the id)."""
        old_refs, old, before = self._read("refs"), self._read("counts"), self.version
        ids = ids.select(self.id_col).distinct()
        gone = old_refs.join(ids, self.id_col, "left_semi")
        kept = old_refs.join(ids, self.id_col, "left_anti")
        self.version += 1
        kept.write.parquet(self._path("refs"))
        keys = gone.select("hi", "lo").distinct()
        again = self._counted(self._read("refs").join(keys, ["hi", "lo"], "left_semi"))
        touched = keys.join(again, ["hi", "lo"], "left").withColumn("touched", F.lit(True))
        joined = old.alias("o").join(touched.alias("t"), ["hi", "lo"], "left").select(
            "hi", "lo", F.when(F.col("t.touched"), F.coalesce("t.n_docs", F.lit(0))).otherwise(F.col("o.n_docs")).alias("n_docs"),
            F.when(F.col("t.touched"), F.col("t.last_doc")).otherwise(F.col("o.last_doc")).alias("last_doc"),
            F.col("o.n_docs").alias("was"))
        return self._settle(joined, before)

    def _settle(self, counts: DataFrame, before: int) -> LineIndex:
        """Writes the counts and brings the filters up to them."""
        least = self.min_docs
        counts.write.parquet(self._path("counts_all"))
        changed = self._read("counts_all")
        changed.filter("n_docs > 0").drop("was").write.parquet(self._path("counts"))
        keys = changed.filter((F.col("n_docs") >= least) | (F.col("was") >= least))
        if not self.shards:
            self.shards = max(16, math.ceil(row_count(keys) / SHARD_KEYS))
        shard = F.pmod(F.shiftright("hi", 32), F.lit(self.shards)).cast("int")
        keys = keys.select(shard.alias("shard"), "hi", "lo", (F.when(F.col("was") < least, 1).when(F.col("n_docs") < least, -1).otherwise(0)).alias("change"))

        def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            now = pdf[pdf["change"] >= 0]
            made = Cuckoo.holding(now["hi"].to_numpy(), now["lo"].to_numpy())
            return pd.DataFrame({"shard": [key[0]], "bits": [made.to_bytes()]})

        def update(key: tuple, had: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
            if not len(had):
                return build(key, pdf)
            made = Cuckoo.from_bytes(had["bits"].iloc[0])
            out, new = pdf[pdf["change"] < 0], pdf[pdf["change"] > 0]
            made.remove(out["hi"].to_numpy(), out["lo"].to_numpy())
            if not made.insert(new["hi"].to_numpy(), new["lo"].to_numpy()):
                return build(key, pdf)
            return pd.DataFrame({"shard": [key[0]], "bits": [made.to_bytes()]})

        kind = "shard int, bits binary"
        if before:
            had = self.spark.read.parquet(f"{self.folder}/v{before}/filters")
            filters = had.groupBy("shard").cogroup(keys.groupBy("shard")).applyInPandas(update, kind)
        else:
            filters = keys.groupBy("shard").applyInPandas(build, kind)
        filters.write.parquet(self._path("filters"))
        return self

    def drops(self, refs: DataFrame | None = None) -> DataFrame:
        """(id, hi, lo): the lines that the documents lose."""
        refs = self._read("refs") if refs is None else refs
        counts = self._read("counts").filter(F.col("n_docs") >= self.min_docs)
        filters = self._read("filters")
        size = filters.agg(F.sum(F.length("bits"))).first()[0] or 0
        refs = self._screened(refs, filters, min(self.shards, math.ceil(size / max(1, FILTER_BYTES))))
        common, rare = counts, None
        if row_count(counts) > COUNT_ROWS:
            # all documents of all lines together are n_docs added up, so at most COUNT_ROWS lines reach this bound
            bound = counts.agg(F.sum("n_docs")).first()[0] // COUNT_ROWS + 1
            common, rare = counts.filter(F.col("n_docs") >= bound), counts.filter(F.col("n_docs") < bound)
        # a line that a third of all documents hold meets no shuffle
        found = refs.join(F.broadcast(common), ["hi", "lo"])
        if rare is not None:
            found = found.unionByName(refs.join(rare, ["hi", "lo"]))
        return found.filter(F.col(self.id_col) != F.col("last_doc")).select(self.id_col, "hi", "lo").distinct()

    def _screened(self, refs: DataFrame, filters: DataFrame, parts: int) -> DataFrame:
        """References that the filter of their shard lets through; the filters come in parts, a
        reference meets the part of its shard."""
        shard, out = F.pmod(F.shiftright("hi", 32), F.lit(self.shards)), None
        for part in range(max(1, parts)):
            held = filters if parts <= 1 else filters.filter(F.col("shard") % parts == part)
            mine = refs if parts <= 1 else refs.filter(shard % parts == part)
            bits = self.spark.sparkContext.broadcast({r.shard: bytes(r.bits) for r in held.collect()})
            passed = screened(mine, bits, self.shards)
            out = passed if out is None else out.unionByName(passed)
        return out

    def clean(self, docs: DataFrame, make: Callable[[pa.RecordBatch, list[list[bool]]], pa.RecordBatch], schema: T.StructType,
              columns: list[str]) -> DataFrame:
        """``make(batch, keep)`` for all rows of ``docs`` with ``columns``; keep[i][j]: line j of text i stays."""
        text, least = self.text_col, self.min_chars
        mine, gone_lines = free_name(docs, "_lost_of"), free_name(docs, "_lost")
        lost = self.drops().groupBy(F.col(self.id_col).alias(mine)).agg(F.collect_list(F.struct("hi", "lo")).alias(gone_lines))
        joined = docs.select(*columns).join(lost, F.col(self.id_col) == F.col(mine), "left").drop(mine)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                gone = b.column(b.schema.get_field_index(gone_lines))
                hi, lo = (x.to_numpy(zero_copy_only=False) for x in gone.flatten().flatten())
                ends = np.cumsum(pc.fill_null(pc.list_value_length(gone), 0).to_numpy(zero_copy_only=False))
                keep, at = [], 0
                for t, end in zip(texts_of(b.column(b.schema.get_field_index(text))), ends.tolist(), strict=True):
                    if end > at:
                        out = set(zip(hi[at:end].tolist(), lo[at:end].tolist(), strict=True))
                        keep.append([k is None or k not in out for k in keys_of(t, least)])
                    else:
                        keep.append([])                  # all stay
                    at = end
                yield make(b.drop_columns([gone_lines]), keep)

        return joined.mapInArrow(run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many marks before it as ``df`` asks for (Spark does not tell upper from lower case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def screened(refs: DataFrame, bits, shards: int) -> DataFrame:
    """References that a filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {s: Cuckoo.from_bytes(raw) for s, raw in bits.value.items()}
        for b in batches:
            hi = b.column(b.schema.get_field_index("hi")).to_numpy()
            lo = b.column(b.schema.get_field_index("lo")).to_numpy()
            shard = (hi >> 32) % shards
            keep = np.zeros(len(hi), bool)
            for s in np.unique(shard).tolist():
                if s in filters:
                    at = np.flatnonzero(shard == s)
                    keep[at] = filters[s].contains(hi[at], lo[at])
            yield b.filter(pa.array(keep))

    return refs.mapInArrow(run, refs.schema)


def query(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every whole text."""
    index = LineIndex(docs.sparkSession, min_chars=min_chars, min_docs=min_docs).insert(docs)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_lines", T.LongType()),
                           T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    arrow = to_arrow(schema)

    def make(b: pa.RecordBatch, keep: list[list[bool]]) -> pa.RecordBatch:
        n, lost, sha = [], [], []
        for t, k in zip(texts_of(b.column(1)), keep, strict=True):
            n.append(t.count("\n") + 1)
            lost.append(len(k) - sum(k))
            sha.append(hashlib.sha256(kept(t, k).encode()).hexdigest())
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(lost, pa.int64()), pa.array(sha)], schema=arrow)

    return index.clean(docs, make, schema, ["doc_id", "text"])


def kept(text: str, keep: list[bool]) -> str:
    return "\n".join(line for line, k in zip(text.split("\n"), keep, strict=True) if k) if keep else text


def dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text`` (and ``n_chars``, if there, brought up to it)."""
    index = LineIndex(docs.sparkSession, min_chars=min_chars, min_docs=min_docs).insert(docs)
    schema, arrow = docs.schema, to_arrow(docs.schema)

    def make(b: pa.RecordBatch, keep: list[list[bool]]) -> pa.RecordBatch:
        columns = []
        was = b.column(b.schema.get_field_index("text"))
        now = [kept(t, k) if k else t for t, k in zip(was.to_pylist(), keep, strict=True)]
        for f, c in zip(arrow, b.columns, strict=True):
            if f.name == "text":
                c = pa.array(now, f.type)
            elif f.name == "n_chars":
                c = pa.array([len(t or "") if k else n for t, k, n in zip(now, keep, c.to_pylist(), strict=True)], f.type)
            columns.append(c.cast(f.type) if c.type != f.type else c)
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    return index.clean(docs, make, schema, [f"`{c}`" for c in docs.columns])

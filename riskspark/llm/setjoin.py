"""Exact n-gram Jaccard join by vertical partitioning, and the components of its links.

A document's set holds its distinct shingles as 64-bit hashes; documents with equal sets are one
class, so copies never meet each other. What cannot have a partner goes early:

1. Every part of the documents sends its shingles to fragments of the hash range, packed: 4 bytes
   of the hash and 2 bytes that say which document of the part it is (a shingle that occurs
   several times in a part is sent once). A fragment tells the parts which of their shingles
   occur elsewhere. A class can only have a partner if at least ``similarity`` percent of its
   shingles do; the shortened hashes may let some more through, never fewer.
2. The shingles of the classes that are left have a global order, rarest first. It is cut into
   fragments with equally many entries, and each class's ordered set falls into segments, one a
   fragment. Two sets that are similar enough share a shingle within their prefixes (all but
   the ``similarity`` percent that stand last), so only those meet in a list.
3. In each list a few classes lead and are paired with the classes of other component labels, as
   far as sizes and positions allow the similarity. Overlaps of the pairs are counted in each
   fragment separately and summed. Links join labels; a leader has met its whole list and
   leaves it. Rounds go on until every list has one label. First 1, 4, 16 classes of the
   commonest label lead, which brings in nearly all that belong to it; then also one class of
   each of the labels that are left, ever more of them. So a group of near copies costs some
   pairs for each member instead of all pairs, and no link between different labels is missed.

Results: a null or empty text, or one without words, has an empty set and is linked with nothing;
repeated rows get a row each; a row without id takes part, its component is the smallest id of
the others, or null; further columns are not read; an empty table gives an empty table. Sets
are compared by hashes of 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import row_count, staged, text_batches, to_arrow
from riskspark.llm.periods import mixed, raw
from riskspark.operators.components import component_roots
from riskspark.sources.session import written

SEED = 42
#: shingles of a fragment, about, and at most so many fragments (by powers of two)
FRAGMENT, MOST_FRAGMENTS = 1 << 20, 1 << 16
#: documents and bytes of text that one part packs
PART_ROWS, PART_BYTES = 50_000, 8_000_000
#: bytes of text whose words are held at once, words whose hash a worker keeps, and ids that are broadcast
WORD_BYTES, WORDS_KEPT, IDS_SENT = 1_000_000, 200_000, 1_000_000
MANY = 0xFFFF


class WordHashes(dict):
    """Hash of each word, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return h


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def turned(x: np.ndarray, k: int) -> np.ndarray:
    return (x << np.uint64(k)) | (x >> np.uint64(64 - k))


def word_hashes(flat: bytes, start: np.ndarray, size: np.ndarray, known: WordHashes) -> np.ndarray:
    """XXH64 of the words that begin at ``start`` in ``flat``: words of one length, up to 31 bytes, together."""
    out = np.zeros(len(start), np.uint64)
    flat += bytes(8)
    octets = np.frombuffer(flat, np.uint8)
    eight = np.ndarray(len(flat) - 7, "<u8", flat, strides=(1,)).astype(np.uint64)      # the 8 bytes from each place on
    order = np.argsort(np.minimum(size, 32).astype(np.uint8), kind="stable")
    cut = np.searchsorted(size[order], np.arange(1, 33)).tolist()
    for m in range(1, 32):
        of = order[cut[m - 1] : cut[m]]
        if not len(of):
            continue
        at, h = start[of], np.full(len(of), (SEED + int(_P5) + m) % (1 << 64), np.uint64)
        done = 0
        for _ in range(m // 8):
            h = turned(h ^ (turned(eight[at + done] * _P2, 31) * _P1), 27) * _P1 + _P4
            done += 8
        if m % 8 >= 4:
            h = turned(h ^ ((eight[at + done] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
            done += 4
        for k in range(done, m):
            h = turned(h ^ (octets[at + k] * _P5), 11) * _P1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        out[of] = h ^ (h >> np.uint64(32))
    for i in order[cut[-1] :].tolist():
        out[i] = known[flat[start[i] : start[i] + size[i]]]
    return out


def shingle_sets(texts: list[bytes], words: int, known: WordHashes) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; of the whole sequence if it is shorter."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= WORD_BYTES):
            size += len(texts[to])
            to += 1
        flat = b" ".join(texts[at:to]).lower()               # A-Z; cut at x20 and x09-x0D
        space = np.ones(len(flat) + 2, bool)
        space[1:-1] = _SPACE[np.frombuffer(flat, np.uint8)]
        edge = np.flatnonzero(space[1:] != space[:-1])
        start, end = edge[::2], edge[1::2]
        ends = np.cumsum([len(t) + 1 for t in texts[at:to]])
        n = np.diff(np.searchsorted(start, ends), prepend=0).tolist()
        out += sets_in(word_hashes(flat, start, end - start, known), n, words)
        at = to
    return out


def ordered(x: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def sets_in(w: np.ndarray, n: list[int], words: int) -> list[np.ndarray]:
    """The sets of texts with ``n`` words each, whose word hashes follow each other in ``w``."""
    factor = np.uint64(0x9E3779B97F4A7C15)
    h = w
    for k in range(1, words):
        h = mixed(h[: len(w) - k] * factor + w[k:]) if len(w) > k else h[:0]
    out, at = [], 0
    for m in n:
        if m >= words:
            out.append(ordered(h[at : at + m - words + 1]))
        elif m:
            x = w[at : at + 1]
            for k in range(1, m):
                x = mixed(x * factor + w[at + k : at + k + 1])
            out.append(mixed(x + np.uint64(m)))
        else:
            out.append(h[:0])
        at += m
    return out


def class_of(s: np.ndarray) -> int:
    """One number for equal sets, as a signed long."""
    x = xxhash.xxh3_64_intdigest(s.tobytes(), SEED)
    return x - (1 << 64) if x >= 1 << 63 else x


def mix_of(x: int) -> int:
    return xxhash.xxh3_64_intdigest(x.to_bytes(8, "big"), SEED)


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """(ids, texts) in parts of bounded size; a text is never cut."""
    for b in batches:
        size = np.cumsum([0, *(x or 0 for x in pa.compute.binary_length(b.column(1).cast(pa.binary())).to_pylist())])
        at = 0
        while at < b.num_rows:
            to = min(int(np.searchsorted(size, size[at] + PART_BYTES, "right")), at + PART_ROWS, b.num_rows)
            to = max(to, at + 1)
            yield b.column(0).slice(at, to - at), raw(b.column(1).slice(at, to - at))
            at = to


# -- which shingles occur elsewhere --------------------------------------------------------
def shared_counts(docs: DataFrame, words: int, id_col: str, text_col: str, beside: Sequence[str] = (),
                  measure: Callable[[list[bytes]], list[int]] | None = None) -> DataFrame:
    """(id, n, class, shared): size and class of each set, and how many of its shingles occur in other sets, at least.

    The columns ``beside`` come along, and ``measure``, a number of each text."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    bits = min(max(int(size / 6 / FRAGMENT), 1).bit_length() - 1, MOST_FRAGMENTS.bit_length() - 1)
    spread = 4_096                                           # what the parts' own rows are dealt to
    id_field = T.StructField(id_col, docs.schema[id_col].dataType)
    doc_fields = [id_field, T.StructField("n", T.LongType()), T.StructField("class", T.LongType()), T.StructField("at", T.IntegerType())]
    along = [*(T.StructField(c, docs.schema[c].dataType) for c in beside), *([T.StructField("measure", T.LongType())] if measure else [])]
    doc_fields += along
    sent = T.StructType([T.StructField("fragment", T.LongType()), T.StructField("part", T.LongType()), *doc_fields,
                         T.StructField("count", T.LongType()), T.StructField("keys", T.BinaryType()), T.StructField("rows", T.BinaryType())])
    sent_arrow = to_arrow(sent)
    nothing = {f.name: None for f in sent_arrow}

    def rows_of(columns: dict, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([c if isinstance(c := columns.get(f.name), pa.Array) else pa.array([None] * n if c is None else c, f.type)
                                           for f in sent_arrow], schema=sent_arrow)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part = WordHashes(), TaskContext.get().partitionId() << 24
        for mine, texts in parts_of(batches):
            ids, *others = mine.flatten()
            given = dict(zip(beside, others, strict=True)) | ({"measure": measure(texts)} if measure else {})
            sets = shingle_sets(texts, words, known)
            classes = [class_of(s) for s in sets]
            n = np.array([len(s) for s in sets], np.int64)
            _, first = np.unique(np.array(classes), return_index=True)          # copies within a part count once
            every = np.concatenate([sets[i] for i in first.tolist()])
            row = np.repeat(first, n[first])
            order = np.argsort(every)
            every, row = every[order], row[order]
            new = np.append(True, every[1:] != every[:-1]) if len(every) else np.zeros(0, bool)
            start = np.flatnonzero(new)
            times = np.diff(np.append(start, len(every)))
            here = np.bincount(row[np.repeat(times, times) > 1], minlength=len(sets))
            name = dict(zip(np.array(classes)[first].tolist(), first.tolist(), strict=True))
            here = here[[name[c] for c in classes]] if len(sets) else here
            yield rows_of(given | {"fragment": [-1 - mix_of(part) % spread] * len(sets), "part": [part] * len(sets), id_col: ids, "n": n, "class": classes,
                           "at": [name[c] for c in classes], "count": here}, len(sets))
            keys, owner = every[start], np.where(times > 1, MANY, row[start])
            of = keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
            short = (keys >> np.uint64(32 - bits)).astype(np.uint32)            # the 32 bits after those of the fragment
            cut = np.searchsorted(of, np.arange((1 << bits) + 1, dtype=np.uint64))
            used = [f for f in range(1 << bits) if cut[f] < cut[f + 1]]
            if used:
                yield rows_of(nothing | {
                    "fragment": used, "part": [part] * len(used), "keys": [short[cut[f] : cut[f + 1]].tobytes() for f in used],
                    "rows": [owner[cut[f] : cut[f + 1]].astype(np.uint16).tobytes() for f in used]}, len(used))
            part += 1

    answer = T.StructType([T.StructField("part", T.LongType()), *doc_fields, T.StructField("count", T.LongType()),
                           T.StructField("rows", T.BinaryType()), T.StructField("counts", T.BinaryType())])
    answer_arrow = to_arrow(answer)

    def tell(got: pa.Table) -> pa.Table:
        """Which documents of each part have how many shingles that occur elsewhere."""
        if got["fragment"][0].as_py() < 0:
            return got.drop_columns(["fragment", "keys"]).append_column("counts", pa.nulls(len(got), pa.binary())).cast(answer_arrow)
        keys = [np.frombuffer(x, np.uint32) for x in got["keys"].to_pylist()]
        owner = np.concatenate([np.frombuffer(x, np.uint16) for x in got["rows"].to_pylist()])
        part = np.repeat(np.arange(len(keys)), [len(x) for x in keys])
        every = np.concatenate(keys)
        order = np.argsort(every)
        every, owner, part = every[order], owner[order], part[order]
        start = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        times = np.diff(np.append(start, len(every)))
        twice = np.repeat((times > 1) | (np.maximum.reduceat(owner, start) == MANY), times) & (owner != MANY)
        pair, count = np.unique(part[twice] * (MANY + 1) + owner[twice], return_counts=True)
        cut = np.searchsorted(pair, np.arange(len(keys) + 1) * (MANY + 1))
        used = np.flatnonzero(cut[1:] > cut[:-1]).tolist()
        made = {f.name: pa.nulls(len(used), f.type) for f in answer_arrow}
        made["part"] = got["part"].take(pa.array(used, pa.int64()))
        made["rows"] = pa.array([(pair[cut[i] : cut[i + 1]] % (MANY + 1)).astype(np.uint16).tobytes() for i in used], pa.binary())
        made["counts"] = pa.array([count[cut[i] : cut[i + 1]].astype(np.uint32).tobytes() for i in used], pa.binary())
        return pa.table(made).cast(answer_arrow)

    out = T.StructType([id_field, *doc_fields[1:3], *along, T.StructField("shared", T.LongType())])
    out_arrow = to_arrow(out)

    def add(got: pa.Table) -> pa.Table:
        """The answers of all fragments to one part, summed."""
        mine = pa.compute.is_valid(got["class"])
        rows, answers = got.filter(mine), got.filter(pa.compute.invert(mine))
        total = np.zeros(MANY + 1, np.int64)
        for where, count in zip(answers["rows"].to_pylist(), answers["counts"].to_pylist(), strict=True):
            total[np.frombuffer(where, np.uint16)] += np.frombuffer(count, np.uint32)
        shared = rows["count"].to_numpy() + total[rows["at"].to_numpy()]
        return pa.table([rows[id_col], rows["n"], rows["class"], *(rows[f.name] for f in along), pa.array(shared, pa.int64())], schema=out_arrow)

    packed = docs.select(F.struct(id_col, *beside).alias("row"), text_col).mapInArrow(send, sent)
    return packed.groupBy("fragment").applyInArrow(tell, answer).groupBy("part").applyInArrow(add, out)


# -- ordered sets in segments --------------------------------------------------------------
def sets_of(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(class, n, hashes array<long>)"""
    schema = T.StructType([T.StructField("class", T.LongType()), T.StructField("n", T.LongType()), T.StructField("hashes", T.ArrayType(T.LongType()))])
    arrow = to_arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for _, texts in parts_of(batches):
            sets = shingle_sets(texts, words, known)
            yield pa.RecordBatch.from_arrays([
                pa.array([class_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([s.view(np.int64) for s in sets], arrow.field("hashes").type)], schema=arrow)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def least_shared(n: Column, percent: int) -> Column:
    """The smallest overlap that a set of this size has with a similar one."""
    return F.ceil(n * percent / F.lit(100)).cast("long")


def counted(sets: DataFrame) -> DataFrame:
    """Parts of ``sets`` with the number of sets each of their shingles occurs in, and how many shingles have each such number.

    A row with ``class`` is a set; one with ``counts`` has the numbers of the part's distinct shingles, in order, that fall
    to a fragment of the hash range; one with ``df`` says how many shingles of a fragment occur in ``df`` sets."""
    total = sets.agg(F.sum("n")).first()[0] or 0
    bits = min(max(int(total / FRAGMENT), 1).bit_length() - 1, MOST_FRAGMENTS.bit_length() - 1)
    spread = 4_096
    longs = lambda *names: [T.StructField(c, T.LongType()) for c in names]
    sent = T.StructType([*longs("fragment", "part", "class", "n"), *(T.StructField(c, T.BinaryType()) for c in ("keys", "times"))])
    answer = T.StructType([*longs("fragment", "part", "class", "n"), T.StructField("keys", T.BinaryType()), T.StructField("counts", T.BinaryType()), *longs("df", "shingles")])
    sent_arrow, answer_arrow = to_arrow(sent), to_arrow(answer)

    def filled(schema: pa.Schema, rows: int, **columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema=schema)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 24
        for b in batches:
            if not b.num_rows:
                continue
            lists = b.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy().view(np.uint64)
            ends = np.cumsum(sizes)
            yield filled(sent_arrow, b.num_rows, fragment=[-1 - mix_of(part) % spread] * b.num_rows, part=[part] * b.num_rows, n=b.column(1).to_pylist(),
                         keys=[flat[to - m : to].tobytes() for m, to in zip(sizes.tolist(), ends.tolist(), strict=True)], **{"class": b.column(0).to_pylist()})
            every = np.sort(flat)
            start = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
            times, keys = np.diff(np.append(start, len(every))).astype(np.uint32), every[start]
            cut = np.searchsorted(keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64), np.arange((1 << bits) + 1, dtype=np.uint64))
            used = [f for f in range(1 << bits) if cut[f] < cut[f + 1]]
            if used:
                yield filled(sent_arrow, len(used), fragment=used, part=[part] * len(used), keys=[keys[cut[f] : cut[f + 1]].tobytes() for f in used],
                             times=[times[cut[f] : cut[f + 1]].tobytes() for f in used])
            part += 1

    def tell(got: pa.Table) -> pa.Table:
        if got["fragment"][0].as_py() < 0:
            made = {f.name: got[f.name] if f.name in ("fragment", "part", "class", "n", "keys") else pa.nulls(len(got), f.type) for f in answer_arrow}
            return pa.table(made).cast(answer_arrow)
        keys = [np.frombuffer(x, np.uint64) for x in got["keys"].to_pylist()]
        times = np.concatenate([np.frombuffer(x, np.uint32) for x in got["times"].to_pylist()]).astype(np.int64)
        every = np.concatenate(keys)
        order = np.argsort(every)
        start = np.flatnonzero(np.append(True, every[order][1:] != every[order][:-1]))
        sums = np.add.reduceat(times[order], start)
        df = np.empty(len(every), np.int64)
        df[order] = np.repeat(sums, np.diff(np.append(start, len(every))))
        ends = np.cumsum([len(x) for x in keys]).tolist()
        kinds, shingles = np.unique(sums[sums > 1], return_counts=True)
        rows = [filled(answer_arrow, len(keys), fragment=got["fragment"].to_pylist(), part=got["part"].to_pylist(),
                       counts=[df[to - len(x) : to].astype(np.uint32).tobytes() for x, to in zip(keys, ends, strict=True)]),
                filled(answer_arrow, len(kinds), df=kinds, shingles=shingles)]
        return pa.Table.from_batches(rows, answer_arrow)

    return sets.select("class", "n", "hashes").mapInArrow(send, sent).groupBy("fragment").applyInArrow(tell, answer)


def cuts_of(shingles: list[tuple[int, int]]) -> np.ndarray:
    """Places in the global order that cut it into fragments with equally many entries; from (df, shingles)."""
    df, n = np.array(sorted(shingles), np.int64).reshape(-1, 2).T
    entries = np.cumsum(df * n)
    total = int(entries[-1]) if len(entries) else 0
    count = min(max(int(total / FRAGMENT), 1), 4_096)
    goal = np.arange(1, count) * (total / count)
    at = np.searchsorted(entries, goal)
    # within one number of sets the order is that of the hashes, which are spread evenly
    return df[at] + (goal - (entries - df * n)[at]) / (df * n)[at]


def segments(sets: DataFrame, percent: int) -> DataFrame:
    """(class, n, fragment, start, hashes): the shingles that occur in several sets, in the global order; ``start`` is the position of the first.

    The order is rarest first, then by hash. Position counts the shingles of the set that occur nowhere else, which are
    first of all. Sets go to the fragments of the hash range and back in packed parts.
    """
    told = staged(counted(sets))
    cuts = cuts_of([tuple(r) for r in told.filter("df is not null").groupBy("df").agg(F.sum("shingles")).collect()])
    out = T.StructType([*(T.StructField(c, T.LongType()) for c in ("class", "n", "fragment", "start")), T.StructField("hashes", T.ArrayType(T.LongType()))])
    out_arrow = to_arrow(out)

    def cut(got: pa.Table) -> pa.Table:
        mine = pa.compute.is_valid(got["class"])
        rows, answers = got.filter(mine), got.filter(pa.compute.invert(mine)).sort_by("fragment")
        df = np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(x, np.uint32) for x in answers["counts"].to_pylist())])
        lists = [np.frombuffer(x, np.uint64) for x in rows["keys"].to_pylist()]
        every = np.concatenate(lists)
        row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        df = df[np.searchsorted(ordered(every), every)]
        several = df > 1
        every, row, df = every[several], row[several], df[several]
        n = rows["n"].to_numpy()
        items = np.bincount(row, minlength=len(lists))
        kept = (items >= -(-n * percent // 100))[row]
        every, row, df = every[kept], row[kept], df[kept]
        place = df + (every >> np.uint64(11)).astype(np.float64) / float(1 << 53)
        order = np.lexsort((every, place, row))
        every, row, fragment = every[order], row[order], np.searchsorted(cuts, place[order], "right")
        new = np.append(True, (row[1:] != row[:-1]) | (fragment[1:] != fragment[:-1])) if len(row) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        of = row[first]
        start = (n - items)[of] + first - np.searchsorted(row, of)
        hashes = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)), pa.int32()), pa.array(every.view(np.int64)))
        return pa.table([rows["class"].take(pa.array(of)), pa.array(n[of]), pa.array(fragment[first]), pa.array(start), hashes], names=out.names).cast(out_arrow)

    return told.filter("part is not null").groupBy("part").applyInArrow(cut, out)


def prefix_lists(cut: DataFrame, percent: int) -> DataFrame:
    """(hash, class, n, pos): the entries of prefixes that several classes share."""
    length = F.col("n") - least_shared(F.col("n"), percent) + 1
    heads = cut.filter(F.col("start") < length).select("class", "n", "start", length.alias("length"), F.posexplode("hashes").alias("k", "hash")).select(
        "hash", "class", "n", (F.col("start") + F.col("k")).alias("pos"), "length").filter(F.col("pos") < F.col("length")).drop("length")
    return heads.join(heads.groupBy("hash").count().filter("count > 1").select("hash"), "hash", "left_semi")


# -- rounds of pairs ------------------------------------------------------------------------
def overlaps(pairs: DataFrame, cut: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (a, b, ...) with their overlap: counted in each fragment, summed for each pair.

    The segments of both ends come in one join, so the sets are dealt out once."""
    ends = pairs.withColumn("class", F.explode(F.array("a", "b")))
    met = ends.join(cut.select("class", "fragment", "hashes"), "class").repartition(*pairs.columns)
    both = met.groupBy(*pairs.columns, "fragment").agg(F.collect_list("hashes").alias("x")).filter(F.size("x") == 2)
    return both.groupBy(*pairs.columns).agg(F.sum(F.size(F.array_intersect(F.col("x")[0], F.col("x")[1]))).alias("overlap"))


def linked_labels(cut: DataFrame, percent: int) -> DataFrame:
    """(class, label): one label for the classes of each component; classes that meet no other are left out."""
    # the entries of the lists carry the labels of their classes
    named = written(prefix_lists(cut, percent).withColumn("label", F.col("class")))
    labels = named.select("class").distinct().withColumn("label", F.col("class"))
    turn = 0
    while True:
        groups = named.groupBy("hash", "label").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("class", "n", "pos")).alias("lead"))
        several = written(groups.groupBy("hash").agg(F.count(F.lit(1)).alias("labels"), F.max(F.struct("m", "label", "lead")).alias("most")).filter(
            "labels > 1").select("hash", F.col("most.label").alias("most"), F.col("most.lead").alias("lead")))
        if several.isEmpty():
            return labels
        chosen = several.select("hash", F.col("most").alias("lead_label"), "lead")
        if turn == 1:                                        # most lists are done by the first round; later ones read the sets of the others
            cut = written(cut.join(named.join(several.select("hash"), "hash", "left_semi").select("class").distinct(), "class", "left_semi"))
        if turn:
            chosen = named.join(several.select("hash", "most"), "hash").filter(F.col("label") == F.col("most")).withColumn(
                "_n", F.row_number().over(Window.partitionBy("hash").orderBy("class"))).filter(F.col("_n") <= 4 ** min(turn, 2)).select(
                "hash", F.col("label").alias("lead_label"), F.struct("class", "n", "pos").alias("lead"))
            others = groups.join(several.select("hash", "most"), "hash").filter(F.col("label") != F.col("most")).withColumn(
                "_n", F.row_number().over(Window.partitionBy("hash").orderBy("m", "label"))).filter(F.col("_n") <= 4 ** (turn - 1)).select(
                "hash", F.col("label").alias("lead_label"), "lead")
            chosen = written(chosen.unionByName(others) if turn > 2 else chosen)
        fits = (F.least("n", "lead.n") * 100 >= F.greatest("n", "lead.n") * percent) & (
            (F.least(F.col("n") - F.col("pos"), F.col("lead.n") - F.col("lead.pos"))) * (100 + percent) >= (F.col("n") + F.col("lead.n")) * percent)
        met = named.join(chosen, "hash").filter((F.col("label") != F.col("lead_label")) & fits)
        first = F.col("class") < F.col("lead.class")
        pairs = met.select(*[F.when(first, x).otherwise(y).alias(name) for name, x, y in (
            ("a", F.col("class"), F.col("lead.class")), ("b", F.col("lead.class"), F.col("class")),
            ("na", F.col("n"), F.col("lead.n")), ("nb", F.col("lead.n"), F.col("n")),
            ("src", F.col("label"), F.col("lead_label")), ("dst", F.col("lead_label"), F.col("label")))]).distinct()
        links = overlaps(pairs, cut).filter(F.col("overlap") * (100 + percent) >= (F.col("na") + F.col("nb")) * percent)
        roots = component_roots(links.select("src", "dst")).select(F.col("node").alias("label"), "root")
        labels = labels.join(roots, "label", "left").select("class", F.coalesce("root", "label").alias("label"))
        # a leader has met all of its list; a list with one label is done
        done = chosen.groupBy("hash").agg(F.collect_set("lead.class").alias("done"))
        named = written(named.join(done, "hash").filter(~F.array_contains("done", F.col("class"))).join(roots, "label", "left").select(
            "hash", "class", "n", "pos", F.coalesce("root", "label").alias("label")))
        turn += 1


def components(docs: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id): ``component_id`` is the smallest id that links lead to, itself included."""
    known, labels = class_labels(docs, words, percent, id_col, text_col)
    full, none = known.filter("n > 0"), known.filter("n = 0")
    named = full.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class")).select(id_col, "n", "label")
    least = named.groupBy("label").agg(F.min(id_col).alias("component_id"))
    return named.join(least, "label").select(id_col, F.col("n").alias("n_shingles"), "component_id").unionByName(
        none.select(id_col, F.col("n").alias("n_shingles"), F.col(id_col).alias("component_id")))


def class_labels(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str, beside: Sequence[str] = (),
                 measure: Callable[[list[bytes]], list[int]] | None = None) -> tuple[DataFrame, DataFrame]:
    """((id, n, class) of each row, with ``beside`` and ``measure``, (class, label) of the classes that may have links)."""
    text_batches(docs.sparkSession)
    known = staged(shared_counts(docs, words, id_col, text_col, beside, measure))
    classes = known.groupBy("class").agg(F.min(id_col).alias(id_col), F.max("n").alias("n"), F.max("shared").alias("shared"))
    open_ = staged(classes.filter((F.col("n") > 0) & (F.col("shared") >= least_shared(F.col("n"), percent))).select("class", id_col))
    ids = open_.filter(F.col(id_col).isNotNull()).select(id_col)
    ids = F.broadcast(ids) if row_count(ids) <= IDS_SENT else ids
    texts = docs.select(id_col, text_col)
    read = texts.join(ids, id_col, "left_semi")
    if not open_.filter(F.col(id_col).isNull()).isEmpty():
        read = read.unionByName(texts.filter(F.col(id_col).isNull()))
    sets = sets_of(read, words, id_col, text_col).join(open_.select("class"), "class", "left_semi").dropDuplicates(["class"])
    cut = written(segments(staged(sets), percent))
    return known.drop("shared"), linked_labels(cut, percent)

"""Token counts by a map-side two-tier look-up.

Tier one is a broadcast table of the most frequent pre-tokens and their lengths in tokens;
its size is fixed by ``table_size``. Tier two is a bounded cache in each Python worker, which
encodes what the table lacks, once. Texts and pre-tokens are never shuffled: only the short
summary that picks the frequent ones (``per_task`` rows of each task) meets in an aggregate.

The normaliser puts a blank before the text and writes blanks as U+2581. No piece has a
U+2581 after another character or a line feed beside anything, which is checked when the
model is loaded, so a text may be cut before a blank and before a line feed, and the counts add up.

Results: a null or empty text has 0 bytes and 0 tokens; repeated rows and ties are counted
alike; further columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import map_texts, texts_of
from riskspark.llm.setjoin import WORD_BYTES, WordHashes, word_hashes

#: entries of the broadcast table, and of the summary of one task
TABLE_SIZE, PER_TASK = 20_000, 1_000
#: a worker keeps so many pre-tokens
CACHE = 1_000_000
#: new parts that are encoded at once, and places of the table that a worker keeps (a power of two)
TOGETHER, PLACES = 500, 1 << 21
MARK = "▁"
#: blanks with what follows up to the next blank; used where two blanks meet
_runs = regex.compile(r" +[^ ]*")


class Lengths(dict):
    """Pre-token (without its first blank) -> tokens. Encodes what is not there."""

    def __init__(self, path: str):
        import sentencepiece

        super().__init__()
        self.tails: dict[str, int] = {}
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces):
            raise ValueError("texts can't be cut before blanks and line feeds with this model")
        if self.model.encode(" a") == self.model.encode("a") or self.model.encode("a") == self.model.encode("a "):
            raise ValueError("the model drops blanks")

    def __missing__(self, part: str) -> int:
        if len(self) > CACHE:
            self.clear()
        if part == "":
            n = 1                                    # a blank alone
        elif "\n" in part:
            first, *rest = part.split("\n")
            # alone, a line feed and abc are encoded with a blank before them, which is not there
            n = self[first] + sum(self.after_break(x) for x in rest)
        else:
            n = len(self.model.encode(part))
        self[part] = n
        return n

    def after_break(self, part: str) -> int:
        """Tokens of a line feed and what follows it."""
        n = self.tails.get(part)
        if n is None:
            if len(self.tails) > CACHE:
                self.tails.clear()
            n = self.tails[part] = len(self.model.encode("\n" + part)) - 1
        return n

    def count(self, text: str, table: dict[str, int]) -> int:
        if not text:
            return 0
        if MARK in text:
            text = text.replace(MARK, " ")
        if "  " in text or text[0] == " ":
            parts = [p[1:] for p in _runs.findall(" " + text)]
        else:
            parts = text.split(" ")
        if not table:
            return sum(map(self.__getitem__, parts))
        known = list(map(table.get, parts))
        if None in known:
            return sum(self[p] if k is None else k for p, k in zip(parts, known, strict=True))
        return sum(known)


class Pieces:
    """Tokens of many texts at once, as UTF-8. Texts are cut before blanks and line feeds in numpy, and a part is known
    by XXH64; a part that is new is encoded, together with others. What is known is a table of fixed size with two
    places for a hash, so a part that had to give way is encoded again."""

    def __init__(self, path: str):
        self.model, self.single = lengths(path).model, lengths(path)
        self.begins = np.array([self.model.id_to_piece(i).startswith(MARK) for i in range(self.model.get_piece_size())])
        self.keys, self.sizes = np.zeros((2, PLACES), np.uint64), np.zeros((2, PLACES), np.int32)
        self.long = WordHashes()

    def counts(self, texts: list[bytes]) -> list[int]:
        out: list[int] = []
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) <= WORD_BYTES):
                size += len(texts[to])
                to += 1
            out += self.block([t.replace(MARK.encode(), b" ") for t in texts[at:to]])
            at = to
        return out

    def block(self, texts: list[bytes]) -> list[int]:
        flat = b"".join(b" " + t for t in texts if t)
        if not flat:
            return [0] * len(texts)
        octets = np.frombuffer(flat, np.uint8)
        blank = octets == 0x20
        begin = blank | (octets == 0x0A)
        begin[1:] &= ~(blank[1:] & blank[:-1])               # a blank after a blank begins nothing,
        filled = np.array([len(t) for t in texts]) > 0
        first = np.cumsum([0, *(len(t) + 1 for t in texts if t)])[:-1]
        begin[first] = True                                  # unless a text does
        start = np.flatnonzero(begin)
        size = np.diff(start, append=len(flat))
        parts = np.searchsorted(start, first)
        after_blank = blank[start]                           # that blank is no part of the key, a line feed is
        start, size = start + after_blank, size - after_blank
        hashes = np.maximum(word_hashes(flat, start, size, self.long), np.uint64(1))         # 0 is a free place
        n = np.ones(len(start), np.int64)                    # a blank alone
        place = (hashes % np.uint64(PLACES)).astype(np.int64), (hashes // np.uint64(PLACES) % np.uint64(PLACES)).astype(np.int64)
        lacking = size > 0
        for k in (0, 1):
            hit = lacking & (self.keys[k][place[k]] == hashes)
            n[hit] = self.sizes[k][place[k][hit]]
            lacking &= ~hit
        lacking = np.flatnonzero(lacking)
        if len(lacking):
            new, one, whose = np.unique(hashes[lacking], return_index=True, return_inverse=True)
            one = lacking[one]
            made = self.encoded([flat[i : i + m] for i, m in zip(start[one].tolist(), size[one].tolist(), strict=True)])
            n[lacking] = made[whose]
            k = (self.keys[0][place[0][one]] != 0).astype(np.int64)                   # the second place, if the first is taken
            where = np.where(k, place[1][one], place[0][one])
            self.keys[k, where], self.sizes[k, where] = new, made
        total = np.zeros(len(texts), np.int64)
        total[filled] = np.add.reduceat(n, parts)
        return total.tolist()

    def encoded(self, parts: list[bytes]) -> np.ndarray:
        """Tokens of each part; many without blanks side by side, as each begins with a blank and so with a piece that does."""
        n = np.zeros(len(parts), np.int64)
        alone = [i for i, p in enumerate(parts) if b" " in p]
        for i in alone:
            n[i] = self.single[parts[i].decode("utf-8", "surrogatepass")]
        others = np.delete(np.arange(len(parts)), alone)
        for at in range(0, len(others), TOGETHER):
            of = others[at : at + TOGETHER]
            ids = np.array(self.model.encode(b" ".join([parts[i] for i in of.tolist()]).decode("utf-8", "surrogatepass")))
            n[of] = np.diff(np.flatnonzero(self.begins[ids]), append=len(ids))
        # before a line feed the model puts a blank that is not there
        return n - np.array([p[:1] == b"\n" for p in parts])


_loaded: dict[str, Lengths] = {}


def lengths(path: str) -> Lengths:
    if path not in _loaded:
        _loaded[path] = Lengths(path)
    return _loaded[path]


_pieces: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


def frequent(docs: DataFrame, path: str, text_col: str = "text", table_size: int = TABLE_SIZE,
             per_task: int = PER_TASK) -> Broadcast:
    """The broadcast table: counts over all texts, of which each task hands on its ``per_task`` largest.

    It decides nothing but where a length is looked up.
    """

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for text in texts_of(b.column(0)):
                seen.update(text.split(" "))
            if len(seen) > 20 * per_task:
                seen = Counter(dict(seen.most_common(4 * per_task)))
        top = [(w, n) for w, n in seen.most_common(per_task) if n > 1 and len(w) <= 40]
        yield pa.RecordBatch.from_pydict({"part": [w for w, _ in top], "n": [n for _, n in top]},
                                         schema=pa.schema([("part", pa.string()), ("n", pa.int64())]))

    rows = (docs.select(text_col).mapInArrow(summary, "part string, n long").groupBy("part").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "part").limit(table_size).collect())
    known = lengths(path)
    return docs.sparkSession.sparkContext.broadcast({r.part: known[r.part] for r in rows})


def count_tokens(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text",
                 table: Broadcast | None = None) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every whole text."""
    table = table or frequent(docs, path, text_col)

    def rows(ids, texts):
        known, first = lengths(path), table.value
        n = [known.count(t, first) for t in texts]
        return [ids, [len(t) if t.isascii() else len(t.encode()) for t in texts], n, [x > limit for x in n]]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, id_col, text_col, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean", rows)

"""BPE encoding and decoding by a pair occurrence index.

The pre-tokens of a partition that are not known yet are laid out side by side as one
sequence of symbols. An index maps every pair (by its rank) to all its positions; a heap
hands out the active ranks in ascending order; a rank is applied at all its positions at
once and the lists of the pairs that arise to the left and right are extended. Results are
kept per blank-free chunk in a bounded worker cache, so each chunk is worked out once.

A rank may be applied everywhere at once because no pair holds a symbol that a later rank
makes; the vocabulary is checked for that when it is loaded.

Results: a null text is an empty one and has no tokens; repeated rows and ties give the
same result each; further columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections import defaultdict

import numpy as np
import regex
from pyspark.sql import DataFrame

from riskspark.llm.common import map_texts

#: fixed values: white space and pre-token pattern of the vocabulary file
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{BLANK}\p{{L}}\p{{N}}]+"
#: a worker keeps so many chunks, and takes so many characters (one text at least) at a time
CACHE, BLOCK = 600_000, 8_000_000

_words = regex.compile(PATTERN)
_blanks = regex.compile(f"[{BLANK}]+")
#: characters that str.split() takes for white space and the pattern does not
_odd = regex.compile("[\x1c-\x1f]")
#: characters whose class and case do not depend on the Unicode version; others are cut by the library
SETTLED = "\x00-\u024f\u0370-\u0373\u0386-\u03ff\u0400-\u0481\u05d0-\u05ea\u2010-\u2027\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
_settled = regex.compile(f"[{SETTLED}]*+")
_settled_text = regex.compile(f"[{SETTLED}\u0300-\u036f]*+")


def byte_letters() -> list[str]:
    """Byte-level alphabet: printable Latin-1 stands for itself, the rest is moved to U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(moved)) for b in range(256)]


def distinct(at: np.ndarray) -> np.ndarray:
    at = np.sort(at)
    return at[np.append(True, at[1:] != at[:-1])] if len(at) else at


class WordBpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        self.path, self.library = path, None
        self.byte_of = {c: b for b, c in enumerate(byte_letters())}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        end = spec["model"]["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.size = 1 + max(vocab.values())
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + end] for c in letters], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        ranks = np.arange(len(merges))
        maker = np.full(self.size, -1)
        maker[made] = ranks
        if len(np.unique(made)) < len(made) or (np.maximum(maker[keys // self.size], maker[keys % self.size]) >= ranks).any():
            raise ValueError("a pair holds a symbol that a later rank makes; ranks can't be applied everywhere at once")
        order = np.argsort(keys)
        self.keys, self.rank_of, self.made = keys[order], ranks[order], made
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        names = {**vocab, **self.special}
        self.names: list[bytes] = [b""] * (1 + max(names.values()))
        for name, i in names.items():
            self.names[i] = name.encode()
        self.cache: dict[str, bytes] = {}

    # -- ranks ---------------------------------------------------------------------------
    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 for none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], -1)

    def merge_all(self, ids: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Apply the ranks to all words at once; True where a symbol is left. ``ids`` changes in place."""
        n = len(ids)
        alive = np.ones(n + 1, bool)
        nxt, prv = np.arange(1, n + 2), np.arange(-1, n)
        # the sentinel at n, also reached as -1, ends the first and last word
        sym, owner = np.append(ids, 0), np.append(word, -1)
        rank = np.full(n + 1, -1)
        rank[: n - 1] = np.where(word[:-1] == word[1:], self.ranks(ids[:-1], ids[1:]), -1)
        index: dict[int, list[np.ndarray]] = defaultdict(list)

        def enter(at: np.ndarray) -> None:
            at = at[rank[at] >= 0]
            if not len(at):
                return
            order = at[np.argsort(rank[at], kind="stable")]
            sorted_ranks = rank[order]
            first = np.flatnonzero(np.append(True, sorted_ranks[1:] != sorted_ranks[:-1]))
            for r, part in zip(sorted_ranks[first].tolist(), np.split(order, first[1:]), strict=True):
                if r not in index:
                    heapq.heappush(active, r)
                index[r].append(part)

        active: list[int] = []
        enter(np.arange(n))
        while active:
            r = heapq.heappop(active)
            at = distinct(np.concatenate(index.pop(r)))
            at = at[alive[at] & (rank[at] == r)]
            if not len(at):
                continue
            if (sym[at] == sym[nxt[at]]).all() and len(at) > 1:     # aaa: the leftmost pair first, then every other one
                joined = np.append(False, nxt[at[:-1]] == at[1:])
                start = np.maximum.accumulate(np.where(joined, 0, np.arange(len(at))))
                at = at[(np.arange(len(at)) - start) % 2 == 0]
            gone = nxt[at]
            sym[at] = self.made[r]
            alive[gone] = False
            rank[gone] = -1
            nxt[at] = nxt[gone]
            after = nxt[at]
            prv[after[after < n]] = at[after < n]
            before = prv[at]
            near = distinct(np.concatenate([at, before[before >= 0]]))
            near = near[alive[near]]
            right = np.minimum(nxt[near], n)
            rank[near] = np.where(owner[near] == owner[right], self.ranks(sym[near], sym[right]), -1)
            enter(near)
        ids[:] = sym[:n]
        return alive[:n]

    # -- texts ---------------------------------------------------------------------------
    def learn(self, chunks: list[str]) -> None:
        """Work out the ids of new chunks and keep them."""
        parts, whose = [], []
        for k, chunk in enumerate(chunks):
            if chunk.isascii() and chunk.isalpha():
                parts.append(chunk.encode())
                whose.append(k)
            else:
                found = self.cut(chunk)
                parts += found
                whose += [k] * len(found)
        per_chunk = np.zeros(len(chunks), np.int64)
        out = np.zeros(0, np.uint32)
        if parts:
            lengths = np.fromiter(map(len, parts), np.int64, len(parts))
            flat = np.frombuffer(b"".join(parts), np.uint8)
            ids = self.inner[flat]
            ends = np.cumsum(lengths) - 1
            ids[ends] = self.last[flat[ends]]
            word = np.repeat(np.arange(len(parts)), lengths)
            left = self.merge_all(ids, word)
            out = ids[left].astype("<u4")
            per_chunk = np.bincount(np.asarray(whose)[word[left]], minlength=len(chunks))
        raw, at = out.tobytes(), 0
        for chunk, k in zip(chunks, per_chunk.tolist(), strict=True):
            self.cache[chunk] = raw[at : at + 4 * k]
            at += 4 * k

    def cut(self, chunk: str) -> list[bytes]:
        """Pre-tokens of a chunk in lower case, as bytes."""
        if _settled.fullmatch(chunk):
            return [w.encode() for w in _words.findall(chunk)]
        return [bytes(self.byte_of[c] for c in word) for word, _ in self.rust().pre_tokenizer.pre_tokenize_str(chunk)]

    def rust(self):
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return self.library

    def chunks(self, text: str) -> list[str]:
        """Blank-free chunks in lower case, letter by letter: no final sigma."""
        if text.isascii():
            text = text.lower()
        elif not _settled_text.fullmatch(text):
            text = self.rust().normalizer.normalize_str(text)
        else:
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ").lower()
        return [c for c in _blanks.split(text) if c] if _odd.search(text) else text.split()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, start = [], 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size < BLOCK):
                size += len(texts[stop])
                stop += 1
            out += self.encode_block(texts[start:stop])
            start = stop
        return out

    def encode_block(self, texts: list[str]) -> list[bytes]:
        special = self._special
        cut = [[text] if special is None or "<|" not in text else special.split(text) for text in texts]
        # a text as chunks, with the ids of special tokens between them
        laid = [[self.chunks(p) if i % 2 == 0 else p for i, p in enumerate(parts)] for parts in cut]
        every = [p for parts in laid for p in parts if not isinstance(p, str)]
        missing = set().union(*(set(p).difference(self.cache) for p in every))
        if len(self.cache) + len(missing) > CACHE:
            self.cache.clear()
            missing = set().union(*map(set, every))
        if missing:
            self.learn(list(missing))
        known = self.cache.__getitem__
        return [b"".join(self.special[p].to_bytes(4, "little") if isinstance(p, str) else b"".join(map(known, p)) for p in parts) for parts in laid]

    def decode(self, ids: bytes) -> bytes:
        """The tokens, special ones too, joined by blanks, in UTF-8: the file names no decoder."""
        return b" ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict[str, WordBpe] = {}


def encoder(path: str) -> WordBpe:
    """One encoder for each worker and file; its cache outlives the task."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) of every whole text."""

    def rows(ids, texts):
        bpe = encoder(path)
        made = bpe.encode_batch(texts)
        return [ids, [np.frombuffer(m, "<u4").astype(np.int32) for m in made], [bpe.decode(m).decode() for m in made]]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, id_col, text_col, f"`{id_col}` {kind}, ids array<int>, decoded string", rows)


def encode_digest(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text."""

    def rows(ids, texts):
        bpe = encoder(path)
        made = bpe.encode_batch(texts)
        sha = hashlib.sha256
        return [ids, [len(m) // 4 for m in made], [sha(m).hexdigest() for m in made],
                [sha(bpe.decode(m)).hexdigest() for m in made]]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs, "doc_id", "text", f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", rows)

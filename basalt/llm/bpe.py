"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is cut into pre-tokens by the tokenizer's pattern.  Tier one: a minimal
perfect hash over the vocabulary (hash and displace, one slot per token)
resolves pre-tokens that are a token as a whole.  Tier two: all others are
merged on a doubly linked list of byte pieces, with a heap that always gives
the leftmost pair of the lowest rank.

Spark maps the documents in Arrow batches; tasks need nothing but their rows
and the vocabulary file, so a lost executor only costs its tasks.  Each worker
keeps a bounded memo of word -> ids; it changes the speed, never the result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from xxhash import xxh3_64_intdigest as _hash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basalt.llm.common import prepare, text_of

#: Words in one generation of a worker's memo, and their greatest length.
MEMO_WORDS, MEMO_LENGTH = 500_000, 48
#: Keys per bucket of the minimal perfect hash, on average.
BUCKET_KEYS = 2


class PerfectHash:
    """Minimal perfect hash from byte strings to 0..n-1, with their values.

    Hash and displace: keys are dealt to buckets; from the largest bucket on,
    each bucket gets the first seed that sends its keys to free slots.  Buckets
    of one key name their slot outright (as a negative seed).
    """

    def __init__(self, keys: list[bytes], values: list[int]) -> None:
        n = len(keys)
        self.n, self.buckets = max(n, 1), max(1, -(-n // BUCKET_KEYS))
        deal: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, k in enumerate(keys):
            deal[_hash(k) % self.buckets].append(i)
        self.seeds = [0] * self.buckets
        self.slots = [-1] * self.n
        self.keys, self.values = keys, values
        free = iter(())
        for b in sorted(range(self.buckets), key=lambda x: -len(deal[x])):
            own = deal[b]
            if len(own) == 1:
                x = next(free, None)
                if x is None:
                    free = iter([x for x, i in enumerate(self.slots) if i < 0])
                    x = next(free)
                self.seeds[b], self.slots[x] = -1 - x, own[0]
                continue
            seed = 1
            while own:
                at = [_hash(keys[i], seed) % self.n for i in own]
                if len(set(at)) == len(at) and all(self.slots[x] < 0 for x in at):
                    break
                seed += 1
            self.seeds[b] = seed
            for x, i in zip(at if own else (), own, strict=True):
                self.slots[x] = i

    def get(self, key: bytes) -> int:
        """The key's value, or -1: the slot's own key is compared."""
        seed = self.seeds[_hash(key) % self.buckets]
        i = self.slots[-1 - seed if seed < 0 else _hash(key, seed) % self.n]
        return self.values[i] if i >= 0 and self.keys[i] == key else -1


def merge(piece: bytes, rank_of: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: merge the leftmost pair of the lowest rank until none is left.

    Pieces are linked by start offset.  A heap entry holds a pair's rank and
    start; it is stale when the pair now at that start has another rank.
    """
    n, rank = len(piece), rank_of.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    ranks = [rank(piece[i:i + 2], -1) for i in range(n - 1)]
    ranks.append(-1)
    heap = [(r << 32) | i for i, r in enumerate(ranks) if r >= 0]
    heapq.heapify(heap)
    while heap:
        entry = heapq.heappop(heap)
        i = entry & 0xFFFFFFFF
        if ranks[i] != entry >> 32:
            continue
        j = after[i]
        end = after[i] = after[j]
        ranks[j] = -1
        if end < n:
            before[end] = i
            r = ranks[i] = rank(piece[i:after[end]], -1)
            if r >= 0:
                heapq.heappush(heap, (r << 32) | i)
        else:
            ranks[i] = -1
        p = before[i]
        if p >= 0:
            r = ranks[p] = rank(piece[p:end], -1)
            if r >= 0:
                heapq.heappush(heap, (r << 32) | p)
    out, i = [], 0
    while i < n:
        out.append(rank_of[piece[i:after[i]]])
        i = after[i]
    return out


class Memo:
    """A bounded memo in two generations: when the young one is full it becomes
    the old one, and entries still in use move up.  Holds at most twice
    MEMO_WORDS entries; long keys are not kept."""

    def __init__(self) -> None:
        self.young: dict = {}
        self.old: dict = {}

    def find(self, key: str, make):
        """The entry of a key, which ``make(key)`` gives if it is not known."""
        value = self.young.get(key) or self.old.get(key) or make(key)
        if len(key) <= MEMO_LENGTH:
            self.young[key] = value
        return value

    def age(self) -> None:
        """Call between documents: changes generations when the young one is full."""
        if len(self.young) >= MEMO_WORDS:
            self.old, self.young = self.young, {}


class Bpe:
    """Encoder and decoder for one rank file and pre-token pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex

        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        tokens, ids = [base64.b64decode(a) for a, _ in pairs], [int(b) for _, b in pairs]
        self.vocabulary = PerfectHash(tokens, ids)
        self.rank_of = dict(zip(tokens, ids, strict=True))
        self.token_of = dict(zip(ids, tokens, strict=True))
        self.split = regex.compile(pattern).findall
        self.memo = Memo()

    def _piece(self, piece: str) -> list[int]:
        raw = piece.encode()
        whole = self.vocabulary.get(raw)
        return [whole] if whole >= 0 else merge(raw, self.rank_of)

    def _word(self, word: str) -> tuple[tuple[int, ...], str]:
        out: list[int] = []
        for piece in self.split(word):
            out += self._piece(piece)
        return tuple(out), " ".join(map(str, out))

    def encode_with_text(self, text: str) -> tuple[list[int], str]:
        """The ids, and the same in decimal joined by blanks."""
        self.memo.age()
        get, find, make = self.memo.young.get, self.memo.find, self._word
        found = [get(w) or find(w, make) for w in words(text)]
        return list(chain.from_iterable([f[0] for f in found])), " ".join([f[1] for f in found])

    def encode(self, text: str) -> list[int]:
        return self.encode_with_text(text)[0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_of.__getitem__, ids))


ODD_SPACE = re.compile(r" \s")


def words(text: str) -> list[str]:
    """Cut a text before blanks, where the pattern always ends a pre-token.

    A blank before a non-space character starts a pre-token whatever comes
    before, so words with their leading blank can be encoded one by one.  That
    does not hold where white space follows a blank: such texts are cut only
    at blanks that no other white space touches.
    """
    if not text:
        return []
    if ODD_SPACE.search(text) is None:
        parts = text.split(" ")
        out = [" " + p for p in parts]
        out[0] = parts[0]
        return out if parts[0] else out[1:]
    return [w for w in re.split(r"(?<=\S)(?= \S)", text) if w]


_CODERS: dict[tuple[str, str], Bpe] = {}


def coder(path: str, pattern: str) -> Bpe:
    """One coder per worker process."""
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = Bpe(path, pattern)
    return _CODERS[path, pattern]


def encode_documents(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = True, with_bytes: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256; also ids
    (array of int) if ``with_ids`` and decoded (binary) if ``with_bytes``.

    Texts are encoded whole, without special tokens; null counts as empty (no
    ids, empty bytes).  ``path`` is a rank file that every executor can read
    (an installed file, or one given to ``SparkContext.addFile`` by its name).
    """
    prepare(df.sparkSession)
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
              ("decoded_sha256", pa.string())]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
        schema += ", ids array<int>"
    if with_bytes:
        fields.append(("decoded", pa.binary()))
        schema += ", decoded binary"
    out_schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        c = coder(path if os.path.exists(path) else SparkFiles.get(path), pattern)
        for batch in batches:
            cols: list[list] = [[] for _ in fields]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, decimal = c.encode_with_text(text)
                raw = c.decode(ids)
                row = [doc_id, len(ids), hashlib.sha256(decimal.encode()).hexdigest(), hashlib.sha256(raw).hexdigest()]
                row += [ids] * with_ids + [raw] * with_bytes
                for col, v in zip(cols, row, strict=True):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(cols, fields, strict=True)],
                                             schema=out_schema)

    return df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("t")).mapInArrow(run, schema)

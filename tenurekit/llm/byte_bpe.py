"""Byte-level BPE encoding and decoding in two tiers.

A vocabulary file of ranks (one ``base64 rank`` pair a line) is turned once, on
the driver, into a minimal perfect hash: buckets of tokens get a displacement
each so that every token has a slot of its own and no slot is free.  The arrays
are bounded by the vocabulary (``MAX_VOCABULARY``) and broadcast.  Tasks split
whole Arrow chunks into pre-tokens at once; tier one looks all of them up in
the perfect hash and compares the bytes of each with those of the token found.
What is no token goes, once per different pre-token and chunk, to tier two:
a heap of adjacent pairs over a linked list of bytes, lowest rank first, then
leftmost.

The pre-tokens are the matches of
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
found by runs of letters, numbers, white space and the rest.  Letters, numbers
and white space are those of the tiktoken library's own pattern engine.

Defined results: null and empty texts have no ids and decode to no bytes;
repeated rows get equal ids; very long pre-tokens are merged whole in
O(n log n); special tokens are ordinary text; an existing column with the name
of a result (``ids``, ``decoded``) is replaced, other columns stay; an unknown
id in ``decode`` is an error; null ids decode to no bytes.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textvec as tv

U = np.uint64
MAX_VOCABULARY = 1 << 21
#: pre-tokens that one Python worker remembers with their ids, in each of two
#: generations: when the young one is full it becomes the old one
MEMO_ENTRIES = 1 << 17
MEMO_BYTES = 64
DECODE_IDS = 1 << 20

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (a driver-local vocabulary file)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=1)
def code_point_classes() -> np.ndarray:
    """Class of every code point, asked from tiktoken's pattern engine: with
    single bytes as the only tokens an encoding returns what its pattern
    matches and skips the rest."""
    import tiktoken
    single = {bytes([i]): i for i in range(256)}
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        found = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        out[np.frombuffer(bytes(found).decode().encode("utf-32-le"), np.uint32)] = kind
    return out


class Vocabulary:
    """Token bytes, ids and the minimal perfect hash over them, as arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        if not 0 < len(ranks) <= MAX_VOCABULARY:
            raise ValueError(f"{len(ranks)} tokens; 1 to {MAX_VOCABULARY} are allowed")
        if any(bytes([i]) not in ranks for i in range(256)):
            raise ValueError("a byte-level vocabulary holds every single byte")
        tokens = sorted(ranks, key=ranks.get)
        self.ids = np.array([ranks[t] for t in tokens], np.int64)
        if len(np.unique(self.ids)) < len(tokens):
            raise ValueError("two tokens share a rank")
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.offsets = np.zeros(len(tokens) + 1, np.int64)
        np.cumsum([len(t) for t in tokens], out=self.offsets[1:])
        self.classes = code_point_classes()
        self._build(tv.span_hashes(self.blob, self.offsets[:-1], self.offsets[1:], False))
        self._ranks = None

    def _build(self, h: np.ndarray) -> None:
        n = len(h)
        if len(np.unique(h)) < n:
            raise ValueError("two tokens share a hash")
        m = max(1, n // 3)
        keys = _seed_key(np.arange(1 << 12))
        bucket = (h % U(m)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(m + 1))
        self.seeds, self.slots = np.zeros(m, np.int64), np.full(n, -1, np.int64)
        for k in np.argsort(cuts[:-1] - cuts[1:], kind="stable").tolist():
            own = order[cuts[k]:cuts[k + 1]]
            if len(own) < 2:
                break
            seed = 0
            while True:  # 32 displacements at a time
                if seed + 32 > len(keys):
                    keys = _seed_key(np.arange(2 * len(keys)))
                tried = _place(h[own][None, :], keys[seed:seed + 32, None], n)
                tight = np.sort(tried, axis=1)
                good = (self.slots[tried] < 0).all(axis=1) & (tight[:, 1:] != tight[:, :-1]).all(axis=1)
                if good.any():
                    at = int(np.argmax(good))
                    self.seeds[k], self.slots[tried[at]] = seed + at, own
                    break
                seed += 32
        # single tokens take the slots that are left, written down directly
        sizes = np.diff(cuts)
        alone, free = np.flatnonzero(sizes == 1), np.flatnonzero(self.slots < 0)
        self.seeds[alone] = -1 - free
        self.slots[free] = order[cuts[alone]]

    def __getstate__(self):
        return self.__dict__ | {"_ranks": None}

    @property
    def ranks(self) -> dict[bytes, int]:
        if self._ranks is None:
            raw, o = self.blob.tobytes(), self.offsets.tolist()
            self._ranks = {raw[a:z]: i for a, z, i in zip(o, o[1:], self.ids.tolist())}
        return self._ranks

    def find(self, b: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Index of the token that each span of bytes is, -1 where it is none."""
        seed = self.seeds[(h % U(len(self.seeds))).astype(np.int64)]
        at = self.slots[np.where(seed < 0, -1 - seed, _place(h, _seed_key(np.maximum(seed, 0)), len(self.slots)))]
        same = tv.same_spans(b, starts, ends, self.blob, self.offsets[at], self.offsets[at + 1])
        return np.where(same, at, -1)


def _seed_key(seed: np.ndarray) -> np.ndarray:
    return tv.mix(seed.astype(np.uint64) + U(1))


def _place(h: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    return (tv.mix(h ^ key) % U(n)).astype(np.int64)


def pre_tokens(b: np.ndarray, offsets: np.ndarray, classes: np.ndarray):
    """Byte starts and ends of the pre-tokens of rows of UTF-8 text, and the
    index of each row's first one."""
    n = len(b)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = classes[:128][np.minimum(b, 127)]
    wide = np.flatnonzero(b >= 0xC0)
    if len(wide):
        more = 1 + (b[wide] >= 0xE0) + (b[wide] >= 0xF0)  # bytes that follow
        point = b[wide].astype(np.int64) & (0x3F >> more)
        for k in (1, 2, 3):
            has = more >= k
            point[has] = point[has] << 6 | b[wide[has] + k] & 0x3F
        of = classes[np.minimum(point, 0x10FFFF)]
        kind[wide] = of
        for k in (1, 2, 3):
            has = more >= k
            kind[wide[has] + k] = of[has]
    row_start = np.zeros(n + 1, bool)
    row_start[offsets] = True  # offsets equal to n stand for the end
    row_start[n] = True
    token = row_start[:n].copy()
    token[1:] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(token)
    run_end = np.append(runs[1:], n)
    run_kind = kind[runs]
    # white space before something else gives its last character away: a blank
    # joins what follows, any other one stands alone
    s = np.flatnonzero((run_kind == SPACE) & ~row_start[run_end])
    last = run_end[s] - 1
    for _ in range(3):
        last = last - ((b[last] & 0xC0) == 0x80)
    token[last] = True
    blank = b[last] == 0x20
    token[run_end[s][blank]] = False
    # an apostrophe alone, not taken by a blank, with one of the endings
    q = np.flatnonzero((b[runs] == 0x27) & (run_end - runs == 1) & (run_kind == OTHER))
    q = q[token[runs[q]] & ~row_start[run_end[q]]]
    if len(q):
        at = runs[q]
        pad = np.append(b, np.zeros(2, np.uint8))
        x, y = pad[at + 1], pad[at + 2]
        same_row = ~row_start[np.minimum(at + 2, n)]
        two = same_row & (((y == 0x65) & ((x == 0x72) | (x == 0x76))) | ((y == 0x6C) & (x == 0x6C)))
        one = (x == 0x73) | (x == 0x74) | (x == 0x6D) | (x == 0x64)
        for end, these in ((at[one] + 2, at[one]), (at[two] + 3, at[two])):
            token[these + 1] = False
            token[end[end < n]] = True
    starts = np.flatnonzero(token)
    return starts, np.append(starts[1:], n), np.searchsorted(starts, offsets)


def merge_heap(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token: nodes are linked spans of bytes; the heap holds the
    adjacent pairs that form a token, stale ones are passed over."""
    n = len(piece)
    end, before = [*range(1, n + 1), -1], [*range(-1, n)]
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, a, mid, z = heapq.heappop(heap)
        if end[a] != mid or end[mid] != z:
            continue
        end[a], end[mid] = z, -1
        if z < n:
            before[z] = a
            if (r := ranks.get(piece[a:end[z]])) is not None:
                heapq.heappush(heap, (r, a, z, end[z]))
        p = before[a]
        if p >= 0 and (r := ranks.get(piece[p:z])) is not None:
            heapq.heappush(heap, (r, p, a, z))
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at:end[at]]])
        at = end[at]
    return out


class Encoder:
    """Ids of the rows of a chunk; remembers short pre-tokens, bounded."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.young, self.old = vocabulary, {}, {}

    def merged(self, piece: bytes) -> list[int]:
        ids = self.young.get(piece)
        if ids is None:
            ids = self.old.get(piece) or merge_heap(piece, self.v.ranks)
            if len(piece) <= MEMO_BYTES:
                if len(self.young) >= MEMO_ENTRIES:
                    self.young, self.old = {}, self.young
                self.young[piece] = ids
        return ids

    def encode(self, b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(list offsets, ids) of rows of UTF-8 text."""
        starts, ends, first = pre_tokens(b, offsets, self.v.classes)
        h = tv.span_hashes(b, starts, ends, False)
        found = self.v.find(b, starts, ends, h)
        length = np.ones(len(starts), np.int64)
        miss = np.flatnonzero(found < 0)
        if len(miss):
            _, rep, use = np.unique(h[miss], return_index=True, return_inverse=True)
            rep = miss[rep]
            same = tv.same_spans(b, starts[miss], ends[miss], b, starts[rep][use], ends[rep][use])
            for k in np.flatnonzero(~same).tolist():  # equal hash, other bytes: looked up by itself
                use[k], rep = len(rep), np.append(rep, miss[k])
            raw = b.tobytes()
            pieces = [self.merged(raw[a:z]) for a, z in zip(starts[rep].tolist(), ends[rep].tolist())]
            sizes = np.array([len(p) for p in pieces], np.int64)
            flat = np.fromiter((i for p in pieces for i in p), np.int64, int(sizes.sum()))
            length[miss] = sizes[use]
        at = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(length, out=at[1:])
        ids = np.empty(int(at[-1]), np.int32)
        hit = np.flatnonzero(found >= 0)
        ids[at[hit]] = self.v.ids[found[hit]]
        if len(miss):
            where = np.cumsum(sizes) - sizes
            ids[tv.ragged(at[miss], sizes[use])] = flat[tv.ragged(where[use], sizes[use])]
        return at[first], ids


def _encode(sent, into):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value)
        for batch in batches:
            for lo, hi, b, offsets in tv.text_chunks(batch.column("text")):
                at, ids = encoder.encode(b, offsets)
                part = batch.slice(lo, hi - lo)
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, into])
    return run


def _decode(sent, ids_column, into):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = sent.value
        index = np.full(int(v.ids.max()) + 1, -1, np.int64)
        index[v.ids] = np.arange(len(v.ids))
        for batch in batches:
            col = batch.column(ids_column)
            lengths = np.nan_to_num(col.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            upto = np.cumsum(lengths)
            lo = 0
            while lo < len(col):
                base = upto[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(upto, base + DECODE_IDS, side="right")))
                part = batch.slice(lo, hi - lo)
                ids = part.column(ids_column).flatten()
                if ids.null_count:
                    raise ValueError("null id")
                ids = ids.to_numpy(zero_copy_only=False).astype(np.int64)
                if len(ids) and (ids.min() < 0 or ids.max() >= len(index) or index[ids].min() < 0):
                    raise ValueError("unknown id")
                token = index[ids]
                size = v.offsets[token + 1] - v.offsets[token]
                raw = v.blob[tv.ragged(v.offsets[token], size)]
                ends = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(lengths[lo:hi])))]
                out = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([*part.columns, out], [*part.schema.names, into])
                lo = hi
    return run


def _with(df: DataFrame, name: str, kind: str) -> tuple[DataFrame, str]:
    kept = [c for c in df.columns if c.lower() != name.lower()]
    d = df.select(*[f"`{c}`" for c in kept])
    return d, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema), f"`{name}` {kind}"])


def load(spark, path: str):
    """The vocabulary of a rank file, broadcast; its size is checked."""
    return spark.sparkContext.broadcast(Vocabulary(read_ranks(path)))


def encode(docs: DataFrame, vocabulary, into: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text`` (array of int); ``vocabulary`` from ``load``."""
    d, schema = _with(docs, into, "array<int>")
    return d.mapInArrow(_encode(vocabulary, into), schema)


def decode(df: DataFrame, vocabulary, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the bytes that its ids stand for."""
    d, schema = _with(df, into, "binary")
    return d.mapInArrow(_decode(vocabulary, ids, into), schema)

"""Vectorised tokenising and hashing of Arrow string columns.

A whole Arrow batch is handled as one UTF-8 byte array.  Words are runs of
bytes of a class, their hashes come from one prefix sum over the bytes
(a polynomial hash modulo 2**64 over random byte values, finished by a
mixer), and n-gram hashes from the word hashes.  No Python loop runs over
words or characters.  Text is taken in chunks of bounded size, so memory
does not follow the batch size; a document is never split.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK_BYTES = 1 << 20

_rng = np.random.default_rng(20240229)
_BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
NGRAM_BASE = U(0xD6E8FEB86659FD93)

_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
#: word bytes of [^\x20\x09-\x0D]+
SPACED = ~_space
_alnum = np.zeros(256, bool)
_alnum[0x30:0x3A] = True
_alnum[0x61:0x7B] = True
_alnum[0x80:] = True
#: word bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z are lower-cased
ALNUM = _alnum.copy()
ALNUM[0x41:0x5B] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32
_VALUES_FOLD = _BYTE_VALUES[FOLD]

_powers = {"n": 0}


def _pow_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        size = max(n, CHUNK_BYTES)
        with np.errstate(over="ignore"):
            for key, base in (("p", _BASE), ("i", _BASE_INV)):
                a = np.full(size, U(base), dtype=np.uint64)
                a[0] = 1
                _powers[key] = np.multiply.accumulate(a)
        _powers["n"] = size
    return _powers["p"], _powers["i"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finishing mixer (splitmix64)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
        return h ^ (h >> U(31))


def crc_of_id(doc_id) -> int:
    """crc32 of the id as text; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def text_chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of chunks of whole rows
    that hold about ``limit`` bytes; null rows have no bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        col, kind = col.cast(pa.string()), np.int32
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if n == 0:
        return
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, kind)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def word_spans(b: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray):
    """Byte starts and ends of the words, and for each row the index of its
    first word (one entry more than rows)."""
    w = word_bytes[b]
    before = np.zeros(len(b), bool)
    before[1:] = w[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(b)]
    before[cuts] = False
    starts = np.flatnonzero(w & ~before)
    after = np.zeros(len(b), bool)
    after[:-1] = w[1:]
    cuts = offsets[1:]
    cuts = cuts[cuts > 0] - 1
    after[cuts] = False
    ends = np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
    """Hash of each byte span; with ``fold`` A-Z counts as a-z."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    p, inv = _pow_tables(len(b) + 1)
    with np.errstate(over="ignore"):
        s = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((_VALUES_FOLD if fold else _BYTE_VALUES)[b] * p[:len(b)], out=s[1:])
        return mix((s[ends] - s[starts]) * inv[starts])


def word_hashes(b, offsets, word_bytes, fold):
    """Word hashes, and for each row the index of its first word."""
    starts, ends, first = word_spans(b, offsets, word_bytes)
    return span_hashes(b, starts, ends, fold), first


def ngram_hashes(wh: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n items from each place on (len(wh) - n + 1 of them, none
    if there are fewer items); windows that leave a row are the caller's to
    mask.  Different n never share a hash by construction of the seed."""
    m = len(wh) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.full(m, U(n), dtype=np.uint64)
        for j in range(n):
            h = h * NGRAM_BASE + wh[j:j + m]
    return mix(h)


def hash_of_words(words: list[str]) -> np.ndarray:
    """Word hashes of a Python list (already lower-cased where that matters)."""
    if not words:
        return np.zeros(0, np.uint64)
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    ends = np.cumsum([len(w) for w in raw])
    b = np.frombuffer(b"".join(raw), np.uint8)
    return span_hashes(b, ends - np.array([len(w) for w in raw]), ends, False)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each span, one span after the other."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


def same_spans(a: np.ndarray, a_starts, a_ends, b: np.ndarray, b_starts, b_ends) -> np.ndarray:
    """Whether each byte span of ``a`` equals its span of ``b``, byte by byte."""
    same = (a_ends - a_starts) == (b_ends - b_starts)
    at = np.flatnonzero(same)
    lengths = (a_ends - a_starts)[at]
    if int(lengths.sum()):
        differ = a[ragged(a_starts[at], lengths)] != b[ragged(b_starts[at], lengths)]
        ends = np.cumsum(lengths)
        wrong = np.concatenate(([0], np.cumsum(differ)))
        same[at] = wrong[ends] == wrong[ends - lengths]
    return same

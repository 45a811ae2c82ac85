"""Benchmark decontamination by windows of normalised words.

Every benchmark item is cut into windows of ``n`` consecutive words (an item
of fewer words, but not none, is one window).  Their hashes form sorted arrays
that are broadcast after a check of their number; a larger benchmark is taken
in several parts, one index and one broadcast at a time, so no window is left
out.  The hits of all parts are gathered on the unchanged texts before anything
is cut, so the number of parts never changes a result.  Tasks scan
the token windows of every document against the hashes and verify each hit on
the words themselves before it counts.

Defined results: null or wordless texts have no words, no hits and are clean;
an empty benchmark leaves everything clean; repeated items both count; null
item ids match but are not listed; extra columns are ignored (``decontaminate``
keeps them, whatever their names).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .base import stored

#: windows per broadcast part: 2**20 of at most a few hundred bytes each
MAX_PART_WINDOWS = 1 << 20
_SIEVE_BITS = 22


def benchmark_windows(benchmark: DataFrame, n: int = 10) -> DataFrame:
    """Distinct (words of a window, item_id) rows of the benchmark."""
    from .base import LOWER, UPPER
    words = F.expr(r"regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', 0)")
    items = (benchmark.select(F.col("item_id").cast("string").alias("item_id"),
                              F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER).alias("t"))
             .select("item_id", words.alias("w")).filter(F.size("w") > 0))
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (n - 1), F.lit(1)))).alias("i")
    return (items.select("item_id", "w", at)
            .select(F.array_join(F.expr(f"slice(w, i, {n})"), " ").alias("words"), "item_id").distinct())


class WindowIndex:
    """Sorted hash arrays of a part of the benchmark, by window length."""

    def __init__(self, rows: list[tuple[str, list[str]]]):
        self.words = [r[0] for r in rows]
        self.items = [list(r[1]) for r in rows]
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(self.words):
            by_length.setdefault(w.count(" ") + 1, []).append(i)
        self.by_length = {}
        for length, ids in by_length.items():
            h = np.array([tv.ngram_hashes(tv.hash_of_words(self.words[i].split(" ")), length)[0] for i in ids], np.uint64)
            order = np.argsort(h, kind="stable")
            sieve = np.zeros(1 << _SIEVE_BITS, bool)
            sieve[(h >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)] = True
            self.by_length[length] = (h[order], np.array(ids)[order], sieve)

    def hits(self, wh: np.ndarray, first: np.ndarray):
        """(place, length, window) of possible hits, for words of whole rows."""
        row_end = np.repeat(first[1:], np.diff(first))
        for length, (hashes, ids, sieve) in self.by_length.items():
            h = tv.ngram_hashes(wh, length)
            at = np.flatnonzero(sieve[(h >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)])
            at = at[at + length <= row_end[at]]
            lo = np.searchsorted(hashes, h[at], side="left")
            hi = np.searchsorted(hashes, h[at], side="right")
            for place, a, z in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                for k in range(a, z):
                    yield place, length, int(ids[k])


def _scan(index: WindowIndex | None, with_spans: bool, names: list[str]):
    fold = tv.FOLD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx = index.value
        for batch in batches:
            n_words, hit_lists, items = [], [], []
            for lo, hi, b, offsets in tv.text_chunks(batch.column("text")):
                starts, ends, first = tv.word_spans(b, offsets, tv.ALNUM)
                wh = tv.span_hashes(b, starts, ends, True)
                n_words += np.diff(first).tolist()
                hit = np.zeros(len(wh), bool)
                found: dict[int, set] = {}
                for place, length, k in idx.hits(wh, first):
                    text = b" ".join(fold[b[starts[j]:ends[j]]].tobytes() for j in range(place, place + length))
                    if text.decode("utf-8", "replace") == idx.words[k]:
                        hit[place:place + length] = True
                        row = int(np.searchsorted(first, place, side="right")) - 1
                        found.setdefault(row, set()).update(idx.items[k])
                for r in range(hi - lo):
                    items.append(sorted(found.get(r, ())))
                    if r not in found:
                        hit_lists.append([])
                        continue
                    p = np.flatnonzero(hit[first[r]:first[r + 1]])
                    cut = np.flatnonzero(np.diff(p) > 1)
                    a, z = p[np.r_[0, cut + 1]], p[np.r_[cut, len(p) - 1]]
                    row = []
                    for s, e in zip(a.tolist(), z.tolist()):
                        row += [s, e + 1]
                        if with_spans:  # byte places in the text
                            row += [int(starts[first[r] + s] - offsets[r]), int(ends[first[r] + e] - offsets[r])]
                    hit_lists.append(row)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n_words, pa.int64()), pa.array(hit_lists, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
                [*batch.schema.names, *names])
    return run


def window_parts(benchmark: DataFrame, n: int, max_windows: int) -> Iterator[WindowIndex]:
    """The benchmark's windows in parts of at most about ``max_windows``, built
    one at a time."""
    w = benchmark_windows(benchmark, n).groupBy("words").agg(F.collect_set("item_id").alias("items"))
    parts = 1 + w.count() // max_windows
    part = F.pmod(F.xxhash64("words"), F.lit(parts))
    for k in range(parts):
        yield WindowIndex([(r.words, r["items"]) for r in (w if parts == 1 else w.filter(part == k)).collect()])


def _free(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores before them until no column has them."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


def _scanned(docs: DataFrame, index: WindowIndex, names: list[str], with_spans: bool) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(index)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_scan(sent, with_spans, names), f"{schema}, `{names[0]}` long, `{names[1]}` array<long>, `{names[2]}` array<string>")


def _runs(hits, step: int):
    """[start, end) runs of word places as structs, from a flat array."""
    at = F.sequence(F.lit(0), F.greatest(F.size(hits) - step, F.lit(0)), F.lit(step))
    return F.when(F.size(hits) > 0, F.transform(at, lambda i: F.struct(F.get(hits, i).alias("s"), F.get(hits, i + 1).alias("e")))).otherwise(
        F.array().cast("array<struct<s: bigint, e: bigint>>"))


def _covered(hits):
    """Number of words in the union of the runs, which may overlap."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(F.array_sort(_runs(hits, 2)), zero, lambda a, r: F.struct(
        (a["n"] + F.greatest(F.lit(0).cast("long"), r["e"] - F.greatest(r["s"], a["upto"]))).alias("n"),
        F.greatest(a["upto"], r["e"]).alias("upto")), lambda a: a["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10,
                  max_part_windows: int = MAX_PART_WINDOWS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = _all_hits(docs.select("doc_id", "text"), benchmark, n, max_part_windows, ["_n_words", "_hits", "_items"], False)
    n_hit, items = _covered(F.col("_hits")), F.array_sort(F.array_distinct("_items"))
    return found.select(
        "doc_id", F.col("_n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def _all_hits(docs: DataFrame, benchmark: DataFrame, n: int, max_windows: int, names: list[str], with_spans: bool) -> DataFrame:
    """``docs`` with the hits of every part, found on the unchanged texts.  With
    several parts the table is stored after each, so that one part's index is in
    memory at a time."""
    parts = window_parts(benchmark, n, max_windows)
    words, hits, items = names
    out = _scanned(docs, next(parts), names, with_spans)
    more = _free(out.columns, "more_words", "more_hits", "more_items")
    for part in parts:
        out = _scanned(stored(out, "decontam-part"), part, more, with_spans)
        out = out.withColumns({hits: F.concat(hits, more[1]), items: F.concat(items, more[2])}).drop(*more)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, mode: str = "document",
                  max_part_windows: int = MAX_PART_WINDOWS) -> DataFrame:
    """``docs`` without what the benchmark holds, same columns.

    ``mode="document"`` removes every contaminated document; ``mode="span"``
    cuts the hit words (from the first to the last byte of each run) out of
    the texts and keeps the documents."""
    if mode not in ("document", "span"):
        raise ValueError(f"unknown mode {mode}")
    names = _free(docs.columns, "_n_words", "_hits", "_items")
    found = _all_hits(docs, benchmark, n, max_part_windows, names, True)
    hits = F.col(f"`{names[1]}`")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if mode == "document":
        return found.filter(F.size(hits) == 0).select(*columns)
    cut = F.udf(_cut, "string")("text", hits)
    return found.withColumn("text", F.when(F.size(hits) == 0, F.col("text")).otherwise(cut)).select(*columns)


def _cut(text: str | None, hits: list[int]) -> str | None:
    """The text without the byte spans of the runs, which may overlap."""
    if text is None:
        return None
    raw, kept, upto = text.encode("utf-8", "surrogatepass"), [], 0
    for a, z in sorted(zip(hits[2::4], hits[3::4])):
        if a > upto:
            kept.append(raw[upto:a])
        upto = max(upto, z)
    return b"".join([*kept, raw[upto:]]).decode("utf-8", "replace")

"""Source divergence audit by iceberg prefix refinement.

Which terms occur in at least ``min_docs`` documents of a language is found
without counting the endless tail of rare terms as a whole.  Terms are looked at
by byte prefixes of 6, 12, 24, ... bytes.  Each level scans the documents,
counts the distinct documents of every prefix (and of every term that ends
within the level, by source), and discards what stays below the threshold; the
next level only extends words whose prefix was kept.  A term is counted at the
one level in which it ends, exactly, on its bytes.  Prefixes that are kept reach
the next scan as a bit filter of bounded size (``MAX_FILTER_BITS``): a false
positive is only counted once more and discarded again, so the filter's size
never changes a result.  Levels end when no longer prefix is kept.

Counts are summed per Arrow chunk before they leave Python, then by Spark; no
group, source or term meets in one task as rows of documents.  Sums over pairs
of sources are taken in blocks of terms (a matrix sources x terms of bounded
size) and leave a task as one row for each pair.

Defined results: null text, lang and source count as ''; a group without terms
has count 0 everywhere; empty tables give no rows; repeated rows are documents
of their own; ties are ordered by the item's bytes; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .base import stored

U = np.uint64
FIRST_LEVEL = 6
CHUNK = 1 << 22
MAX_FILTER_BITS = 1 << 27
#: more groups than this are joined instead of broadcast, and are too many for pairs
MAX_GROUPS = 200_000
BLOCK_CELLS = 1 << 20

#: bytes of terms: [^\x00-\x40\x5B-\x60\x7B-\x7F]+
TERM = np.zeros(256, bool)
TERM[0x41:0x5B] = TERM[0x61:0x7B] = TERM[0x80:] = True

LEVEL = "lang string, source string, key binary, complete boolean, docs long, count long"


def _lang_keys(langs: list[str]) -> np.ndarray:
    return tv.hash_of_words([f"{x}\0" for x in langs])


def _bit(prefix_hash: np.ndarray, lang_key: np.ndarray, bits: int) -> np.ndarray:
    return (tv.mix(prefix_hash ^ lang_key) & U(bits - 1)).astype(np.int64)


def _runs(key: np.ndarray, row: np.ndarray, b, starts, ends):
    """Groups of equal (key hash, bytes): (one member, distinct rows, members) of each."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    head = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    size = np.diff(np.append(head, len(k)))
    rep = np.repeat(order[head], size)
    folded = tv.FOLD[b]
    if not tv.same_spans(folded, starts[order], ends[order], folded, starts[rep], ends[rep]).all():
        # two keys share a hash: number the bytes themselves
        names: dict[bytes, int] = {}
        exact = [names.setdefault(folded[a:z].tobytes(), len(names)) for a, z in zip(starts.tolist(), ends.tolist())]
        _, group = np.unique(key, return_inverse=True)
        _, key = np.unique(np.stack([group, exact]), axis=1, return_inverse=True)
        order = np.argsort(key, kind="stable")
        k = key[order]
        head = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        size = np.diff(np.append(head, len(k)))
    r = row[order]
    new_row = np.concatenate(([True], (r[1:] != r[:-1]) | (k[1:] != k[:-1])))
    return order[head], np.add.reduceat(new_row.astype(np.int64), head), size


def _scan(below: int, level: int, bits, n_bits: int):
    """Counts of one level: words longer than ``below`` bytes whose prefix of
    that length is in the filter (all words at the first level)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None if bits is None else np.unpackbits(np.frombuffer(bits.value, np.uint8), bitorder="little").view(bool)
        for batch in batches:
            lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
            lang_of, source_of = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (lang, source))
            lang_key = _lang_keys(lang.dictionary.to_pylist())
            n_sources = len(source.dictionary)
            for lo, hi, b, offsets in tv.text_chunks(batch.column("text"), CHUNK):
                starts, ends, first = tv.word_spans(b, offsets, TERM)
                row = np.repeat(np.arange(lo, hi), np.diff(first))
                if kept is not None:
                    long = np.flatnonzero(ends - starts > below)
                    starts, ends, row = starts[long], ends[long], row[long]
                    parent = tv.span_hashes(b, starts, starts + below, True)
                    some = np.flatnonzero(kept[_bit(parent, lang_key[lang_of[row]], n_bits)])
                    starts, ends, row = starts[some], ends[some], row[some]
                if not len(starts):
                    continue
                complete = ends - starts <= level
                upto = np.minimum(ends, starts + level)
                h = tv.span_hashes(b, starts, upto, True)
                for whole in (True, False):
                    at = np.flatnonzero(complete == whole)
                    if not len(at):
                        continue
                    group = lang_of[row[at]]
                    if whole:
                        group = group * n_sources + source_of[row[at]]
                    key = tv.mix(h[at] ^ tv.mix(group.astype(np.uint64) + U(1)))
                    rep, docs, count = _runs(key, row[at], b, starts[at], upto[at])
                    rep = at[rep]
                    size = upto[rep] - starts[rep]
                    places = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                    keys = pa.Array.from_buffers(pa.binary(), len(rep), [None, pa.py_buffer(places), pa.py_buffer(tv.FOLD[b[tv.ragged(starts[rep], size)]])])
                    sources = source.dictionary.take(pa.array(source_of[row[rep]])) if whole else pa.nulls(len(rep), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [lang.dictionary.take(pa.array(lang_of[row[rep]])), sources, keys,
                         pa.array(np.full(len(rep), whole)), pa.array(docs), pa.array(count)],
                        ["lang", "source", "key", "complete", "docs", "count"])
    return run


def _filter_words(n_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, lang = batch.column("key"), batch.column("lang").dictionary_encode()
            off = np.frombuffer(key.buffers()[1], np.int32)[key.offset:key.offset + len(key) + 1].astype(np.int64)
            raw = np.frombuffer(key.buffers()[2], np.uint8)
            lang_key = _lang_keys(lang.dictionary.to_pylist())[lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)]
            bit = _bit(tv.span_hashes(raw, off[:-1], off[1:], True), lang_key, n_bits)
            word, use = np.unique(bit >> 6, return_inverse=True)
            value = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(value, use, U(1) << (bit & 63).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value.view(np.int64))], ["word", "value"])
    return run


def _filter(prefixes: DataFrame, n: int):
    """(broadcast bits, number of bits) of the kept prefixes."""
    n_bits = min(max(1 << (16 * n - 1).bit_length(), 1 << 16), MAX_FILTER_BITS)
    words = (prefixes.select("lang", "key").mapInArrow(_filter_words(n_bits), "word long, value long")
             .groupBy("word").agg(F.bit_or("value").alias("value")).toPandas())
    bits = np.zeros(n_bits // 64, np.int64)
    bits[words["word"].to_numpy(np.int64)] = words["value"].to_numpy(np.int64)
    return prefixes.sparkSession.sparkContext.broadcast(bits.tobytes()), n_bits


def kept_terms(docs: DataFrame, min_docs: int = 3, first_level: int = FIRST_LEVEL) -> DataFrame:
    """(lang, term, docs, count, per: array of (source, count)) of the terms in
    at least ``min_docs`` documents of a language, by prefix refinement."""
    d = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    done, below, level, bits, n_bits = None, 0, first_level, None, 0
    while True:
        found = stored(d.mapInArrow(_scan(below, level, bits, n_bits), LEVEL)
                       .groupBy("lang", "source", "key", "complete")
                       .agg(F.sum("docs").alias("docs"), F.sum("count").alias("count")), "prefix-level")
        terms = (found.filter("complete").groupBy("lang", F.col("key").alias("term"))
                 .agg(F.sum("docs").alias("docs"), F.sum("count").alias("count"),
                      F.collect_list(F.struct("source", "count")).alias("per"))
                 .filter(F.col("docs") >= min_docs))
        done = terms if done is None else done.unionByName(terms)
        longer = found.filter(~F.col("complete") & (F.col("docs") >= min_docs))
        n = longer.count()
        if n == 0:
            return done
        bits, n_bits = _filter(longer, n)
        below, level = level, 2 * level


def _share(count, total, kept):
    """1 + floor(10^9 (count + 1) / (total + kept)), exact for any count."""
    return F.expr(f"1 + (cast(1000000000 as decimal(38, 0)) * ({count} + 1)) div cast({total} + {kept} as decimal(38, 0))")


def _gap(p: str, q: str):
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def shares(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """The same for an array of counts."""
    if len(count) and int(count.max()) >= 9_000_000_000:  # past 64 bits: Python's integers
        count = count.astype(object)
    return np.asarray(1 + 1_000_000_000 * (count + 1) // (total + kept), dtype=np.int64)


def _pair_sums(constants):
    """Sums over all kept terms of floor((p - q)^2 / q) for pairs of sources of
    a language, in blocks of terms; one row a pair leaves a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = constants.value
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            lang = batch.column("lang").to_numpy(zero_copy_only=False)
            per = batch.column("per")
            sizes = per.value_lengths().to_numpy().astype(np.int64)
            ends = np.cumsum(sizes)
            flat = per.flatten()
            names, counts = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for x in dict.fromkeys(lang):
                index, totals, kept = known[x]
                n = len(index)
                total = sums.setdefault(x, np.zeros((n, n), np.int64))
                rows = np.flatnonzero(lang == x)
                width = max(1, BLOCK_CELLS // n)
                for lo in range(0, len(rows), width):
                    block = rows[lo:lo + width]
                    at = tv.ragged(ends[block] - sizes[block], sizes[block])
                    matrix = np.zeros((n, len(block)), np.int64)
                    who = np.fromiter((index[s] for s in names[at]), np.int64, len(at))
                    matrix[who, np.repeat(np.arange(len(block)), sizes[block])] = counts[at]
                    p = np.stack([shares(matrix[k], totals[k], kept) for k in range(n)])
                    for k in range(n):
                        total[k] += ((p[k] - p) ** 2 // p).sum(axis=1)
        for x, total in sums.items():
            name = list(known[x][0])
            n = len(name)
            other = ~np.eye(n, dtype=bool)
            s, t = np.nonzero(other)
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(s), pa.string()), pa.array([name[k] for k in s], pa.string()),
                                              pa.array([name[k] for k in t], pa.string()), pa.array(total[other])], ["lang", "source", "item", "value"])
    return run


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200, first_level: int = FIRST_LEVEL) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source's term shares
    stand from those of the other sources (``pair``) and of its language
    (``term``, the ``top`` terms)."""
    spark = docs.sparkSession
    kept = stored(kept_terms(docs, min_docs, first_level), "kept-terms")
    pairs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    by_source = (kept.select("lang", F.explode("per").alias("x")).groupBy("lang", F.col("x.source").alias("source"))
                 .agg(F.sum("x.count").alias("total")))
    by_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("count").alias("lang_total"))
    groups = stored(pairs.join(by_source, ["lang", "source"], "left").join(by_lang, "lang", "left")
                    .fillna(0, ["total", "kept", "lang_total"]), "audit-groups")
    n_groups = groups.count()
    if n_groups > MAX_GROUPS:
        raise ValueError(f"{n_groups} groups of lang and source; pairs of more than {MAX_GROUPS} are not listed")
    known: dict[str, tuple[dict, list, int]] = {}
    for r in groups.orderBy("lang", "source").collect():
        index, totals, _ = known.setdefault(r["lang"], ({}, [], r["kept"]))
        index[r["source"]] = len(index)
        totals.append(r["total"])
    sums = (kept.select("lang", "per").mapInArrow(_pair_sums(spark.sparkContext.broadcast(known)), "lang string, source string, item string, value long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    every = (groups.select("lang", "source").join(F.broadcast(groups.select("lang", F.col("source").alias("item"))), "lang")
             .filter("source <> item"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = (every.join(sums, ["lang", "source", "item"], "left").fillna(0, ["value"])
            .withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair")))
    term = (kept.select("lang", F.col("term").cast("string").alias("item"), F.col("count").alias("lang_count"), F.explode("per").alias("x"))
            .select("lang", "item", "lang_count", F.col("x.source").alias("source"), F.col("x.count").alias("n"))
            .join(F.broadcast(groups), ["lang", "source"])
            .withColumn("p", _share("n", "total", "kept")).withColumn("q", _share("lang_count", "lang_total", "kept"))
            .filter("p > q").withColumn("value", _gap("p", "q"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).withColumn("part", F.lit("term")))
    columns = ["lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")]
    return pair.select(*columns).unionByName(term.select(*columns))

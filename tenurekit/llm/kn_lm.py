r"""Interpolated modified Kneser-Ney bigram model, counted and applied in Spark.

Tokens are the words ``[^\x20\x09-\x0D]+`` after A-Z are lower-cased, then one
end of text.  P(w | h) = (c(hw) - D(c(hw))) / c(h) + g(h) P(w), with three
discounts from the counts of counts, and P(w) the same way from the numbers of
contexts that w follows, interpolated with 1 / (V + 1).

Neither the corpus nor the model passes through one task.  Documents are
packed into chunks of about ``CHUNK_BYTES`` of text, stored once as sorted
word-hash arrays and token numbers.  The model is dealt over shards of words and of
bigrams; their number follows the corpus.  Bigram counts go back to the chunks
that asked and are not kept as arrays, so no other text can be scored.  A
chunk sends each distinct word and bigram once to the shard that holds it and
gets the slice of the model back in its own order.  Scoring maps that slice
from a file into memory and needs no search per token.  Contexts that hold
more than 1/``HOT_SHARE`` of the tokens are dealt over several shards, and their
sums, a bounded number, are put together afterwards.

Words are 48-bit hashes, bigrams 64-bit hashes within a shard (two words of
a vocabulary of 10^7 share one with a chance of 3e-8 each).

Defined results: null counts as the empty text, whose only token is the end;
rows are held out by their id, a null id counting as the empty text; repeated
rows count as often as they occur; without training rows P is 1 / (V + 1) = 1
for every token; very long texts make a chunk of their own; other columns are
not read.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .base import id_crc, release, stored

CHUNK_BYTES = 8 << 20
HOT_SHARE = 1024
BEGIN, END = np.uint64(0), np.uint64(1)
U = np.uint64


# ---- arrays as bytes -------------------------------------------------------

def pack48(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack48(b: bytes) -> np.ndarray:
    x = np.zeros((len(b) // 6, 8), np.uint8)
    x[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return x.view("<u8").ravel()


def pack_counts(a: np.ndarray) -> bytes:
    """One byte each, 255 for those that follow in eight bytes each."""
    large = a >= 255
    return np.where(large, 255, a).astype(np.uint8).tobytes() + a[large].astype("<u8").tobytes()


def unpack_counts(b: bytes, n: int) -> np.ndarray:
    a = np.frombuffer(b, np.uint8, n).astype(np.int64)
    a[a == 255] = np.frombuffer(b, "<u8", offset=n).astype(np.int64)
    return a


def pack_numbers(a: np.ndarray) -> bytes:
    """Small numbers in one byte, others in three; all in four if one passes 2^22."""
    if len(a) and int(a.max()) >= 192 + (64 << 16):
        return b"\1" + a.astype("<u4").tobytes()
    large = a >= 192
    high = np.where(large, 192 + ((a - 192) >> 16), a)
    return b"\0" + high.astype(np.uint8).tobytes() + ((a[large] - 192) & 0xFFFF).astype("<u2").tobytes()


def unpack_numbers(b: bytes, n: int) -> np.ndarray:
    if b[:1] == b"\1":
        return np.frombuffer(b, "<u4", n, 1).astype(np.int64)
    a = np.frombuffer(b, np.uint8, n, 1).astype(np.int64)
    large = a >= 192
    a[large] = ((a[large] - 192) << 16) + np.frombuffer(b, "<u2", offset=n + 1).astype(np.int64) + 192
    return a


def shard_of(ids: np.ndarray, shards: int) -> np.ndarray:
    """Shard of 48-bit ids; it rises with the id."""
    return ((ids >> U(16)) * U(shards) >> U(32)).astype(np.int64)


def _slices(shard: np.ndarray):
    """(shard, from, to) of a sorted array of shards."""
    cut = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else np.zeros(0, int)
    for a, z in zip(cut.tolist(), np.r_[cut[1:], len(shard)].tolist()):
        yield int(shard[a]), a, z


def _sums(ids: np.ndarray, *counts: np.ndarray):
    """Sorted distinct ids and the sums of their counts."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    new = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, int)
    return (ids[new], *(np.add.reduceat(c[order], new) if len(new) else c[:0] for c in counts))


# ---- chunks ------------------------------------------------------------------

def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, learn, hashes, sizes, held = [], [], [], [], 0

    def out():
        # words by falling count, so that most tokens have small numbers
        words, tokens, counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        col = pa.concat_arrays(ids)
        return pa.RecordBatch.from_arrays(
            [pa.array([uuid.uuid4().hex]), pa.ListArray.from_arrays(pa.array([0, len(col)], pa.int32()), col),
             pa.array([np.concatenate(learn)], pa.list_(pa.bool_())), pa.array([pack48(words[order])], pa.binary()),
             pa.array([pack_numbers(rank[tokens])], pa.binary()), pa.array([np.cumsum(np.concatenate(sizes))], pa.list_(pa.int64()))],
            ["chunk", "doc_ids", "learn", "words", "tokens", "ends"])

    for batch in batches:
        flag = batch.column("learn").to_numpy(zero_copy_only=False)
        for lo, hi, b, offsets in tv.text_chunks(batch.column("text")):
            wh, first = tv.word_hashes(b, offsets, tv.SPACED, True)
            wh = np.maximum(wh >> U(16), U(2))
            # every row ends with the end token
            full = np.insert(wh, first[1:], END)
            ids.append(batch.column("doc_id").slice(lo, hi - lo))
            learn.append(flag[lo:hi])
            hashes.append(full)
            sizes.append(np.diff(first) + 1)
            held += len(b) + 8 * (hi - lo)
            if held >= CHUNK_BYTES:
                yield out()
                ids, learn, hashes, sizes, held = [], [], [], [], 0
    if ids:
        yield out()


def chunks_of(docs: DataFrame) -> DataFrame:
    """doc_id, text, learn -> rows of packed chunks."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "learn").mapInArrow(
        _pack, f"chunk string, doc_ids array<{kind}>, learn array<boolean>, words binary, tokens binary, ends array<long>")


class Chunk:
    """A chunk's words, tokens, contexts and which tokens are learnt from."""

    def __init__(self, row: dict):
        by_count = unpack48(row["words"])
        order = np.argsort(by_count)
        self.words = by_count[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.ends = np.asarray(row["ends"], np.int64)
        self.tokens = place[unpack_numbers(row["tokens"], int(self.ends[-1]))]
        self.sizes = np.diff(np.r_[0, self.ends])
        self.learn = np.asarray(row["learn"], bool)
        # with the begin marker in front, words keep their order
        self.ids = np.r_[BEGIN, self.words]
        w = self.tokens + 1
        self.context = np.r_[0, w[:-1]]
        self.context[np.r_[0, self.ends[:-1]]] = 0
        self.word = w
        self.learnt = np.repeat(self.learn, self.sizes)

    def word_counts(self) -> np.ndarray:
        """Training counts of ``ids``; that of the begin marker is the number of texts."""
        c = np.bincount(self.word[self.learnt], minlength=len(self.ids))
        c[0] = int(self.learn.sum())
        return c

    def bigrams(self, shards: int, hot_ids: np.ndarray, hot_parts: np.ndarray):
        """Distinct bigrams in the order in which shards get them: shard,
        context and word numbers, training counts, and each token's bigram."""
        n = len(self.ids)
        code, inverse = np.unique(self.context * n + self.word, return_inverse=True)
        ctx, word = code // n, code % n
        counts = np.bincount(inverse[self.learnt], minlength=len(code))
        h = self.ids[ctx]
        shard = shard_of(h, shards)
        if len(hot_ids):
            at = np.minimum(np.searchsorted(hot_ids, h), len(hot_ids) - 1)
            is_hot = hot_ids[at] == h
            part = self.ids[word[is_hot]] % hot_parts[at[is_hot]].astype(U)
            shard[is_hot] = shard_of(tv.mix(h[is_hot] * U(0x9E3779B97F4A7C15) + part + U(1)) >> U(16), shards)
        order = np.argsort(shard, kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return shard[order], ctx[order], word[order], counts[order], back[inverse]


# ---- shards ----------------------------------------------------------------

ROW = ["kind", "shard", "chunk", "a", "b", "c"]
ROW_SCHEMA = "kind string, shard long, chunk string, a binary, b binary, c binary"


def _rows(rows) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 6
    types = [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ROW)


def _word_queries(shards: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row)
                counts = c.word_counts()
                yield _rows([("q", s, row["chunk"], pack48(c.ids[a:z]), pack_counts(counts[a:z]), None)
                             for s, a, z in _slices(shard_of(c.ids, shards))])
    return run


def _bigram_queries(shards: int, hot):
    def run(batches):
        ids, parts = hot.value
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row)
                shard, ctx, word, counts, _ = c.bigrams(shards, ids, parts)
                out = []
                for s, a, z in _slices(shard):
                    # the run lengths of equal contexts
                    cut = np.flatnonzero(np.r_[True, ctx[a + 1:z] != ctx[a:z - 1]])
                    runs = np.diff(np.r_[cut, z - a])
                    out.append(("q", s, row["chunk"], np.array([len(cut)], "<u8").tobytes() + pack48(c.ids[ctx[a:z][cut]]) + pack_counts(runs),
                                pack48(c.ids[word[a:z]]), pack_counts(counts[a:z])))
                yield _rows(out)
    return run


def _unpack_contexts(a: bytes) -> np.ndarray:
    """The context of each bigram from their number, ids and run lengths."""
    k = int(np.frombuffer(a, "<u8", 1)[0])
    return np.repeat(unpack48(a[8:8 + 6 * k]), unpack_counts(a[8 + 6 * k:], k))


def _count_bigrams(word_shards: int):
    """One shard: total counts, answered to every chunk in its own order, and
    what the shard tells about contexts and words."""
    def run(table: pa.Table) -> pa.Table:
        queries = table.to_pylist()
        words = [unpack48(q["b"]) for q in queries]
        sizes = [len(w) for w in words]
        counts = np.concatenate([unpack_counts(q["c"], n) for q, n in zip(queries, sizes)])
        ctx = np.concatenate([_unpack_contexts(q["a"]) for q in queries])
        words = np.concatenate(words)
        key = tv.mix(ctx * U(0xD6E8FEB86659FD93) + words)
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        total = np.bincount(inverse, weights=counts, minlength=len(first)).astype(np.int64)
        out, at = [], 0
        for q, n in zip(queries, sizes):
            out.append(("r", q["shard"], q["chunk"], None, pack_counts(total[inverse[at:at + n]]), None))
            at += n
        seen = total > 0
        t, ctx, words = total[seen], ctx[first[seen]], words[first[seen]]
        ids, *n123 = _sums(ctx, *((t == 1).astype(np.int64), (t == 2).astype(np.int64), (t >= 3).astype(np.int64)))
        for s, a, z in _slices(shard_of(ids, word_shards)):
            out.append(("c", s, None, pack48(ids[a:z]), pack_counts(np.concatenate([x[a:z] for x in n123])), None))
        ids, n_ctx = _sums(words, np.ones(len(words), np.int64))
        for s, a, z in _slices(shard_of(ids, word_shards)):
            out.append(("a", s, None, pack48(ids[a:z]), pack_counts(n_ctx[a:z]), None))
        out.append(("n", -1, None, None, np.array([(t == k).sum() for k in (1, 2, 3, 4)], "<u8").tobytes(), None))
        return pa.Table.from_batches([_rows(out)])
    return run


def _sum_words(table: pa.Table) -> pa.Table:
    """One shard of the unigram model from the chunks' words: sorted ids and counts."""
    rows = table.to_pylist()
    ids = [unpack48(r["a"]) for r in rows]
    counts = [unpack_counts(r["b"], len(i)) for r, i in zip(rows, ids)]
    ids, counts = _sums(np.concatenate(ids), np.concatenate(counts))
    return pa.Table.from_batches([_rows([("m", rows[0]["shard"], None, pack48(ids), pack_counts(counts), None)])])


def _lookup(ids: np.ndarray, values: np.ndarray, q: np.ndarray) -> np.ndarray:
    """values of q in sorted ids; 0 where absent."""
    if len(ids) == 0:
        return np.zeros(len(q), np.int64)
    at = np.minimum(np.searchsorted(ids, q), len(ids) - 1)
    return np.where(ids[at] == q, values[at], 0)


def _answer_words(table: pa.Table) -> pa.Table:
    """One shard: what the chunks need to know about their words."""
    rows = table.to_pylist()
    by = {k: [r for r in rows if r["kind"] == k] for k in "mcaq"}
    empty = np.zeros(0, U)
    ids = unpack48(by["m"][0]["a"]) if by["m"] else empty
    counts = unpack_counts(by["m"][0]["b"], len(ids)) if by["m"] else np.zeros(0, np.int64)
    cids = [unpack48(r["a"]) for r in by["c"]]
    parts = [unpack_counts(r["b"], 3 * len(i)).reshape(3, -1) for r, i in zip(by["c"], cids)]
    cids, *n123 = _sums(np.concatenate(cids), *np.concatenate(parts, axis=1)) if cids else (empty, *[np.zeros(0, np.int64)] * 3)
    aids = [unpack48(r["a"]) for r in by["a"]]
    n_ctx = [unpack_counts(r["b"], len(i)) for r, i in zip(by["a"], aids)]
    aids, n_ctx = _sums(np.concatenate(aids), np.concatenate(n_ctx)) if aids else (empty, np.zeros(0, np.int64))
    out = []
    for q in by["q"]:
        want = unpack48(q["a"])
        cols = [_lookup(ids, counts, want), _lookup(aids, n_ctx, want), *(_lookup(cids, n, want) for n in n123)]
        out.append(("w", q["shard"], q["chunk"], None, pack_counts(np.concatenate(cols)), np.array([len(want)], "<u8").tobytes()))
    low = [(n_ctx == k).sum() for k in (1, 2, 3, 4)] + [(n_ctx >= 3).sum(), n_ctx.sum()]
    out.append(("l", -1, None, None, np.array(low, "<u8").tobytes(), None))
    return pa.Table.from_batches([_rows(out)])


# ---- scoring -----------------------------------------------------------------

def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts for counts 1, 2 and 3 or more, each between 0 and its count."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    d = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(x, 0.0), float(k)) for k, x in enumerate(d, 1))


def _mapped(folder: str, name: str, a: np.ndarray) -> np.ndarray:
    """The array again, mapped from a file."""
    if len(a) == 0:
        return a
    path = os.path.join(folder, name)
    a.tofile(path)
    return np.memmap(path, a.dtype, "r")


def _score(constants, hot, bigram_shards: int):
    def run(table: pa.Table) -> pa.Table:
        k = constants
        rows = table.select([c for c in table.column_names if c != "doc_ids"]).to_pylist()
        at = next(i for i, r in enumerate(rows) if r["kind"] == "d")
        doc_ids = table.column("doc_ids").slice(at, 1).combine_chunks().flatten()
        c = Chunk(rows[at])
        # the slices of the word and bigram arrays, in order of their shards
        words = []
        for r in sorted((r for r in rows if r["kind"] == "w"), key=lambda r: r["shard"]):
            n = int(np.frombuffer(r["c"], "<u8")[0])
            words.append(unpack_counts(r["b"], 5 * n).reshape(5, n))
        count, n_ctx, m1, m2, m3 = np.concatenate(words, axis=1)
        shard, ctx, word, _, token = c.bigrams(bigram_shards, *hot.value)
        sizes = {s: z - a for s, a, z in _slices(shard)}
        pairs = sorted((r for r in rows if r["kind"] == "r"), key=lambda r: r["shard"])
        total = np.concatenate([unpack_counts(r["b"], sizes[r["shard"]]) for r in pairs])
        d, dl = np.array([0.0, *k["high"]]), np.array([0.0, *k["low"]])
        uniform = 1.0 / (k["types"] + 1)
        if k["pairs"]:
            low = (n_ctx - dl[np.minimum(n_ctx, 3)]) / k["pairs"] + k["rest"] * uniform
        else:
            low = np.full(len(c.ids), uniform)
        some = np.maximum(count, 1)
        rest = np.where(count > 0, (d[1] * m1 + d[2] * m2 + d[3] * m3) / some, 1.0)
        p = np.where(count[ctx] > 0, (total - d[np.minimum(total, 3)]) / some[ctx], 0.0) + rest[ctx] * low[word]
        base = np.log10((count + 1) / (k["tokens"] + k["types"] + 1.0))
        starts = np.r_[0, c.ends[:-1]]
        with tempfile.TemporaryDirectory() as folder:
            logp, base, known = (_mapped(folder, n, x) for n, x in (("pairs", np.log10(p)), ("base", base), ("known", (count > 0).astype(np.int64))))
            score = np.add.reduceat(logp[token], starts)
            base_score = np.add.reduceat(base[c.word], starts)
            n_known = np.add.reduceat(known[c.word], starts)
            del logp, base, known
        return pa.table([doc_ids, pa.array(~c.learn), pa.array(c.sizes), pa.array(n_known),
                         pa.array(np.full(len(starts), k["tokens"])), pa.array(base_score), pa.array(score)],
                        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score(docs: DataFrame, held_out=None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every row; rows for which ``held_out`` holds are not learnt from."""
    spark = docs.sparkSession
    if held_out is None:
        held_out = id_crc() % 7 == 2
    kind = docs.schema["doc_id"].dataType.simpleString()
    chunks = stored(chunks_of(docs.select("doc_id", "text", (~held_out).alias("learn"))), "lm-chunks")
    shards = max(1, chunks.count())  # follows the corpus: a shard holds about what a chunk holds
    packed = chunks.select("chunk", "learn", "words", "tokens", "ends")

    queries = packed.mapInArrow(_word_queries(shards), ROW_SCHEMA)
    model = stored(queries.groupBy("shard").applyInArrow(_sum_words, ROW_SCHEMA), "lm-words")
    stats = model.mapInArrow(_word_stats, "tokens long, types long, hot_ids array<long>, hot_counts array<long>")
    tokens, types = (int(x or 0) for x in stats.agg(F.sum("tokens"), F.sum("types")).first())
    # at most HOT_SHARE words (and the begin marker) hold more than such a share of the tokens
    hot = (stats.select(F.explode(F.arrays_zip("hot_ids", "hot_counts")).alias("x")).select("x.*")
           .filter(F.col("hot_counts") * HOT_SHARE > tokens).orderBy("hot_ids").collect())
    hot_ids = np.array([r.hot_ids for r in hot], np.int64).astype(U)
    hot_parts = np.array([-(-r.hot_counts * HOT_SHARE // max(tokens, 1)) for r in hot], np.int64)
    sent = spark.sparkContext.broadcast((hot_ids, hot_parts))

    pairs = packed.mapInArrow(_bigram_queries(shards, sent), ROW_SCHEMA)
    counted = stored(pairs.groupBy("shard").applyInArrow(_count_bigrams(shards), ROW_SCHEMA), "lm-bigrams")
    release(spark)
    told = counted.filter(F.col("kind").isin("c", "a"))
    asked = queries.withColumn("b", F.lit(None).cast("binary"))
    answers = stored(model.union(told).union(asked).groupBy("shard").applyInArrow(_answer_words, ROW_SCHEMA), "lm-answers")
    release(spark)

    high, low = _totals(counted, "n", 4), _totals(answers, "l", 6)
    dl = discounts(*low[:4])
    constants = {"tokens": tokens, "types": types, "high": discounts(*high), "low": dl, "pairs": low[5],
                 "rest": (dl[0] * low[0] + dl[1] * low[1] + dl[2] * low[4]) / low[5] if low[5] else 1.0}
    got = counted.filter("kind = 'r'").union(answers.filter("kind = 'w'"))
    docs_part = chunks.withColumn("kind", F.lit("d"))
    both = docs_part.unionByName(got, allowMissingColumns=True)
    out = both.groupBy("chunk").applyInArrow(
        _score(constants, sent, shards),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out


def _word_stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens, types and the commonest contexts of each shard."""
    for batch in batches:
        for r in batch.to_pylist():
            ids = unpack48(r["a"])
            counts = unpack_counts(r["b"], len(ids))
            word = ids != BEGIN
            top = np.argsort(-counts, kind="stable")[:HOT_SHARE + 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(counts[word].sum())]), pa.array([int((counts[word] > 0).sum())]),
                 pa.array([ids[top].astype(np.int64)], pa.list_(pa.int64())), pa.array([counts[top]], pa.list_(pa.int64()))],
                ["tokens", "types", "hot_ids", "hot_counts"])


def _totals(rows: DataFrame, kind: str, n: int) -> list[int]:
    """Sums of the small count vectors that each shard left."""
    def add(batches):
        total = np.zeros(n, np.int64)
        for batch in batches:
            for b in batch.column("b").to_pylist():
                total += np.frombuffer(b, "<u8").astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], ["v"])
    v = rows.filter(F.col("kind") == kind).select("b").mapInArrow(add, "v array<long>")
    got = v.agg(*[F.sum(F.get("v", F.lit(i))) for i in range(n)]).first()
    return [int(x or 0) for x in got]

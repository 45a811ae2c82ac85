"""Language identification by language-bitmask n-gram filters.

Byte 4-grams of the letters (words joined by one space, two at either end) are
counted by language in Spark over all learning rows.  An n-gram belongs to a
language if it is used there at least ``SHARE`` times as often, by relative
frequency, as in the language that uses it most.  One Bloom filter for each
language is kept bit-sliced: an array of masks in which bit l of a cell is the
cell of filter l, so ANDing an n-gram's cells returns all languages containing
it at once.  A text's score for a language is the number of its n-grams
reported for it, corrected for the filter's false-positive rate.

No n-gram is left out for being rare: a language with two short learning texts
keeps all of theirs.  The array is sized from the largest language's number of
kept n-grams, ``CELLS_PER_GRAM`` entries each (a false-positive rate of some five
per cent at most), from ``MIN_CELLS`` to ``MAX_CELLS`` entries; at that bound, 64 MB,
the correction for false positives takes over.  Languages beyond 63 take further
arrays.

Defined results: null text or text without a letter: ``und``, score 0; no
learning rows: ``und`` throughout; ties go to the language first by name; a
text whose n-grams are all unknown gets the commonest language, score 0;
repeated rows count as often as they occur; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

CELLS_PER_GRAM = 8
MIN_CELLS, MAX_CELLS = 1 << 16, 1 << 23
HASHES = 2
SHARE = 0.25
_FLUSH = 2_000_000

_letters = np.zeros(256, bool)
_letters[0x41:0x5B] = _letters[0x61:0x7B] = True
_ascii_letters = _letters.copy()
_letters[0x80:] = True


def grams(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """4-grams of the letters as uint32, and the row of each."""
    starts, ends, first = tv.word_spans(b, offsets, _letters)
    n_rows, length = len(offsets) - 1, ends - starts
    row = np.repeat(np.arange(n_rows), np.diff(first))
    used = np.diff(first) > 0
    # a row is two spaces, its words each with a space after it, and one more space
    place = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(length + 1, out=place[1:])
    bounds = np.zeros(n_rows + 1, np.int64)
    np.cumsum(np.where(used, np.diff(place[first]) + 3, 0), out=bounds[1:])
    text = np.full(int(bounds[-1]), 0x20, np.uint32)
    if len(text) < 4:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    at = bounds[row] + 2 + place[:-1] - place[first[row]]
    run = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    text[np.repeat(at, length) + run] = tv.FOLD[b[_letters[b]]]
    g = (text[:-3] << 24) | (text[1:-2] << 16) | (text[2:-1] << 8) | text[3:]
    rows = np.repeat(np.arange(n_rows), np.diff(bounds))
    inside = rows[:-3] == rows[3:]
    return g[inside], rows[:-3][inside]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names: dict[str, int] = {}
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged():
        keys = np.concatenate([k for k, _ in held])
        counts = np.concatenate([c for _, c in held])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        return keys[new], np.add.reduceat(counts, new)

    def rows():
        keys, counts = merged()
        by_id = np.array(list(names), object)
        return pa.RecordBatch.from_arrays([pa.array(by_id[(keys >> np.uint64(32)).astype(np.int64)], pa.string()),
                                           pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(counts)], ["lang", "gram", "n"])

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        ids = np.array([names.setdefault(x, len(names)) for x in langs], np.uint64)
        for lo, hi, b, offsets in tv.text_chunks(batch.column("text")):
            g, row = grams(b, offsets)
            if len(g):
                keys = np.sort((ids[lo:hi][row] << np.uint64(32)) | g.astype(np.uint64))
                new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                held.append((keys[new], np.diff(np.r_[new, len(keys)]).astype(np.int64)))
        if sum(len(k) for k, _ in held) > _FLUSH:
            held = [merged()]
            if len(held[0][0]) > _FLUSH:
                yield rows()
                held = []
    if held:
        yield rows()


def cells_of(grams_: np.ndarray, cells: int, hashes: int) -> list[np.ndarray]:
    h = tv.mix(grams_.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(k) * step) & np.uint64(cells - 1)).astype(np.int64) for k in range(hashes)]


def _place(cells: int, hashes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, lang = batch.column("gram").to_numpy(), batch.column("lang_no").to_numpy()
            at = np.concatenate(cells_of(g, cells, hashes))
            part = np.tile(lang // 63, hashes)
            bit = np.tile(np.int64(1) << (lang % 63), hashes)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(part.astype(np.int32)), pa.array(bit)], ["cell", "part", "mask"])
    return run


class Filters:
    """Bit-sliced filters: ``masks[part][cell]`` has a bit for each of 63 languages."""

    def __init__(self, langs: list[str], masks: list[np.ndarray], commonest: str, hashes: int):
        self.langs, self.masks, self.commonest, self.hashes = langs, masks, commonest, hashes
        fill = [float(((masks[i // 63] >> np.int64(i % 63)) & 1).mean()) for i in range(len(langs))]
        self.false_rate = np.array([f ** hashes for f in fill])

    def scores(self, g: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """Corrected share of each row's n-grams in each language."""
        total = np.bincount(row, minlength=n).astype(float)
        out = np.zeros((n, len(self.langs)))
        at = cells_of(g, len(self.masks[0]), self.hashes)
        for part, masks in enumerate(self.masks):
            m = masks[at[0]]
            for a in at[1:]:
                m &= masks[a]
            for i in range(part * 63, min(len(self.langs), part * 63 + 63)):
                hits = np.bincount(row, weights=((m >> np.int64(i % 63)) & 1).astype(float), minlength=n)
                fp = min(self.false_rate[i], 0.999)
                out[:, i] = np.maximum(0, hits - fp * total) / (1 - fp)
        return out / np.maximum(total, 1)[:, None]


def learn(docs: DataFrame, cells: int | None = None, hashes: int = HASHES, share: float = SHARE) -> Filters | None:
    """Filters from the text and non-null lang of all rows of ``docs``; ``cells``
    (a power of two) is taken from the number of kept n-grams by default."""
    spark = docs.sparkSession
    counts = (docs.select("text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
              .mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    from .base import stored
    counts = stored(counts, "lang-grams")
    totals = {r.lang: r.total for r in counts.groupBy("lang").agg(F.sum("n").alias("total")).collect()}  # a row per language
    if not totals:
        return None
    langs = sorted(totals)
    table = spark.createDataFrame([(x, i, float(totals[x])) for i, x in enumerate(langs)], "lang string, lang_no long, total double")
    rate = counts.join(F.broadcast(table), "lang").withColumn("rate", F.col("n") / F.col("total"))
    most = rate.groupBy("gram").agg(F.max("rate").alias("most"))
    kept = rate.join(most, "gram").filter(F.col("rate") >= share * F.col("most")).select("gram", "lang_no")
    if cells is None:
        kept = stored(kept, "lang-kept")
        largest = kept.groupBy("lang_no").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1  # of a row per language
        cells = min(max(1 << (CELLS_PER_GRAM * largest - 1).bit_length(), MIN_CELLS), MAX_CELLS)
    sliced = (kept.mapInArrow(_place(cells, hashes), "cell long, part int, mask long")
              .groupBy("part", "cell").agg(F.bit_or("mask").alias("mask"))).toArrow()  # at most `cells` rows a part
    masks = [np.zeros(cells, np.int64) for _ in range((len(langs) + 62) // 63)]
    part, cell, mask = (sliced.column(c).to_numpy() for c in ("part", "cell", "mask"))
    for k, m in enumerate(masks):
        m[cell[part == k]] = mask[part == k]
    return Filters(langs, masks, min(langs, key=lambda x: (-totals[x], x)), hashes)


def _predict(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            preds, scores = [], []
            for lo, hi, b, offsets in tv.text_chunks(batch.column("text")):
                n = hi - lo
                plain = np.concatenate([[0], np.cumsum(_ascii_letters[b])])[offsets]
                letter = np.diff(plain) > 0
                for r in np.flatnonzero(~letter):
                    letter[r] = any(c.isalpha() for c in b[offsets[r]:offsets[r + 1]].tobytes().decode("utf-8", "replace"))
                if model is None:
                    preds += ["und"] * n
                    scores += [0.0] * n
                    continue
                g, row = grams(b, offsets)
                s = model.scores(g, row, n)
                best, top, total = s.argmax(axis=1), s.max(axis=1), s.sum(axis=1)
                for r in range(n):
                    preds.append("und" if not letter[r] else model.langs[best[r]] if top[r] > 0 else model.commonest)
                    scores.append(float(top[r] / total[r]) if letter[r] and top[r] > 0 else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, model: Filters | None) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select("doc_id", "text")
    return d.mapInArrow(_predict(sent), f"doc_id {d.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")

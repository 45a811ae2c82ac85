"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

score(x) = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), with the
pairwise part in linear time:
1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2].

The inputs are word counts hashed into ``WORD_CELLS`` cells (log-scaled, unit
length), statistics of the text's structure, and its metadata (length in
bytes and in lines); never labels, lang, source or ids.  It is trained on a
bounded sample of the labelled rows, ``MAX_TRAINING_ROWS`` of them (a
parameter; lowest hashes of their ids first), and scores every whole text in
the tasks that read it.

Defined results: null or empty texts have empty inputs and still get a score;
without usable labels every score is 0.5, with one class only its rate,
smoothed; a document labelled more than once counts by its mean label (0.5: not
used); repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

WORD_CELLS = 4096
RANK = 8
MAX_TRAINING_ROWS = 8192
THRESHOLD = 0.7

#: classes of bytes that the structure statistics count
_CLASS = np.zeros(256, np.int64)
_CLASS[ord("a"):ord("z") + 1] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[0x80:] = 4
_CLASS[[ord(c) for c in ".,;:'\"()-"]] = 5
_CLASS[[ord(c) for c in "!?"]] = 6
_CLASS[[ord(c) for c in "#*$%&|<>{}[]\\^~=+_@/"]] = 7
_CLASS[ord("\n")] = 8
_N_CLASS = 9
STATS = _N_CLASS + 5


def features(b: np.ndarray, offsets: np.ndarray, cells: int = WORD_CELLS):
    """(row, column, value) of the non-zero inputs of each row."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    rows = np.repeat(np.arange(n), size)
    by_class = np.bincount(rows * _N_CLASS + _CLASS[b], minlength=n * _N_CLASS).reshape(n, _N_CLASS)
    wh, first = tv.word_hashes(b, offsets, tv.SPACED, True)
    n_words = np.diff(first)
    word_row = np.repeat(np.arange(n), n_words)
    key, count = np.unique(word_row * cells + (wh >> np.uint64(40)).astype(np.int64) % cells, return_counts=True)
    r, c, v = key // cells, key % cells, np.log1p(count)
    v = v / np.sqrt(np.bincount(r, v * v, minlength=n))[r]
    same = np.zeros(n)
    if len(wh) > 1:
        again = (wh[1:] == wh[:-1]) & (word_row[1:] == word_row[:-1])
        same = np.bincount(word_row[1:][again], minlength=n)
    words, chars = np.maximum(n_words, 1), np.maximum(size, 1)
    stats = np.column_stack([
        by_class / chars[:, None],
        np.log1p(size) / 10, np.log1p(by_class[:, 8]) / 5, np.minimum(size / words, 30) / 10,
        same / words, np.bincount(r, minlength=n) / words])
    sr, sc = np.nonzero(stats)
    return np.r_[r, sr], np.r_[c, cells + sc], np.r_[v, stats[sr, sc]]


class Machine:
    """Weights of a trained factorisation machine."""

    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray):
        self.w0, self.w, self.v = w0, w, v

    def scores(self, row: np.ndarray, col: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        z = self.w0 + np.bincount(row, self.w[col] * value, minlength=n)
        for f in range(self.v.shape[1]):
            vx = self.v[col, f] * value
            z += 0.5 * (np.bincount(row, vx, minlength=n) ** 2 - np.bincount(row, vx * vx, minlength=n))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, rank: int = RANK, steps: int = 800, rate: float = 0.02,
        l2: float = 1e-4, batch: int = 512, seed: int = 7) -> Machine:
    """Adam on the logistic loss, from a dense sample of rows."""
    d = x.shape[1]
    rng = np.random.default_rng(seed)
    p = {"w0": np.zeros(1, np.float32), "w": np.zeros(d, np.float32), "v": rng.normal(0, 0.01, (d, rank)).astype(np.float32)}
    m = {k: np.zeros_like(a) for k, a in p.items()}
    s = {k: np.zeros_like(a) for k, a in p.items()}
    step = 0
    while step < steps:
        for at in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            xb = x[at]
            x2, q = xb * xb, xb @ p["v"]
            z = p["w0"] + xb @ p["w"] + 0.5 * (q * q - x2 @ (p["v"] * p["v"])).sum(axis=1)
            e = ((1 / (1 + np.exp(-np.clip(z, -30, 30)))) - y[at]) / len(at)
            xe = xb.T * e
            g = {"w0": np.array([e.sum()], np.float32), "w": xe.sum(axis=1) + l2 * p["w"],
                 "v": xe @ q - p["v"] * (x2.T @ e)[:, None] + l2 * p["v"]}
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.999 * s[k] + 0.001 * g[k] * g[k]
                p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
    return Machine(float(p["w0"][0]), p["w"].astype(float), p["v"].astype(float))


def _collect_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        y = batch.column("y")
        for lo, hi, b, offsets in tv.text_chunks(batch.column("text")):
            row, col, value = features(b, offsets)
            order = np.argsort(row, kind="stable")
            cut = np.searchsorted(row[order], np.arange(hi - lo + 1))
            col, value = col[order].astype(np.int32), value[order].astype(np.float32)
            lists = [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(a)) for a in (col, value)]
            yield pa.RecordBatch.from_arrays([y.slice(lo, hi - lo), *lists], ["y", "cols", "vals"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Machine:
    """Fit on at most ``max_rows`` labelled documents of ``docs``, those whose ids
    hash lowest.  Rows that share an id count once, by the text whose hash is
    lowest, so the bound holds for rows as well."""
    seen = (labels.select("doc_id", F.col("quality").cast("double").alias("q")).filter("doc_id IS NOT NULL AND q IS NOT NULL")
            .groupBy("doc_id").agg(F.avg("q").alias("q")).filter("q <> 0.5").select("doc_id", (F.col("q") > 0.5).cast("float").alias("y")))
    known = docs.select("doc_id").join(seen, "doc_id").distinct()
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)  # the documented bound
    rows = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id").agg(F.first("y").alias("y"), F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")).select("y", "text")
            .mapInArrow(_collect_features, "y float, cols array<int>, vals array<float>").toArrow())
    width = WORD_CELLS + STATS
    y = rows.column("y").to_numpy()
    if len(y) == 0 or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        return Machine(float(np.log(rate / (1 - rate))), np.zeros(width), np.zeros((width, RANK)))
    x = np.zeros((len(y), width), np.float32)
    at = np.repeat(np.arange(len(y)), rows.column("cols").combine_chunks().value_lengths().to_numpy())
    x[at, rows.column("cols").combine_chunks().flatten().to_numpy()] = rows.column("vals").combine_chunks().flatten().to_numpy()
    # rows are taken in an order that does not depend on the partitions they come from
    order = np.lexsort((x @ np.random.default_rng(1).normal(size=width).astype(np.float32), y))
    return fit(x[order], y[order])


def _score(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = sent.value
        for batch in batches:
            out = []
            for lo, hi, b, offsets in tv.text_chunks(batch.column("text")):
                out.append(machine.scores(*features(b, offsets), hi - lo))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())],
                                             ["doc_id", "score"])
    return run


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score, predicted of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    d = docs.select("doc_id", "text")
    kind = d.schema["doc_id"].dataType.simpleString()
    return (d.mapInArrow(_score(sent), f"doc_id {kind}, score double")
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))

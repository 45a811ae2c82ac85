"""Fill-in-middle transformation over a piece table.

A document is never copied while it is rearranged: its text and the sentinels
are immutable buffers, and the document is a list of descriptors (buffer,
start, end).  Cutting splits descriptors, the form permutes them and puts
sentinel descriptors between, and hashes and output texts are streamed from the
descriptors.  Restoring makes descriptors over the output, drops the sentinels
and applies the inverse permutation.

Units are the matches of ``[A-Za-z]+|[^A-Za-z]`` over code points.  The four
draws come from sha256 of ``1:`` and the id, so a rerun cuts alike.

Defined results: null counts as the empty text; empty texts and texts that hold
a sentinel stay plain; a null id draws like the empty id; repeated rows get
equal results; very long texts are cut whole; columns named like a result are
replaced, other columns stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textvec as tv

#: fixed values of the task
SENTINELS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
#: what stands in the output: sentinels by name, parts 0 prefix, 1 middle, 2 suffix
FORMS = {"psm": ("P", 0, "S", 2, "M", 1), "spm": ("S", 2, "P", 0, "M", 1)}
PLAIN_FROM, SPM_BELOW = 90, 20

_letter = np.zeros(256, bool)
_letter[0x41:0x5B] = _letter[0x61:0x7B] = True


class Piece(NamedTuple):
    buffer: str
    start: int
    end: int


class PieceTable:
    """A document as descriptors over immutable buffers."""

    def __init__(self, buffers: dict[str, memoryview | bytes], pieces: list[Piece]):
        self.buffers, self.pieces = buffers, pieces

    @classmethod
    def of(cls, text: memoryview | bytes) -> "PieceTable":
        return cls({"text": text, **SENTINELS}, [Piece("text", 0, len(text))])

    def cut(self, *places: int) -> list["PieceTable"]:
        """The parts between rising places, counted in bytes of this document."""
        parts, now, at, todo = [], [], 0, list(self.pieces)
        for place in [*places, None]:
            while todo:
                p = todo[0]
                size = p.end - p.start
                if place is None or at + size <= place:
                    now.append(todo.pop(0))
                    at += size
                    continue
                if at < place:  # the descriptor is split, its text is not touched
                    mid = p.start + place - at
                    now.append(Piece(p.buffer, p.start, mid))
                    todo[0] = Piece(p.buffer, mid, p.end)
                    at = place
                break
            parts.append(PieceTable(self.buffers, now))
            now = []
        return parts

    def views(self) -> Iterator[memoryview]:
        for p in self.pieces:
            yield memoryview(self.buffers[p.buffer])[p.start:p.end]

    def sha256(self) -> str:
        h = hashlib.sha256()
        for v in self.views():
            h.update(v)
        return h.hexdigest()

    def bytes(self) -> bytes:
        return b"".join(self.views())


def arrange(parts: list[PieceTable], form: str) -> PieceTable:
    """Prefix, middle and suffix in the order of the form, with sentinels."""
    out: list[Piece] = []
    for x in FORMS[form]:
        out += [Piece(x, 0, len(SENTINELS[x]))] if isinstance(x, str) else parts[x].pieces
    return PieceTable(parts[0].buffers, out)


def restored(output: memoryview | bytes, form: str) -> PieceTable:
    """Descriptors of the original text over an output.  A sentinel cannot
    arise across a border, as none of them ends with its own first byte."""
    whole = PieceTable.of(output)
    if form == "plain":
        return whole
    raw, places, at = bytes(output), [], 0
    for x in FORMS[form]:
        if isinstance(x, str):
            at = raw.index(SENTINELS[x], at)
            places += [at, at + len(SENTINELS[x])]
            at = places[-1]
    _, *between = whole.cut(*places)
    texts = between[1::2]
    order = [x for x in FORMS[form] if isinstance(x, int)]
    inverse = [order.index(k) for k in range(len(order))]
    return PieceTable(whole.buffers, [p for k in inverse for p in texts[k].pieces])


def units(b: np.ndarray, offsets: np.ndarray):
    """Byte starts of the units, and the index of each row's first one."""
    letter = _letter[b]
    inner = np.zeros(len(b), bool)
    inner[1:] = letter[1:] & letter[:-1]
    inner[offsets[:-1][offsets[:-1] < len(b)]] = False
    starts = np.flatnonzero(~inner & ((b & 0xC0) != 0x80))
    return starts, np.searchsorted(starts, offsets)


def draws(doc_id) -> list[int]:
    digest = hashlib.sha256(b"1:" + (b"" if doc_id is None else str(doc_id).encode())).hexdigest()
    return [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]


PIECES = "array<struct<buffer: string, start: long, end: long>>"
_piece_type = pa.list_(pa.struct([("buffer", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
RESULTS = {"n": ("long", pa.int64()), "form": ("string", pa.string()), "prefix_chars": ("long", pa.int64()),
           "middle_chars": ("long", pa.int64()), "pieces": (PIECES, _piece_type),
           "output": ("string", pa.string()), "output_sha256": ("string", pa.string())}


def _string_array(raw: list[bytes]) -> pa.Array:
    return pa.array(raw, pa.binary()).view(pa.string())


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for lo, hi, b, offsets in tv.text_chunks(batch.column("text")):
            starts, first = units(b, offsets)
            points = np.zeros(len(b) + 1, np.int64)
            np.cumsum((b & 0xC0) != 0x80, out=points[1:])
            raw = b.tobytes()
            cols: dict[str, list] = {k: [] for k in RESULTS}
            for r in range(hi - lo):
                a, z = int(offsets[r]), int(offsets[r + 1])
                f, n = int(first[r]), int(first[r + 1] - first[r])
                h1, h2, h3, h4 = draws(ids[lo + r])
                table = PieceTable.of(memoryview(raw)[a:z])
                if a == z or h3 % 100 >= PLAIN_FROM or any(raw.find(s, a, z) >= 0 for s in SENTINELS.values()):
                    form, chars = "plain", (None, None)
                else:
                    form = "spm" if h4 % 100 < SPM_BELOW else "psm"
                    cuts = [int(starts[f + k]) if k < n else z for k in sorted((h1 % (n + 1), h2 % (n + 1)))]
                    chars = (int(points[cuts[0]] - points[a]), int(points[cuts[1]] - points[cuts[0]]))
                    table = arrange(table.cut(*(c - a for c in cuts)), form)
                for k, x in zip(RESULTS, (n, form, *chars, [p._asdict() for p in table.pieces if p.end > p.start], table.bytes(), table.sha256())):
                    cols[k].append(x)
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *(_string_array(cols[k]) if k == "output" else pa.array(cols[k], t) for k, (_, t) in RESULTS.items())],
                [*part.schema.names, *RESULTS])


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        forms = batch.column("form").to_pylist()
        for lo, hi, b, offsets in tv.text_chunks(batch.column("output")):
            raw, texts, hashes = b.tobytes(), [], []
            for r in range(hi - lo):
                table = restored(memoryview(raw)[int(offsets[r]):int(offsets[r + 1])], forms[lo + r])
                texts.append(table.bytes())
                hashes.append(table.sha256())
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([*part.columns, _string_array(texts), pa.array(hashes, pa.string())],
                                             [*part.schema.names, "restored", "restored_sha256"])


def _with(df: DataFrame, new: dict[str, str]) -> tuple[DataFrame, str]:
    d = df.select(*[f"`{c}`" for c in df.columns if c.lower() not in new])
    return d, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema), *(f"`{k}` {t}" for k, t in new.items())])


def transform(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with n (units), form, prefix_chars,
    middle_chars, pieces (byte spans of ``text`` and the sentinels), output and
    output_sha256."""
    d, schema = _with(docs, {k: t for k, (t, _) in RESULTS.items()})
    return d.mapInArrow(_transform, schema)


def restore(df: DataFrame) -> DataFrame:
    """``df`` (output, form, ...) with the restored text and its sha256, from
    these two columns alone."""
    d, schema = _with(df, {"restored": "string", "restored_sha256": "string"})
    return d.mapInArrow(_restore, schema)

r"""Fuzzy search for short license notices.

Texts are normalised to lower-case words joined by one space.  A notice of m
characters may differ by k edits (``edits_allowed``).  It is cut into k + 1
pieces: by the pigeonhole principle a match with at most k edits holds at
least one piece unchanged, so exact searches for the pieces find every
candidate place.  The ``regex`` library's bounded-error matching then verifies
the small window around a candidate and reports its span and edits.
Words that tell licenses apart are protected: a version number or a name of
``NAMES`` that stands whole in a match must stand in the notice too, in the same
order, and no further part of a version may follow.  So another version or
license never matches, while a damaged word (``mt`` for ``mit``) counts as edits.
Overlapping findings keep the one with the fewest edits, then the longest.

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z are lower-cased.  Base
phrases are searched word by word in every place.

Defined results: null counts as the empty text; without words there are no
places, empty labels and score 0; repeated rows get equal results; very long
texts are searched whole; a notice may not span two documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import textvec as tv

#: phrases whose exact places are reported (fixed values of the task)
BASE_PHRASES = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))

#: short notices of well-known licenses, as normalised words (parameter)
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("lgpl-3", "gnu lesser general public license version 3"),
    ("agpl-3", "gnu affero general public license version 3"),
    ("mpl-2", "mozilla public license version 2 0"),
    ("bsd-3", "bsd 3 clause license"),
    ("bsd-2", "bsd 2 clause license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "released under the isc license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "cc0 1 0 universal public domain dedication"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    ("cc-by-nc-nd", "licensed under cc by nc nd 4 0"),
    ("cc-by", "creative commons attribution 4 0 international license"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("proprietary", "all rights reserved unauthorized copying of this file is strictly prohibited"),
)


#: words that name a license or a variant of one (parameter)
NAMES = frozenset(
    "mit apache gnu gpl lgpl agpl mpl mozilla bsd isc cc cc0 by sa nd nc lesser library affero attribution sharealike noncommercial "
    "noderivatives noderivs unlicense unencumbered proprietary eclipse epl artistic boost zlib wtfpl".split())


#: of these, parts that name something only in a row after ``cc``
PARTS = frozenset("by sa nd nc".split())


def protected(words: list[str], names=NAMES) -> list[str]:
    """The whole names and numbers among the words, in order."""
    out, chain = [], False
    for w in words:
        chain = w == "cc" or chain and w in PARTS
        if w.isdigit() or w in names and (chain or w not in PARTS):
            out.append(w)
    return out


def edits_allowed(notice: str) -> int:
    """Edits that a notice may differ by: none when it is short."""
    return 0 if len(notice) < 20 else 1 if len(notice) < 28 else 2 if len(notice) < 45 else 3


def pieces(notice: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece) of k + 1 consecutive pieces of about equal length."""
    cuts = [round(i * len(notice) / (k + 1)) for i in range(k + 2)]
    return [(a, notice[a:z]) for a, z in zip(cuts, cuts[1:])]


class Notices:
    def __init__(self, notices=NOTICES, names=NAMES):
        self.notices = [(label, text, edits_allowed(text)) for label, text in notices]
        self.names = names
        self.protected = [protected(text.split(" "), names) for _, text in notices]
        self.seeds: dict[bytes, list[tuple[int, int]]] = {}
        for i, (_, text, k) in enumerate(self.notices):
            for offset, piece in pieces(text, k):
                self.seeds.setdefault(piece.encode(), []).append((i, offset))
        self.patterns = [regex.compile(b"(?e)(?:%s){e<=%d}" % (regex.escape(t.encode()), k)) for _, t, k in self.notices]

    def agrees(self, text: bytes, start: int, end: int, i: int) -> bool:
        """Whether the whole protected words of a match are those of notice ``i``, in order."""
        while start < end and text[start:start + 1] == b" ":
            start += 1
        while end > start and text[end - 1:end] == b" ":
            end -= 1
        start = text.rfind(b" ", 0, start) + 1  # whole words
        end = text.find(b" ", end) if text.find(b" ", end) >= 0 else len(text)
        want, at = self.protected[i], 0
        for w in protected(text[start:end].decode("utf-8", "replace").split(" "), self.names):
            # a number may be several of the notice's that lost the space between them
            found = next((z for k in range(at, len(want)) for z in range(k + 1, len(want) + 1)
                          if "".join(want[k:z]) == w and (z == k + 1 or w.isdigit())), None)
            if found is None:
                return False
            at = found
        if not self.notices[i][1][-1].isdigit():
            return True
        after = text[end + 1:end + 9].decode("utf-8", "replace").split(" ")[0]
        return not after.isdigit() or after == "0" or len(after) > 2  # "2 1" is not "2"

    def find(self, text: bytes) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, edits) of the notices in normalised text that
        remain when overlaps are settled."""
        windows: dict[tuple[int, int], tuple[int, int]] = {}
        for seed, uses in self.seeds.items():
            at = text.find(seed)
            while at >= 0:
                for i, offset in uses:
                    k, n = self.notices[i][2], len(self.notices[i][1])
                    lo = max(0, at - offset - k)
                    windows[i, lo] = (lo, min(len(text), at - offset + n + 2 * k))
                at = text.find(seed, at + 1)
        found = []
        for (i, _), (lo, hi) in windows.items():
            m = self.patterns[i].search(text, lo, hi)
            if m and self.agrees(text, m.start(), m.end(), i):
                found.append((sum(m.fuzzy_counts), -(m.end() - m.start()), m.start(), i, m.end()))
        taken: list[tuple[int, int, int, int]] = []
        for edits, _, start, i, end in sorted(set(found)):
            if all(end <= a or start >= z for a, z, _, _ in taken):
                taken.append((start, end, i, edits))
        return sorted(taken)


def normalised(b: np.ndarray, offsets: np.ndarray):
    """Words joined by one space (rows end with one), row offsets in them,
    byte starts of the words and each row's first word."""
    starts, ends, first = tv.word_spans(b, offsets, tv.ALNUM)
    length = ends - starts
    new_starts = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(length + 1, out=new_starts[1:])
    out = np.full(int(new_starts[-1]), 0x20, np.uint8)
    within = np.ones(len(out), bool)
    within[new_starts[1:] - 1] = False
    out[within] = tv.FOLD[b[tv.ALNUM[b]]]
    return out.tobytes(), new_starts[first], new_starts[:-1], first


def _places(text: bytes, phrase: bytes) -> list[int]:
    """Byte starts of the phrase as whole words in text that ends with a space."""
    out, at = [], text.find(phrase)
    while at >= 0:
        if (at == 0 or text[at - 1] == 0x20) and text[at + len(phrase)] == 0x20:
            out.append(at)
        at = text.find(phrase, at + 1)
    return out


def _scan(notices, base):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Notices(notices)
        for batch in batches:
            rows = []
            for lo, hi, b, offsets in tv.text_chunks(batch.column("text")):
                whole, row_at, word_at, first = normalised(b, offsets)
                # rows with something to look at, found over the whole chunk at once
                marks = []
                for seed in {*search.seeds, *(p.encode() for _, p in base)}:
                    at = whole.find(seed)
                    while at >= 0:
                        row = int(np.searchsorted(row_at, at, side="right")) - 1
                        marks.append(row)
                        at = whole.find(seed, max(at + 1, int(row_at[row + 1]) - len(seed)) if row + 1 < len(row_at) else at + 1)
                marks = set(marks)
                for r in range(hi - lo):
                    n_words = int(first[r + 1] - first[r])
                    if r not in marks or not n_words:
                        rows.append((n_words, 0, None, None, "", "", 0.0, []))
                        continue
                    text, here = whole[row_at[r]:row_at[r + 1]], word_at[first[r]:first[r + 1]] - row_at[r]
                    places, labels, score = [], set(), 0.0
                    for label, phrase in base:
                        p = _places(text, phrase.encode())
                        if p:
                            labels.add(label)
                            places += p
                            score = 1.0
                    base_labels, spans = ",".join(sorted(labels)), []
                    for start, end, i, edits in search.find(text):
                        label, notice, _ = search.notices[i]
                        labels.add(label)
                        score = max(score, 1 - edits / len(notice))
                        a = int(np.searchsorted(here, start, side="right")) - 1
                        z = int(np.searchsorted(here, end, side="left"))
                        spans.append({"label": label, "start_word": max(a, 0), "end_word": z, "edits": edits})
                    at = np.searchsorted(here, [min(places), max(places)]).tolist() if places else [None, None]
                    rows.append((n_words, len(places), at[0], at[1], base_labels, ",".join(sorted(labels)), score, spans))
            cols = list(zip(*rows)) if rows else [[]] * 8
            span = pa.list_(pa.struct([("label", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("edits", pa.int64())]))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, types))],
                                             ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])
    return run


def scan_licenses(docs: DataFrame, notices=NOTICES, base=BASE_PHRASES) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score and the fuzzy spans (word ranges, edits)."""
    d = docs.select("doc_id", "text")
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(_scan(tuple(notices), tuple(base)), (
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<label: string, start_word: long, end_word: long, edits: long>>"))

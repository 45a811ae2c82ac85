"""Scoring steps redone word by word in plain Python, given the same trained
parameters; the license search redone without seeds."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tenurekit.llm import lang_id, quality_fm
from tenurekit.llm import textvec as tv
from tenurekit.llm.license_scan import NOTICES, Notices, protected

SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def texts(n, seed):
    rnd = random.Random(seed)
    parts = ["the", "Der", "é", "漢字", "x1", "!!", "#tag", "the", "\n", "  ", "a" * 40, "und", "Öl", "12.5", "\t", "(and)"]
    return ["", " ", "\n\n", "word"] + [" ".join(rnd.choice(parts) for _ in range(rnd.randint(1, 80))) for _ in range(n)]


# ---- op2 -----------------------------------------------------------------------

def plain_inputs(text):
    raw = text.encode()
    x = {}
    words = [w.translate(FOLD).decode("utf-8", "surrogatepass") for w in SPACED.findall(raw)]
    cells = Counter()
    for w in words:
        cells[(int(tv.hash_of_words([w])[0]) >> 40) % quality_fm.WORD_CELLS] += 1
    logs = {k: math.log1p(c) for k, c in cells.items()}
    norm = math.sqrt(sum(v * v for v in logs.values()))
    x.update({k: v / norm for k, v in logs.items()})
    kinds = Counter(int(quality_fm._CLASS[b]) for b in raw)
    n, w = max(len(raw), 1), max(len(words), 1)
    again = sum(a == b for a, b in zip(words, words[1:]))
    stats = [kinds[k] / n for k in range(9)] + [math.log1p(len(raw)) / 10, math.log1p(kinds[8]) / 5, min(len(raw) / w, 30) / 10, again / w, len(cells) / w]
    x.update({quality_fm.WORD_CELLS + k: v for k, v in enumerate(stats) if v})
    return x


def plain_score(m, x):
    items = sorted(x.items())
    z = m.w0 + sum(m.w[i] * v for i, v in items)
    for a in range(len(items)):
        for b in range(a + 1, len(items)):
            z += float(m.v[items[a][0]] @ m.v[items[b][0]]) * items[a][1] * items[b][1]
    return 1 / (1 + math.exp(-max(-30, min(30, z))))


def test_quality_scores_equal_all_pairs(spark):
    rng = np.random.default_rng(5)
    width = quality_fm.WORD_CELLS + quality_fm.STATS
    m = quality_fm.Machine(0.2, rng.normal(size=width), rng.normal(0, 0.3, (width, quality_fm.RANK)))
    rows = [(i, t) for i, t in enumerate(texts(60, 3))] + [(900, None)]
    got = {r.doc_id: r for r in quality_fm.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), m).collect()}
    for i, t in rows:
        want = plain_score(m, plain_inputs(t or ""))
        assert got[i].score == pytest.approx(want, abs=1e-9) and got[i].predicted == int(got[i].score >= 0.7)


# ---- op8 -----------------------------------------------------------------------

def plain_language(model, text):
    words = re.findall(rb"[a-z\x80-\xff]+", (text or "").encode().translate(FOLD))
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    s = b"  " + b"".join(w + b" " for w in words) + b" "
    grams = [int.from_bytes(s[i:i + 4], "big") for i in range(len(s) - 3)]
    cells = len(model.masks[0])
    score = []
    for i in range(len(model.langs)):
        hits = 0
        for g in grams:
            h = int(tv.mix(np.array([(g + 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0])
            places = [(h + k * ((h >> 32) | 1)) % 2**64 % cells for k in range(model.hashes)]
            hits += all(int(model.masks[i // 63][p]) >> (i % 63) & 1 for p in places)
        fp = min(model.false_rate[i], 0.999)
        score.append(max(0.0, hits - fp * len(grams)) / (1 - fp) / max(len(grams), 1))
    best = max(range(len(score)), key=lambda i: (score[i], -i))
    return (model.langs[best], score[best] / sum(score)) if score[best] > 0 else (model.commonest, 0.0)


@pytest.mark.parametrize("cells", [None, 1 << 10])
def test_language_scores_equal_plain_lookups(spark, cells):
    rnd = random.Random(4)
    vocab = {f"l{k}": ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzéöñ") for _ in range(rnd.randint(2, 7))) for _ in range(40)] for k in range(70)}
    rows = [(i, " ".join(rnd.choice(vocab[x]) for _ in range(12)), x) for i, x in enumerate(sorted(vocab) * 3)]
    model = lang_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3), cells=cells)
    assert len(model.langs) == 70 and len(model.masks) == 2  # languages beyond 63 take a further array
    new = [(i, " ".join(rnd.choice(vocab[rnd.choice(sorted(vocab))]) for _ in range(5))) for i in range(25)] + [(900, None), (901, ""), (902, "123"), (903, "漢字")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.identify(spark.createDataFrame(new, "doc_id long, text string"), model).collect()}
    for i, t in new:
        pred, score = plain_language(model, t)
        assert got[i][0] == pred and got[i][1] == pytest.approx(score, abs=1e-9)


# ---- op3 -----------------------------------------------------------------------

def test_seeds_lose_no_license(spark):
    """Every notice within its edits is found by the seeded search, as by the
    bounded-error pattern over the whole text."""
    rnd = random.Random(6)
    search = Notices()

    def damaged(notice, k):
        words, free = notice.split(" "), [i for i, w in enumerate(notice.split(" ")) if w not in protected(notice.split(" ")) and len(w) > 4]
        for _ in range(k):
            if free:
                i = rnd.choice(free)
                j = rnd.randrange(1, len(words[i]) - 1)
                words[i] = rnd.choice([words[i][:j] + "q" + words[i][j + 1:], words[i][:j] + words[i][j + 1:], words[i][:j] + "q" + words[i][j:]])
        return " ".join(words)
    for _ in range(250):
        pieces = []
        for _ in range(rnd.randint(1, 3)):
            label, notice = rnd.choice(NOTICES)
            pieces += ["".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 20))).strip() or "z", damaged(notice, rnd.randint(0, 4))]
        text = (re.sub(" +", " ", " ".join(pieces)) + " end ").encode()
        found = {search.notices[i][0] for _, _, i, _ in search.find(text)}
        every = set()
        for i, pattern in enumerate(search.patterns):
            for m in pattern.finditer(text, overlapped=True):
                if search.agrees(text, m.start(), m.end(), i):
                    every.add(search.notices[i][0])
        assert found <= every and every - found <= set() or {x for x in every if x not in found} <= overlapped(search, text)


def overlapped(search, text):
    """Labels whose every match overlaps a better one that was kept."""
    kept = [(a, z) for a, z, _, _ in search.find(text)]
    out = set()
    for i, pattern in enumerate(search.patterns):
        places = [(m.start(), m.end()) for m in pattern.finditer(text, overlapped=True) if search.agrees(text, m.start(), m.end(), i)]
        if places and all(any(a < z2 and a2 < z for a2, z2 in kept) for a, z in places):
            out.add(search.notices[i][0])
    return out


def test_pieces_cover_the_notice():
    from tenurekit.llm.license_scan import edits_allowed, pieces
    for _, notice in NOTICES:
        k = edits_allowed(notice)
        parts = pieces(notice, k)
        assert len(parts) == k + 1 and "".join(p for _, p in parts) == notice and all(notice[a:a + len(p)] == p for a, p in parts)
    assert pa is not None

"""Byte-level BPE against the tiktoken library and round trips, fill in the
middle against string slicing, the divergence audit against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tenurekit.llm import byte_bpe as B
from tenurekit.llm import divergence as D
from tenurekit.llm import fim
from tenurekit.llm import queries as Q
from tenurekit.llm import textvec as tv

# ---- byte-level BPE ---------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    return B.read_ranks(Q.byte_bpe_path())


@pytest.fixture(scope="module")
def vocabulary(ranks):
    return B.Vocabulary(ranks)


@pytest.fixture(scope="module")
def library(ranks):
    import public_tokenizers
    import tiktoken
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(vocabulary, texts):
    encoder, out = B.Encoder(vocabulary), []
    for lo, hi, b, offsets in tv.text_chunks(pa.array(texts, pa.string()), 5000):
        at, ids = encoder.encode(b, offsets)
        out += [ids[x:y].tolist() for x, y in zip(at[:-1], at[1:])]
    return out


def test_perfect_hash_is_minimal_and_finds_every_token(vocabulary, ranks):
    assert sorted(vocabulary.slots.tolist()) == list(range(len(ranks)))
    h = tv.span_hashes(vocabulary.blob, vocabulary.offsets[:-1], vocabulary.offsets[1:], False)
    assert (vocabulary.find(vocabulary.blob, vocabulary.offsets[:-1], vocabulary.offsets[1:], h) == np.arange(len(ranks))).all()


def test_equal_hash_with_other_bytes_is_no_hit(vocabulary):
    b = np.frombuffer(b"zqzqzq", np.uint8)
    h = tv.span_hashes(vocabulary.blob, vocabulary.offsets[:1], vocabulary.offsets[1:2], False)
    assert vocabulary.find(b, np.array([0]), np.array([6]), h).tolist() == [-1]


def test_encoding_equals_the_library(vocabulary, library):
    rnd = random.Random(7)
    parts = list("abst re vel lmd''''  \n\t\r  　éß漢字٣½ⅷ!?#-_.12345") + ["'s", "'re", "'ll", "'ve", "'d", "'m", "'t", " ", " ", "\x1c", "\x85", "😀", "𐐀", "the", " and", "<|endoftext|>"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(4000)]
    texts += ["", " ", "\n", "'", "'s", " 's", "x's", "\n's", "''s", "'same", "'ll'll", "a" * 5000, " " * 3000 + "x", "ab" * 3000 + "\n" * 50, "\r\n\r\n a"]
    texts += [chr(c) + "a" for c in range(1, 0x110000, 251) if not 0xD800 <= c < 0xE000]
    assert encoded(vocabulary, texts) == library.encode_ordinary_batch(texts)


def test_heap_merges_like_repeated_lowest_rank(ranks):
    def plain(piece):
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            r, i = min((ranks.get(parts[k] + parts[k + 1], 1 << 40), k) for k in range(len(parts) - 1))
            if r == 1 << 40:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[p] for p in parts]
    rnd = random.Random(5)
    for _ in range(300):
        piece = bytes(rnd.choice(b"aabcdeinorst\xc3\xa9") for _ in range(rnd.randint(1, 40)))
        assert B.merge_heap(piece, ranks) == plain(piece)


def test_memory_of_pre_tokens_is_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(B, "MEMO_ENTRIES", 10)
    encoder = B.Encoder(vocabulary)
    words = [f"zq{i}xw" for i in range(200)] * 2
    for w in words:
        assert encoder.merged(w.encode()) == B.merge_heap(w.encode(), vocabulary.ranks)
        assert len(encoder.young) <= 10 and len(encoder.old) <= 10


def test_vocabulary_errors(ranks):
    with pytest.raises(ValueError):
        B.Vocabulary({})
    with pytest.raises(ValueError):
        B.Vocabulary({b"a": 0})
    with pytest.raises(ValueError):
        B.Vocabulary({bytes([i]): min(i, 254) for i in range(256)})


def test_round_trip_in_spark(spark, library, monkeypatch):
    monkeypatch.setattr(B, "DECODE_IDS", 50)
    rows = [(1, "Ärger über Öl 😀's", 5, "x"), (1, "Ärger über Öl 😀's", 5, "x"), (2, None, None, None), (None, "", 1, "y"), (3, "wörd " * 3000, 2, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, `De coded` string").repartition(2)
    v = B.load(spark, Q.byte_bpe_path())
    out = B.decode(B.encode(df, v), v)
    assert out.columns == ["doc_id", "text", "De coded", "ids", "decoded"]
    for r in out.collect():
        assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.decoded).decode() == (r.text or "")
    bad = spark.createDataFrame([(1, [10**6])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="unknown id"):
        B.decode(bad, v).collect()
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(B.decode(none, v).first().decoded) == b""


def test_query_equals_the_library(spark, folder, documents, library):
    rows = [(1, "It's  a\n\ntest.", "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0), (None, "naïve 漢字 ½", "fr", "b", 9), (1, "It's  a\n\ntest.", "en", "a", 1)]
    got = Q.op12_byte_bpe(spark, folder(documents=documents(rows)))
    want = sorted(str((i, len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
                  for i, t, *_ in rows for x in [library.encode_ordinary(t or "")])
    assert sorted(str(tuple(r)) for r in got.collect()) == want


# ---- fill in the middle -------------------------------------------------------

def by_slicing(doc_id, text):
    t = text or ""
    w = re.findall("[A-Za-z]+|[^A-Za-z]", t)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    a, z = sorted((h1 % (len(w) + 1), h2 % (len(w) + 1)))
    p, m, s = "".join(w[:a]), "".join(w[a:z]), "".join(w[z:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(w), "plain", None, None, t
    return (len(w), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (len(w), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_fim_equals_slicing_and_restores(spark):
    rnd = random.Random(2)
    alphabet = list("abc XYZ\n\t<>PSM.é漢😀1") + ["word", "<P", "S>", "M>"]
    rows = [(i if i % 11 else None, "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))) for i in range(600)]
    rows += [(9001, None), (9002, "has <P> inside"), (9003, "<M>"), (9004, "long text é " * 20_000)]
    df = spark.createDataFrame([(i, t, "kept") for i, t in rows], "doc_id long, text string, `Form` string").repartition(3)
    made = fim.transform(df)
    assert "Form" not in made.columns and "form" in made.columns
    back = fim.restore(made.drop("text").withColumnRenamed("pieces", "p"))
    want = Counter((i, *by_slicing(i, t), t or "") for i, t in rows)
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in back.collect()) == want
    for r in back.collect():
        assert r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest() and r.restored_sha256 == hashlib.sha256(r.restored.encode()).hexdigest()
    forms = Counter(x[2] for x in want)
    assert min(forms["psm"], forms["spm"], forms["plain"]) > 10


def test_pieces_describe_the_output_without_copying(spark):
    text = "alpha beta gamma, délta " * 5
    for r in fim.transform(spark.createDataFrame([(i, text) for i in range(30)], "doc_id long, text string")).collect():
        raw = text.encode()
        spans = {"text": raw, **fim.SENTINELS}
        assert b"".join(spans[p.buffer][p.start:p.end] for p in r.pieces).decode() == r.output
        inside = sorted((p.start, p.end) for p in r.pieces if p.buffer == "text")
        assert inside[0][0] == 0 and inside[-1][1] == len(raw) and all(a[1] == b[0] for a, b in zip(inside, inside[1:]))


def test_piece_table_cuts_and_permutes():
    t = fim.PieceTable.of(b"abcdef")
    a, b, c = t.cut(2, 2)
    assert [x.bytes() for x in (a, b, c)] == [b"ab", b"", b"cdef"]
    both = fim.arrange([a, b, c], "spm")
    assert both.bytes() == b"<S>cdef<P>ab<M>"
    assert [x.bytes() for x in both.cut(4, 9)] == [b"<S>c", b"def<P", b">ab<M>"]  # cuts inside several descriptors
    assert fim.restored(both.bytes(), "spm").bytes() == b"abcdef" and fim.restored(b"", "plain").bytes() == b""
    assert both.sha256() == hashlib.sha256(b"<S>cdef<P>ab<M>").hexdigest()


# ---- source divergence -----------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_audit(rows, least=3, top=200):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        w = [x.translate(FOLD) for x in TERM.findall(text or "")]
        docs[lang or ""].update(set(w))
        counts[lang or "", source or ""].update(w)
        groups.add((lang or "", source or ""))
    out = set()
    for lang, source in groups:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        mates = sorted(s for g, s in groups if g == lang)
        share = {s: {t: 1 + 10**9 * (counts[lang, s][t] + 1) // (sum(counts[lang, s][u] for u in kept) + len(kept)) for t in kept} for s in mates}
        every = {t: sum(counts[lang, s][t] for s in mates) for t in kept}
        q = {t: 1 + 10**9 * (every[t] + 1) // (sum(every.values()) + len(kept)) for t in kept}
        pair = [(s, sum((share[source][t] - share[s][t]) ** 2 // share[s][t] for t in kept)) for s in mates if s != source]
        term = [(t, (share[source][t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, source][t] and share[source][t] > q[t]]
        for part, items in (("pair", pair), ("term", term)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out |= {(lang, source, part, i, v, k) for k, (i, v) in enumerate(items[:top] if part == "term" else items, 1)}
    return out


def audit_rows(seed=3):
    rnd = random.Random(seed)
    syllables = ["an", "Be", "ça", "漢", "the", "ing", "x", "straße"]
    words = ["".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 9))) for _ in range(300)]
    words += ["l" * 200, "l" * 199 + "m", "prefixed", "prefix", "prefixes"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60))), rnd.choice(["en", "de", None]), rnd.choice(["s1", "s2", "ß", None])) for i in range(150)]
    return rows + [(900, None, "xx", "only"), (901, "", "xx", "other"), (902, "lonely words", "yy", "one")]


@pytest.mark.parametrize("first_level", [2, 64])
def test_audit_equals_brute_force(spark, first_level, monkeypatch):
    rows = audit_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    got = [tuple(r) for r in D.audit(df, first_level=first_level).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_audit(rows)


def test_audit_does_not_depend_on_the_filter_size(spark, monkeypatch):
    rows = audit_rows(4)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    monkeypatch.setattr(D, "MAX_FILTER_BITS", 64)  # full of false positives
    assert {tuple(r) for r in D.audit(df, first_level=2, top=5).collect()} == brute_audit(rows, top=5)


def test_prefix_refinement_discards(spark):
    """A prefix that only two documents have is not extended."""
    rows = [("common rareone"), ("common raretwo"), ("common abcdefgh1")]
    df = spark.createDataFrame([(t, "en", "s") for t in rows], "text string, lang string, source string").repartition(1)
    assert [(r.term, r.docs, r["count"]) for r in D.kept_terms(df, 3, 4).collect()] == [(bytearray(b"common"), 3, 3)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 3), pa.array(["s"] * 3), pa.array(rows)], ["lang", "source", "text"])
    first = [r for b in D._scan(0, 4, None, 0)([batch]) for r in b.to_pylist()]
    assert {(r["key"], r["docs"]) for r in first if not r["complete"]} == {(b"comm", 3), (b"rare", 2), (b"abcd", 1)}


def test_equal_hashes_are_told_apart(monkeypatch):
    b = np.frombuffer(b"aabbaacc", np.uint8)
    starts, ends = np.array([0, 2, 4, 6]), np.array([2, 4, 6, 8])
    rep, docs, count = D._runs(np.zeros(4, np.uint64), np.array([0, 0, 1, 1]), b, starts, ends)
    assert sorted((bytes(b[starts[r]:ends[r]]), int(d), int(c)) for r, d, c in zip(rep, docs, count)) == [(b"aa", 2, 2), (b"bb", 1, 1), (b"cc", 1, 1)]


def test_shares_are_exact_for_any_count():
    big = np.array([0, 5, 10**15], np.int64)
    assert D.shares(big, 10**15 + 5, 3).tolist() == [1 + 10**9 * (c + 1) // (10**15 + 8) for c in (0, 5, 10**15)]

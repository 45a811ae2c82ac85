r"""MinHash near-duplicate detection with odd sketches.

A document's set holds the hashes of its distinct 4-word shingles (words
``[^\x20\x09-\x0D]+`` after A-Z are lower-cased; with fewer words the whole
sequence).  One pass over the texts gives each document its set's size and
128-bit fingerprint, ``BANDS`` band keys over ``BANDS * ROWS`` MinHash values,
and an odd sketch: the MinHash samples folded into a parity bitmap, whose XOR
population count estimates high similarities precisely.

1. Documents with equal sets form a class; its smallest id stands for it.
2. Classes that share a band key are candidates.  At first no bucket's pairs
   are listed: in each round every class is compared only with the smallest member of its
   buckets, the one nearest by odd sketch, and buckets that have become one
   component leave.  After ``STAR_ROUNDS`` such rounds, what is left are pairs
   across components in a common bucket whose sketches are near enough; the
   nearest of each class is taken first, then all that still lie across.
   A second odd sketch, of the whole set, prunes without loss: its XOR count
   never passes the true symmetric difference, so pairs above what the
   similarity allows are certainly no links.  Thus near misses within a family
   of copies do not leave the join that meets them, but for sets too long for
   the sketch.  A large bucket of those is compared in blocks of sizes and salts,
   so its work, still quadratic in the near misses that share a band, is spread
   over as many tasks as it has pairs of blocks.
3. Every candidate link is confirmed on the full sets: 100 * |A and B| >=
   80 * |A or B|.  Components are closed by hooking and pointer jumping over
   tables, nothing is collected.

A pair of similarity 0.8 shares no band with a chance of (1 - 0.8^5)^32 =
3e-6; a sketch that would reject it lies six standard deviations off.

Defined results: null or wordless texts have an empty set, size 0 and are
their own component; rows with a null id take no part, their component is
null and they are kept; rows that repeat an id and a text get the same result;
an id with several texts is in the component with the least id of theirs; an
empty table gives no rows; extra columns are not read (``drop_near_duplicates``
keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .base import stored

WORDS = 4
BANDS, ROWS = 32, 5
SKETCH_LONGS = 8
PERCENT = 80
WHOLE_LONGS = 32
STAR_ROUNDS = 2
#: members of a bucket that are compared in one task, at most
BLOCK = 1024
#: sketches further apart than this come from similarities below about 0.6
_N_BITS, _N_SAMPLES = 64 * SKETCH_LONGS, BANDS * ROWS
MAX_XOR = int(_N_BITS / 2 * (1 - (1 - 2 / _N_BITS) ** (2 * _N_SAMPLES * (1 - 0.6))))

_rng = np.random.default_rng(4)
_XOR = _rng.integers(0, 2**32, _N_SAMPLES, dtype=np.uint32)
_MUL = _rng.integers(0, 2**31, _N_SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SEED = _rng.integers(1, 2**62, BANDS, dtype=np.uint64)
_SAMPLE_SEED = _rng.integers(1, 2**62, _N_SAMPLES, dtype=np.uint64)


def shingle_sets(b: np.ndarray, offsets: np.ndarray, n: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    wh, first = tv.word_hashes(b, offsets, tv.SPACED, True)
    h = tv.ngram_hashes(wh, n)
    for a, z in zip(first[:-1].tolist(), first[1:].tolist()):
        if z - a >= n:
            x = np.sort(h[a:z - n + 1])
            yield x[np.r_[True, x[1:] != x[:-1]]]
        elif z > a:
            yield tv.ngram_hashes(wh[a:z], z - a)
        else:
            yield np.zeros(0, np.uint64)


def minhashes(s: np.ndarray, step: int = 2048) -> np.ndarray:
    """MinHash values of a non-empty set."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = None
    for k in range(0, len(x), step):
        part = ((x[None, k:k + step] ^ _XOR[:, None]) * _MUL[:, None]).min(axis=1)
        out = part if out is None else np.minimum(out, part)
    return out


def odd_sketch(m: np.ndarray) -> np.ndarray:
    """Parity bitmap of (sample number, MinHash value) as longs."""
    bit = (tv.mix(m.astype(np.uint64) ^ _SAMPLE_SEED) % np.uint64(_N_BITS)).astype(np.int64)
    odd = (np.bincount(bit, minlength=_N_BITS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def whole_sketch(s: np.ndarray) -> np.ndarray:
    """Parity bitmap of a whole set as longs."""
    n = 64 * WHOLE_LONGS
    odd = (np.bincount((s & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def _sign(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _signed(batches, words)
    return run


def _signed(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, fp1, fp2, bands, sketch = [], [], [], [], []
        with np.errstate(over="ignore"):
            for _, _, b, offsets in tv.text_chunks(batch.column("text")):
                for s in shingle_sets(b, offsets, words):
                    sizes.append(len(s))
                    if not len(s):
                        fp1.append(0), fp2.append(0), bands.append(None), sketch.append(None)
                        continue
                    fp1.append(int(tv.mix(s).sum().view(np.int64)))
                    fp2.append(int(np.bitwise_xor.reduce(tv.mix(s * np.uint64(0x9FB21C651E98DF25) + np.uint64(len(s)))).view(np.int64)))
                    m = minhashes(s)
                    key = _SEED.copy()
                    for v in m.reshape(BANDS, ROWS).T:
                        key = tv.mix(key ^ v)
                    bands.append(key.view(np.int64))
                    sketch.append(odd_sketch(m))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "fp1", "fp2", "bands", "sketch"])


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, b, offsets in tv.text_chunks(batch.column("text")):
                sets = list(shingle_sets(b, offsets, words))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, hi - lo), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                     pa.array([whole_sketch(s) for s in sets], pa.list_(pa.int64()))], ["id", "shingles", "whole"])
    return run


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, fingerprint, band keys and odd sketch of each row."""
    d = docs.select("doc_id", "text")
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(_sign(words), f"doc_id {kind}, n_shingles long, fp1 long, fp2 long, bands array<long>, sketch array<long>")


def _distance(a: str, b: str, longs: int = SKETCH_LONGS) -> Column:
    """Bits in which two sketches differ."""
    d = F.lit(0)
    for i in range(longs):
        d = d + F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))))
    return d


def _similar_sizes(a: str, b: str) -> Column:
    """Sizes that allow the similarity at all."""
    return (100 * F.least(a, b) >= PERCENT * F.greatest(a, b))


def _may_link(x: str = "a", y: str = "b") -> Column:
    """Whether sizes and both sketches of two rows allow a link."""
    total = F.col(f"n{x}") + F.col(f"n{y}")
    return (_similar_sizes(f"n{x}", f"n{y}") & (_distance(f"k{x}", f"k{y}") <= MAX_XOR)
            & ((100 + PERCENT) * _distance(f"w{x}", f"w{y}", WHOLE_LONGS) <= (100 - PERCENT) * total))


def close_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(id, comp) where comp is the smallest id reachable over ``links`` (a, b)
    and the components that ``labels`` (id, comp) already has."""
    la, lb = labels.select(F.col("id").alias("a"), F.col("comp").alias("ca")), labels.select(F.col("id").alias("b"), F.col("comp").alias("cb"))
    edges = links.select("a", "b").join(la, "a").join(lb, "b").filter("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
    edges = stored(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "dup-edges")
    # roots of the graph between components; hook to the least neighbour, then jump
    roots = stored(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("r")), "dup-roots")
    while True:
        up = roots.select(F.col("a").alias("r"), F.col("r").alias("rr"))
        jumped = roots.join(up, "r").select("a", F.col("rr").alias("r"))
        near = edges.join(jumped.select(F.col("a").alias("b"), F.col("r").alias("rb")), "b").groupBy("a").agg(F.min("rb").alias("m"))
        new = stored(jumped.join(near, "a").select("a", F.least("r", "m").alias("r")), "dup-roots")
        changed = new.join(roots.withColumnRenamed("r", "old"), "a").filter("r <> old").limit(1).count()
        roots = new
        if not changed:
            break
    moved = roots.select(F.col("a").alias("comp"), "r")
    return labels.join(moved, "comp", "left").select("id", F.coalesce("r", "comp").alias("comp"))


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough, and ``ok``."""
    sa = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    rows = pairs.select("a", "b").join(sa, "a").join(sb, "b")
    return rows.select("a", "b", (100 * both >= PERCENT * (F.size("sa") + F.size("sb") - both)).alias("ok"))


def _blocks(rest: DataFrame) -> DataFrame:
    """Pairs across components in a common bucket that sizes and sketches allow.

    A bucket of more than ``BLOCK`` members is split: by size, as only sizes of a
    ratio up to 100 / ``PERCENT`` can link (a class meets itself and its
    neighbours), and into blocks of members by a salt of their ids, each pair of
    blocks being a key of its own.  So no task holds more than a block by a block
    of a bucket, however large it is, and every pair meets once."""
    sizes = rest.groupBy("key").agg(F.count(F.lit(1)).alias("_m")).select("key", F.ceil(F.col("_m") / BLOCK).cast("int").alias("_g"))
    hot = F.col("_g") > 1
    size_class = F.floor(F.log(F.col("n_shingles").cast("double")) / float(np.log(100 / PERCENT + 0.01)))
    rest = rest.join(sizes, "key").withColumns({
        "_s": F.pmod(F.xxhash64("id"), F.col("_g")).cast("int"), "_c": F.when(hot, size_class).otherwise(F.lit(0)).cast("int"),
        "_o": F.explode(F.sequence(F.lit(0), F.col("_g") - 1))})
    classes = F.when(hot, F.array(F.col("_c") - 1, F.col("_c"), F.col("_c") + 1)).otherwise(F.array(F.col("_c")))

    def side(i: str) -> list[Column]:
        return [F.col("id").alias(i), F.col("comp").alias(f"c{i}"), F.col("n_shingles").alias(f"n{i}"), F.col("sketch").alias(f"k{i}"), F.col("whole").alias(f"w{i}")]
    x = rest.select("key", F.col("_c").alias("class"), F.col("_s").alias("p"), F.col("_o").alias("q"), *side("a"))
    y = rest.select("key", F.explode(classes).alias("class"), F.col("_o").alias("p"), F.col("_s").alias("q"), *side("b"))
    return x.join(y, ["key", "class", "p", "q"]).filter((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _may_link())


def components(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept; shingles of ``words`` words."""
    sig = stored(signatures(docs, words), "dup-signatures")
    keyed = sig.filter("doc_id IS NOT NULL AND n_shingles > 0")
    equal = ["n_shingles", "fp1", "fp2"]
    classes = keyed.groupBy(*equal).agg(F.min("doc_id").alias("id"))
    members = stored(keyed.select("doc_id", *equal).distinct().join(classes, equal).select("doc_id", "n_shingles", "id"), "dup-classes")
    heads = keyed.join(classes.withColumnRenamed("id", "doc_id"), [*equal, "doc_id"], "left_semi").dropDuplicates(["doc_id", *equal])
    heads = heads.select(F.col("doc_id").alias("id"), "n_shingles", "bands", "sketch")

    keys = heads.select("id", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    buckets = stored(keys.join(shared, "key"), "dup-buckets")
    busy = buckets.select("id").distinct()
    # the texts of the classes that have candidates, repeated rows once
    texts = docs.select(F.col("doc_id").alias("id"), "text").join(busy, "id", "left_semi").dropDuplicates(["id", "text"])
    kind = busy.schema["id"].dataType.simpleString()
    sets = stored(texts.mapInArrow(_sets(words), f"id {kind}, shingles array<long>, whole array<long>"), "dup-sets")
    sketches = stored(sets.select("id", "whole").join(heads.select("id", "n_shingles", "sketch"), "id"), "dup-sketches")
    labels = stored(busy.select("id", F.col("id").alias("comp")), "dup-labels")
    sa = sketches.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("ka"), F.col("whole").alias("wa"))
    sb = sketches.select(F.col("id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("kb"), F.col("whole").alias("wb"))
    failed = None

    def near(pairs: DataFrame) -> DataFrame:
        """Pairs that sizes and sketches allow, with the sketch distance."""
        rows = pairs.join(sa, "a").join(sb, "b").filter(_may_link())
        return rows.select("a", "b", _distance("wa", "wb", WHOLE_LONGS).alias("d"))

    def settle(pairs: DataFrame) -> None:
        nonlocal labels, failed
        checked = stored(confirm(pairs, sets), "dup-checked")
        bad = checked.filter("NOT ok").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        failed = bad if failed is None else failed.union(bad)
        labels = stored(close_components(labels, checked.filter("ok")), "dup-labels")

    for _ in range(STAR_ROUNDS):
        now = buckets.join(labels, "id")
        hub = (now.groupBy("key").agg(F.min(F.struct("comp", "id")).alias("hub"), F.max("comp").alias("most"))
               .filter("hub.comp <> most").select("key", F.col("hub.id").alias("b"), F.col("hub.comp").alias("hc")))
        pairs = now.join(hub, "key").filter("comp <> hc").select(F.col("id").alias("a"), "b").distinct()
        if failed is not None:
            tried = failed.union(failed.select("b", "a"))
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        best = near(pairs).groupBy("a").agg(F.min(F.struct("d", "b")).alias("x")).select("a", F.col("x.b").alias("b"))
        settle(best)

    # what is left: pairs across components that share a bucket
    now = buckets.join(labels, "id")
    open_ = now.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("key")
    rest = stored(now.join(open_, "key").join(sketches, "id"), "dup-rest")
    across = _blocks(rest)
    across = across.select("a", "b", _distance("wa", "wb", WHOLE_LONGS).alias("d")).distinct()
    across = stored(across.join(failed, ["a", "b"], "left_anti"), "dup-across")

    def still_apart() -> DataFrame:
        x, y = labels.select(F.col("id").alias("a"), F.col("comp").alias("ca")), labels.select(F.col("id").alias("b"), F.col("comp").alias("cb"))
        return across.join(x, "a").join(y, "b").filter("ca <> cb").join(failed, ["a", "b"], "left_anti").select("a", "b", "d")

    # first the nearest partner of each, which joins most of what belongs together; then every pair left
    nearest = still_apart().groupBy("a").agg(F.min(F.struct("d", "b")).alias("x")).select("a", F.col("x.b").alias("b"))
    settle(nearest)
    settle(still_apart().select("a", "b"))

    comp = members.join(labels, "id", "left").select("doc_id", F.coalesce("comp", "id").alias("comp"))
    # an id with several texts belongs to all their components: join those too
    least = comp.groupBy("doc_id").agg(F.min("comp").alias("a"), F.max("comp").alias("most"))
    several = comp.join(least.filter("a <> most").select("doc_id", "a"), "doc_id").filter("a <> comp").select("a", F.col("comp").alias("b")).distinct()
    if several.limit(1).count():
        several = stored(several, "dup-joined")
        nodes = several.select(F.col("a").alias("id")).union(several.select("b")).distinct().select("id", F.col("id").alias("comp"))
        joined = close_components(nodes, several).select(F.col("id").alias("comp"), F.col("comp").alias("to"))
        comp = comp.join(joined, "comp", "left").select("doc_id", F.coalesce("to", "comp").alias("comp"))
    comp = comp.groupBy("doc_id").agg(F.min("comp").alias("comp"))
    out = sig.select("doc_id", "n_shingles").join(comp, "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, words: int = 5) -> DataFrame:
    """One document of each component (the smallest id), same columns; five-word
    shingles.  An id that is recorded with several texts keeps each of them
    once, the row that is least by its other columns."""
    c = components(docs, words)
    copies = c.filter("NOT kept").select("doc_id").distinct()
    kept = [F.col(f"`{x}`") for x in docs.columns]
    left = docs.join(copies, "doc_id", "left_anti").select(*kept)
    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1 AND doc_id IS NOT NULL").select("doc_id")
    once = left.join(again, "doc_id", "left_anti").select(*kept)
    others = [x for x in docs.columns if x not in ("doc_id", "text")]
    more = left.join(again, "doc_id", "left_semi")
    if others:
        first = F.min(F.struct(*[F.col(f"`{x}`").alias(f"c{i}") for i, x in enumerate(others)]))
        more = more.groupBy("doc_id", "text").agg(first.alias("_r"))
        place = {x: f"_r.c{i}" for i, x in enumerate(others)}
        more = more.select(*[F.col(place.get(x, x)).alias(x) for x in docs.columns])
    else:
        more = more.dropDuplicates(["doc_id", "text"]).select(*kept)
    return once.unionByName(more)

"""Mixing sources to target weights by Pareto order sampling.

Sources share a total in proportion to their weights; no target may pass
``max_copies`` times its source's size, and what lies above is shared again by
weight (water filling, solved in closed form over the sorted cap levels).
A document of a source with target ratio t = target / source size is taken
floor(t) times for certain.  The rest of the target is an unequal-probability
sample without replacement: documents have inclusion probabilities of their
own, higher for those shorter than their source's mean, that add up in words to
what is left.  Each draws u and is ranked by its random odds u / (1 - u) over
its inclusion odds p / (1 - p), and the documents of lowest rank are taken until
the words come nearest to what is left (at most half a document off).

The cut is found without ordering a source: words are summed per (source,
slice of the ranking value), prefix sums over that small table find the slice
in which the target is reached, and only that slice's documents are ordered.
Those of equal rank, id and size are counted first, and a slice that still holds
many is cut into finer ones until few are left (or the value has no finer ones).
So one source may hold most rows, and one id most rows of a source.  If the cut
falls among rows that are equal in rank, id and size, as many of them are taken
as the target asks for, by a row number that is stored once: by file part first,
then inside the one part in which the cut falls.

Defined results: a null text has size 0; null sources form one source, last in
order; empty tables give no rows; equal ids (also null ones) draw the same u
and are ordered by size; of rows equal in id, size and source some may be taken
once more than the others, how many does not depend on partitions; a corpus
without words takes nothing.  Extra columns are ignored by ``mix`` and kept by
``take``; a column named like a result of ``take`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tenurekit.session import MAX_BROADCAST_ROWS

from .base import stored

SLICES = 1 << 16
#: combinations of rank, id and size that one task may order
FEW = 100_000
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of runs of non-white-space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: str) -> Column:
    """Uniform number in (0, 1) from 52 bits of md5(seed:id)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights=(5, 2, 1), total: float = 1.5, max_copies: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size); a row per source."""
    k = len(weights)
    order = W.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(order) - 1, F.lit(k))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    s = sizes.withColumn("_w", weight)
    everything = W.partitionBy()
    # sources in order of the level at which they are full
    s = (s.withColumn("_level", F.col("source_size") * max_copies / F.col("_w"))
         .withColumn("_all", F.sum("source_size").over(everything) * total)
         .withColumn("_wall", F.sum("_w").over(everything)))
    below = W.orderBy("_level", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    s = (s.withColumn("_full", F.coalesce(F.sum("source_size").over(below), F.lit(0)) * max_copies)
         .withColumn("_wfull", F.coalesce(F.sum("_w").over(below), F.lit(0.0)))
         .withColumn("_at", (F.col("_all") - F.col("_full")) / (F.col("_wall") - F.col("_wfull"))))
    # the level of the first source that is not full when those before it are; it falls from there on
    level = F.max(F.when(F.col("_at") <= F.col("_level"), F.col("_at"))).over(everything)
    target = F.when(level.isNull() | (F.col("_level") <= level), F.col("source_size") * max_copies)
    return s.select("source", "source_size", target.otherwise(F.col("_w") * level).alias("target"))


def mix(docs: DataFrame, weights=(5, 2, 1), total: float = 1.5, max_copies: float = 2.0,
        seed: str = "mix-1", slices: int = SLICES, limit: int = FEW) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every document."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return take(sized, weights, total, max_copies, seed, slices, limit)


def _with_cut(t: DataFrame, per_slice: DataFrame, few: bool, slices: int) -> DataFrame:
    """``t`` with the slice in which the sample of each source ends (``_cut``)
    and the words before it; ``_cut_before`` of ``t`` are those before all
    slices of (source, _slice, _words), at most ``slices`` a source."""
    # prefix sums in two levels: no window holds more than about sqrt(slices) rows
    wide = max(1, int(slices ** 0.5))
    per_slice = per_slice.withColumn("_block", F.floor(F.col("_slice") / wide))
    per_block = per_slice.groupBy("source", "_block").agg(F.sum("_words").alias("_bw"))
    before = W.partitionBy("source").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = per_block.select(F.col("source").alias("_bs"), F.col("_block").alias("_bb"),
                              F.coalesce(F.sum("_bw").over(before), F.lit(0)).alias("_b0"))
    inside = W.partitionBy("source", "_block").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = (per_slice.withColumn("_in", F.coalesce(F.sum("_words").over(inside), F.lit(0)))
              .join(blocks, F.col("source").eqNullSafe(F.col("_bs")) & (F.col("_block") == F.col("_bb")))
              .select("source", "_slice", "_words", (F.col("_in") + F.col("_b0")).alias("_before")))
    cut = (starts.join(F.broadcast(t) if few else t, F.col("source").eqNullSafe(F.col("_source")))
           .withColumn("_before", F.col("_cut_before") + F.col("_before"))
           .filter((F.col("_p") > 0) & (F.col("_before") <= F.col("_rest"))
                   & (F.col("_rest") < F.col("_before") + F.col("_words")))
           .select(F.col("source").alias("_cs"), F.col("_slice").alias("_cut"), F.col("_before").alias("_at")))
    return t.drop("_cut_before").join(cut, F.col("_source").eqNullSafe(F.col("_cs")), "left").withColumnRenamed("_at", "_cut_before").drop("_cs")


RESULTS = ("source_size", "target", "copies", "taken")


def inclusion(p: Column, size: Column, mean_size: Column, mean_score: Column) -> Column:
    """Inclusion probability of a document in a source of rate p: p, moved by
    how far its size lies from the source's mean.  The score, whole numbers from
    -1000 to 1000, is taken against its word-weighted mean, so the probabilities
    add up to p times the words of the source."""
    rate = p + F.least(p, 1 - p) * (score(size, mean_size) - mean_score) / F.lit(2000.0)
    return F.least(F.greatest(rate, F.lit(1e-9)), F.lit(1 - 1e-9))


def score(size: Column, mean_size: Column) -> Column:
    # integer division towards zero
    return F.call_function("div", 1000 * (mean_size - size), mean_size + size).cast("long")


def _ranked(rows: DataFrame, t: DataFrame, same: Column, few: bool, seed: str) -> DataFrame:
    """Rows with their source's figures and the ranking value ``_v``: the odds
    ratio, brought from (0, inf) to (0, 1)."""
    u = draw(F.col("doc_id"), seed)
    pi = inclusion(F.col("_p"), F.col("size"), F.col("_mean"), F.col("_score"))
    out = rows.join(F.broadcast(t) if few else t, same).withColumns({"_u": u, "_pi": pi})
    out = out.withColumn("_q", (F.col("_u") / (1 - F.col("_u"))) / (F.col("_pi") / (1 - F.col("_pi"))))
    return out.withColumn("_v", F.col("_q") / (1 + F.col("_q"))).drop("_u", "_pi", "_q")


def take(sized: DataFrame, weights=(5, 2, 1), total: float = 1.5, max_copies: float = 2.0,
         seed: str = "mix-1", slices: int = SLICES, limit: int = FEW) -> DataFrame:
    """As ``mix``, from rows that have doc_id, source and size; other columns are kept."""
    names = [c for c in sized.columns if c not in RESULTS]
    # columns of other names than those used here, whatever theirs are
    rest = [c for c in names if c not in ("doc_id", "source", "size")]
    sized = sized.select("doc_id", "source", "size", *[F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(rest)])
    narrow = stored(sized.select("doc_id", "source", "size"), "mix-sizes")
    sums = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_n"))
    t = source_targets(sums.select("source", "source_size"), weights, total, max_copies)
    mean = sums.select(F.col("source").alias("_ms"), F.greatest(F.call_function("div", "source_size", "_n").cast("long"), F.lit(1).cast("long")).alias("_mean"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    t = stored(t.withColumn("_ratio", ratio).withColumn("_whole", F.floor("_ratio"))
               .withColumn("_p", F.col("_ratio") - F.col("_whole"))
               .withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size"))
               .join(mean, F.col("source").eqNullSafe(F.col("_ms")))
               .select(F.col("source").alias("_source"), "source_size", "target", "_whole", "_p", "_rest", "_mean"), "mix-targets")
    few = t.count() <= MAX_BROADCAST_ROWS
    same = F.col("source").eqNullSafe(F.col("_source"))
    scored = (narrow.join(F.broadcast(t) if few else t, same).groupBy(F.col("source").alias("_ws"))
              .agg(F.sum(F.col("size") * score(F.col("size"), F.col("_mean"))).alias("_sum")))
    t = stored(t.join(scored, F.col("_source").eqNullSafe(F.col("_ws")))
               .withColumn("_score", F.when(F.col("source_size") > 0, F.col("_sum").cast("double") / F.col("source_size").cast("double")).otherwise(0.0))
               .drop("_ws", "_sum"), "mix-scores")

    fine = slices
    figures = ["_source", "_p", "_mean", "_score"]
    keyed = _ranked(narrow, t.select(*figures), same, few, seed).filter("_p > 0").drop(*figures)
    in_slice = lambda: F.floor(F.col("_v") * fine)
    per_slice = keyed.withColumn("_slice", in_slice()).groupBy("source", "_slice").agg(F.sum("size").alias("_words"))
    cuts = stored(_with_cut(t.withColumn("_cut_before", F.lit(0).cast("long")), per_slice, few, slices), "mix-cuts")
    # the documents of that slice, equal ones counted
    equal = (keyed.withColumn("_slice", in_slice())
             .join(F.broadcast(cuts) if few else cuts, same & (F.col("_slice") == F.col("_cut")))
             .groupBy("source", "_v", "doc_id", "size").agg(F.count(F.lit(1)).alias("_n")))
    equal = stored(equal, "mix-equal")
    while fine * slices <= 1 << 52 and (equal.groupBy("source").count().agg(F.max("count")).first()[0] or 0) > limit:
        fine *= slices
        finer = equal.withColumn("_slice", in_slice())
        per_slice = finer.groupBy("source", "_slice").agg(F.sum(F.col("size") * F.col("_n")).alias("_words"))
        cuts = stored(_with_cut(cuts.drop("_cut"), per_slice, few, slices), "mix-cuts")
        equal = stored(finer.join(F.broadcast(cuts) if few else cuts, same & (F.col("_slice") == F.col("_cut"))).select(*equal.columns), "mix-equal")
    # in order of the ranking value: of each group, the rows that bring the words nearer to what is left
    run = W.partitionBy("source").orderBy("_v", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    nearer = lambda j: F.col("_upto") + j * F.col("size") + F.col("size") / 2 <= F.col("_rest")
    guess = F.when(F.col("size") > 0, F.floor((F.col("_rest") - F.col("_upto")) / F.greatest(F.col("size"), F.lit(1)) + 0.5)).otherwise(F.col("_n")).cast("long")
    groups = (equal.join(F.broadcast(cuts) if few else cuts, same)
              .withColumn("_upto", F.col("_cut_before") + F.coalesce(F.sum(F.col("size") * F.col("_n")).over(run), F.lit(0)))
              .filter(nearer(F.lit(0))).withColumn("_guess", F.least(F.greatest(guess, F.lit(1).cast("long")), F.col("_n")))
              # the division may be one off where the words are very many
              .withColumn("_k", F.when(~nearer(F.col("_guess") - 1), F.col("_guess") - 1).when((F.col("_guess") < F.col("_n")) & nearer(F.col("_guess")), F.col("_guess") + 1)
                          .otherwise(F.col("_guess"))))
    last = groups.groupBy("source").agg(F.max(F.struct("_v", "doc_id", "size", "_k", "_n")).alias("_l")).select(
        F.col("source").alias("_ls"), F.struct("_l._v", "_l.doc_id", "_l.size").alias("_last"), F.col("_l._k").alias("_k"), (F.col("_l._k") < F.col("_l._n")).alias("_partly"))
    t = stored(cuts.join(last, F.col("_source").eqNullSafe(F.col("_ls")), "left").drop("_ls"), "mix-last")

    key = F.struct("_v", "doc_id", "size")
    drawn = F.when(F.col("_p") <= 0, False).otherwise(
        F.when(F.col("_cut").isNull(), F.col("_rest") > 0)
        .otherwise((F.col("_slice") < F.col("_cut"))
                   | ((F.col("_slice") == F.col("_cut")) & F.coalesce(key <= F.col("_last"), F.lit(False)))))
    out = _ranked(sized, t, same, few, seed).withColumn("_slice", in_slice()).withColumn("_drawn", F.coalesce(drawn, F.lit(False)))
    if t.filter("_partly").limit(1).count():
        tied = F.coalesce(F.col("_partly") & (F.col("_slice") == F.col("_cut")) & (key == F.col("_last")), F.lit(False))
        out = out.filter(~tied).unionByName(_some_of(out.filter(tied)))
    copies = (F.col("_whole") + F.col("_drawn").cast("long")).cast("long")
    place = {c: f"__{i}" for i, c in enumerate(rest)}
    return out.select(*[F.col(place.get(c, c)).alias(c) for c in names], F.col("source_size").cast("long").alias("source_size"), "target",
                      copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def _some_of(tied: DataFrame) -> DataFrame:
    """``_k`` rows of each source drawn, of rows that nothing tells apart.  Their
    numbers are stored with them, so a rerun of a later task sees the same; they
    rise by 1 within a part, whose counts find the part with the cut."""
    columns = tied.columns
    rows = stored(tied.withColumn("_row", F.monotonically_increasing_id()), "mix-tied")
    part = F.shiftright("_row", 33)
    counts = rows.groupBy("source", part.alias("_part")).agg(F.count(F.lit(1)).alias("_c"), F.first("_k").alias("_want"))
    before = F.coalesce(F.sum("_c").over(W.partitionBy("source").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("_b", before).select(F.col("source").alias("_cs"), F.col("_part").alias("_cp"), (F.col("_want") - F.col("_b")).alias("_left"), "_c")
    placed = rows.withColumn("_part", part).join(counts, F.col("source").eqNullSafe(F.col("_cs")) & (F.col("_part") == F.col("_cp")))
    whole = placed.filter("_left <= 0 OR _left >= _c").withColumn("_drawn", F.col("_left") > 0)
    number = F.row_number().over(W.partitionBy("source", "_part").orderBy("_row"))  # one part of each source
    cut = placed.filter("_left > 0 AND _left < _c").withColumn("_drawn", number <= F.col("_left"))
    return whole.select(*columns).unionByName(cut.select(*columns))


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row of ``take`` as often as it has copies, none
    without; ``copy`` numbers them from 1, other columns stay."""
    return mixed.filter(F.col("copies") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))

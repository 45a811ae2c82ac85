"""Analyses the reference plans but never codes (survey §2.10, last list):
Kaplan–Meier by group, two-group log-rank test, tier transition matrix,
chi-square test of independence and one-way ANOVA.

All are aggregates over small derived tables (one row per group × distinct
time, per tier pair, per contingency cell); the running products and sums
are windows over those tables, not over rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean
from .prefix import running_before, running_sums


def kaplan_meier(df: DataFrame, time: str, event: str, group: str | None = None) -> DataFrame:
    """Product-limit estimate per group at each distinct time:
    S(t) = prod over times <= t of (1 - d/n), n = at risk just before t.

    Both the numbers at risk and the product (as running sums of logs and of the
    factors that are 0) are range-split prefix sums over the distinct times, so
    an ungrouped curve, or one of a hot group, never meets in one task."""
    keys = [group] if group else []
    c = df.where(F.col(time).isNotNull()).groupBy(*keys, F.col(time).cast("double").alias("t")).agg(
        F.sum(F.col(event).cast("long")).alias("d"), F.count(F.lit(1)).alias("c"))
    # rows at later times, from a sum in falling order
    c = running_sums(c, keys, [F.desc("t")], {"_later": "c"})
    c = c.withColumn("n_at_risk", (F.col("_later") + F.col("c")).cast("long"))
    # log of each factor; a factor of 0 (everyone left died) zeroes the curve
    zero = (F.col("d") == F.col("n_at_risk"))
    c = c.withColumns({"_lg": F.when(zero, F.lit(0.0)).otherwise(F.coalesce(F.log1p(-F.col("d") / F.col("n_at_risk")), F.lit(0.0))),
                       "_z": F.coalesce(zero, F.lit(False)).cast("int")})
    c = running_sums(c, keys, ["t"], {"_slg": "_lg", "_sz": "_z"})
    return c.select(*keys, "t", "n_at_risk", "d",
                    F.when(F.col("_sz") + F.col("_z") > 0, F.lit(0.0))
                     .otherwise(F.exp(F.col("_slg") + F.col("_lg"))).alias("survival"))


def logrank(df: DataFrame, time: str, event: str, group: str, a: str, b: str) -> DataFrame:
    """Two-group log-rank statistic (chi-square, 1 df) for groups a and b."""
    d = df.where(F.col(group).isin(a, b) & F.col(time).isNotNull())
    per = d.groupBy(F.col(time).cast("double").alias("t")).agg(
        F.sum(F.when(F.col(group) == a, F.col(event).cast("long")).otherwise(0)).alias("d1"),
        F.sum(F.col(event).cast("long")).alias("d"),
        F.count_if(F.col(group) == a).alias("c1"), F.count(F.lit(1)).alias("c"))
    # at risk = total - rows at earlier times (range-partitioned prefix sums)
    tot1 = per.agg(F.sum("c1")).scalar()
    tot = per.agg(F.sum("c")).scalar()
    per = running_before(running_before(per, "t", "c1", "b1"), "t", "c", "b")
    per = per.withColumns({"n1": tot1 - F.col("b1"), "n": tot - F.col("b")})
    e1 = F.col("d") * F.col("n1") / F.col("n")
    v = F.when(F.col("n") > 1, F.col("d") * (F.col("n1") / F.col("n")) * (1 - F.col("n1") / F.col("n"))
               * (F.col("n") - F.col("d")) / (F.col("n") - 1)).otherwise(0.0)
    return per.where(F.col("d") > 0).agg(
        F.sum("d1").alias("observed_a"), F.sum(e1).alias("expected_a"), F.sum(v).alias("variance")
    ).withColumn("statistic", (F.col("observed_a") - F.col("expected_a")) ** 2 / F.col("variance"))


def tier_transitions(rows: DataFrame, entity: str, season: str, tier: str, order: str) -> DataFrame:
    """Counts of (tier in one observed season -> tier in the entity's next
    observed season).  A season's tier is its last row's; the window runs
    over one row per (entity, season)."""
    per = (rows.where(F.col(tier).isNotNull()).groupBy(entity, season)
           .agg(F.max_by(F.col(tier), F.col(order)).alias("tier")))
    w = Window.partitionBy(entity).orderBy(season)
    pairs = per.select(F.lag("tier").over(w).alias("from_tier"), F.col("tier").alias("to_tier"))
    return (pairs.where(F.col("from_tier").isNotNull()).groupBy("from_tier", "to_tier")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("from_rank", clean.tier_rank(F.col("from_tier")))
            .withColumn("to_rank", clean.tier_rank(F.col("to_tier"))))


def chi_square(df: DataFrame, row: str, col: str) -> DataFrame:
    """Chi-square test of independence.  Uses sum over cells of (O-E)^2/E =
    sum over *observed* cells of O^2/E - N, so empty cells never need to be
    materialised (no row × column product)."""
    cells = df.groupBy(row, col).agg(F.count(F.lit(1)).alias("o"))
    rows_t = cells.groupBy(row).agg(F.sum("o").alias("r"))
    cols_t = cells.groupBy(col).agg(F.sum("o").alias("k"))
    n = cells.agg(F.sum("o")).scalar()
    nr = rows_t.agg(F.count(F.lit(1))).scalar()
    nc = cols_t.agg(F.count(F.lit(1))).scalar()
    j = cells.join(rows_t, row).join(cols_t, col)
    return j.agg(F.sum(F.col("o") * F.col("o") * n / (F.col("r") * F.col("k"))).alias("_q")).select(
        (F.col("_q") - n).alias("statistic"), ((nr - 1) * (nc - 1)).cast("int").alias("df"), n.cast("long").alias("n"))


def anova_oneway(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way ANOVA F statistic from per-group count, sum and sum of squares."""
    g = df.where(F.col(value).isNotNull()).groupBy(group).agg(
        F.count(value).alias("n"), F.sum(value).alias("s"), F.sum(F.col(value) * F.col(value)).alias("ss"))
    t = g.agg(F.sum("n").alias("N"), F.sum("s").alias("S"), F.sum("ss").alias("SS"), F.count(F.lit(1)).alias("k"),
              F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between_raw"))
    ssb = F.col("between_raw") - F.col("S") * F.col("S") / F.col("N")
    ssw = F.col("SS") - F.col("between_raw")
    return t.select(F.col("k").cast("int").alias("k"), F.col("N").cast("long").alias("n"),
                    ssb.alias("ss_between"), ssw.alias("ss_within"),
                    ((ssb / (F.col("k") - 1)) / (ssw / (F.col("N") - F.col("k")))).alias("f_statistic"))


# --- bootstrap, cross-validation, date-order checks -------------------------

# Poisson(1) cumulative probabilities for k = 0..12, the resolution of the
# 30-bit hash that draws from them.
_POISSON1_CDF = [math.exp(-1) * sum(1 / math.factorial(i) for i in range(k + 1)) for k in range(13)]


def poisson_weight(*keys) -> "F.Column":
    """Deterministic Poisson(1) draw from a hash of the keys (inverse CDF)."""
    u = F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) / float(1 << 30)
    w = F.lit(len(_POISSON1_CDF))
    for k in reversed(range(len(_POISSON1_CDF))):
        w = F.when(u < _POISSON1_CDF[k], F.lit(k)).otherwise(w)
    return w


def bootstrap_mean_ci(df: DataFrame, group: str, value: str, id_col: str, replicates: int = 200,
                      seed: int = 42, alpha: float = 0.05) -> DataFrame:
    """Percentile bootstrap interval of a group mean (Poisson bootstrap).

    Each row gets a Poisson(1) weight per replicate from a hash of
    (id, replicate, seed), so the resampling is reproducible and needs no
    shuffle of rows: the weighted sums are pre-aggregated per (group,
    replicate) on the map side and only those small sums are shuffled."""
    rep = F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("b")
    x = df.where(F.col(value).isNotNull()).select(group, F.col(value).cast("double").alias("x"), id_col, rep)
    w = poisson_weight(F.col(id_col).cast("string"), F.col("b"), F.lit(seed))
    per = x.withColumn("w", w).groupBy(group, "b").agg(
        (F.sum(F.col("w") * F.col("x")) / F.sum("w")).alias("m"))
    point = df.groupBy(group).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
    ci = per.groupBy(group).agg(F.percentile("m", alpha / 2).alias("lo"),
                                F.percentile("m", 1 - alpha / 2).alias("hi"),
                                F.count(F.lit(1)).alias("replicates"))
    return point.join(ci, group)


def date_order_checks(checks: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Rows whose start comes after their end, per named check (one row
    per check: total rows, rows with both dates, rows out of order)."""
    out = None
    for name, (df, start, end) in checks.items():
        both = F.col(start).isNotNull() & F.col(end).isNotNull()
        r = df.agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("n"),
                   F.count_if(both).alias("n_dated"), F.count_if(both & (F.col(start) > F.col(end))).alias("n_bad"))
        out = r if out is None else out.unionByName(r)
    return out

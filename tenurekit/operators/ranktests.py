"""Rank tests: Kruskal–Wallis H (J1) and pairwise Mann–Whitney U.

Ranks come from a value histogram, never from a row-level global sort:
rows are counted per (value, group) (a partial aggregate), the running
count over the *distinct values* gives the mid-rank of each value
(``before + (t + 1) / 2``), and rank sums per group are weighted sums over
the histogram.  The running count is a range-partitioned prefix sum
(``prefix.running_before``) for H; U comes from range-split sums over pairs of groups.  p-values are computed from the few result
rows by a vectorised pandas UDF (chi-square and normal tails in closed form).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .prefix import running_before


def value_histogram(df: DataFrame, group: str, value: str) -> DataFrame:
    return (df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
            .groupBy(F.col(group).cast("string").alias("g"), F.col(value).cast("double").alias("v"))
            .agg(F.count(F.lit(1)).alias("c")))


def kruskal_wallis(df: DataFrame, group: str, value: str) -> DataFrame:
    """H with tie correction, k groups, N, degrees of freedom."""
    h = value_histogram(df, group, value)
    per_v = h.groupBy("v").agg(F.sum("c").alias("t"))
    ranks = running_before(per_v, "v", "t").select("v", "t", (F.col("before") + (F.col("t") + 1) / 2.0).alias("rank"))
    ties = ranks.agg(F.sum(F.pow("t", 3) - F.col("t")).alias("tie"), F.sum("t").alias("n"))
    rs = (h.join(ranks.select("v", "rank"), "v")
          .groupBy("g").agg(F.sum(F.col("c") * F.col("rank")).alias("r"), F.sum("c").alias("ng")))
    s = rs.agg(F.sum(F.col("r") * F.col("r") / F.col("ng")).alias("s"), F.count(F.lit(1)).alias("k"))
    n = ties.select("n").scalar()
    tie = ties.select("tie").scalar()
    raw = F.try_divide(F.lit(12.0), n * (n + 1)) * F.col("s") - 3.0 * (n + 1)
    corr = 1.0 - F.try_divide(tie, F.pow(n, 3) - n)  # 0 when all values tie: no H then
    return s.select(F.col("k").cast("long").alias("k"), n.cast("long").alias("n"),
                    F.try_divide(raw, corr).alias("h"), (F.col("k") - 1).cast("int").alias("df"))


PAIR_CELLS = 1 << 20


def _pair_sums(groups: list[str], pairs: list[tuple[int, int]]):
    """For a range of values in rising order: per pair, twice the sum over the
    range of ca * (cb below in the range + cb / 2), and the tie term.  The range
    is read in blocks of values (a matrix values x groups of bounded size); the
    counts so far are carried from block to block."""
    index = {g: i for i, g in enumerate(groups)}
    a, b = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, pid = len(groups), None
        below = np.zeros(k, np.int64)
        twice, tie = np.zeros(len(pairs), object), np.zeros(len(pairs))
        rest: list[tuple] = []

        def block(v, g, c):
            nonlocal below, twice, tie
            values, row = np.unique(v, return_inverse=True)
            m = np.zeros((len(values), k), np.int64)
            np.add.at(m, (row, g), c)
            upto = below + np.cumsum(m, axis=0) - m
            half = 2 * upto + m
            for i in range(0, len(pairs), max(1, PAIR_CELLS // max(1, len(values)))):
                s = slice(i, i + max(1, PAIR_CELLS // max(1, len(values))))
                ca, cb = m[:, a[s]], m[:, b[s]]
                # products of counts can pass 64 bits only beyond 3 * 10^9 rows a value
                wide = float(ca.max(initial=0)) * float(half.max(initial=0)) * len(values) > 4e18
                twice[s] += (ca.astype(object) * half[:, b[s]] if wide else ca * half[:, b[s]]).sum(axis=0).astype(object)
                t = (ca + cb).astype(float)
                tie[s] += (t ** 3 - t).sum(axis=0)
            below = below + m.sum(axis=0)

        for batch in batches:
            if not batch.num_rows:
                continue
            pid = batch.column("_pid")[0].as_py()
            v, c = batch.column("v").to_numpy(), batch.column("c").to_numpy()
            g = np.array([index[x] for x in batch.column("g").to_pylist()], np.int64)
            if rest:  # the last value of a batch may go on in the next
                v, g, c = (np.concatenate([r, x]) for r, x in zip(rest, (v, g, c)))
            width = max(1, PAIR_CELLS // k)
            start = 0
            last = int(np.searchsorted(v, v[-1], side="left"))
            while start < last:
                end = min(start + width, last)
                end = int(np.searchsorted(v, v[end - 1], side="right")) if end < last else end
                block(v[start:end], g[start:end], c[start:end])
                start = end
            rest = [v[last:], g[last:], c[last:]]
        if rest and len(rest[0]):
            block(*rest)
        if pid is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([pid] * len(pairs), pa.int32()), pa.array([groups[i] for i in a]), pa.array([groups[i] for i in b]),
                 pa.array([Decimal(int(x)) for x in twice], pa.decimal128(38, 0)), pa.array(tie)], ["_pid", "a", "b", "twice", "tie"])
    return run


def mann_whitney_pairs(df: DataFrame, group: str, value: str, pairs: DataFrame | None = None) -> DataFrame:
    """U statistic of group a vs b for every pair (a < b), with the
    tie term needed for the normal approximation.  ``pairs`` (columns a, b)
    restricts the pairs; default all pairs of observed groups.

    The histogram (value, group, count) is split by value into ranges and never
    copied: within a range the pairs are sums over a matrix of counts, across
    ranges they come from the range totals of the groups."""
    spark = df.sparkSession
    h = value_histogram(df, group, value)
    p = int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = cut_lineage(h.repartitionByRange(p, "v").sortWithinPartitions("v", "g").withColumn("_pid", F.spark_partition_id()))
    per = cut_lineage(r.groupBy("_pid", "g").agg(F.sum("c").alias("n")))
    groups = [x["g"] for x in per.select("g").distinct().orderBy("g").collect()]  # the result has a row per pair of them
    known = set(groups)
    wanted = ([(i, j) for i in range(len(groups)) for j in range(i + 1, len(groups))] if pairs is None else
              [(groups.index(x["a"]), groups.index(x["b"])) for x in pairs.select("a", "b").distinct().collect() if x["a"] in known and x["b"] in known])
    schema = "_pid int, a string, b string, twice decimal(38,0), tie double"
    inside = r.mapInArrow(_pair_sums(groups, wanted), schema)
    # what lies in lower ranges: one row per range and group
    w = Window.partitionBy("g").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    span = per.select("g").distinct().select("g", F.explode(F.sequence(F.lit(0), F.lit(p - 1))).alias("_pid"))
    low = span.join(per, ["_pid", "g"], "left").fillna(0, ["n"]).withColumn("lower", F.coalesce(F.sum("n").over(w), F.lit(0)))
    exact = lambda c: c.cast("decimal(19,0)")  # noqa: E731 - products of counts pass a long
    across = inside.select("_pid", "a", "b").join(
        low.select(F.col("_pid").alias("_pa"), F.col("g").alias("_ga"), F.col("n").alias("na")), (F.col("_pid") == F.col("_pa")) & (F.col("a") == F.col("_ga"))).join(
        low.select(F.col("_pid").alias("_pb"), F.col("g").alias("_gb"), F.col("lower")), (F.col("_pid") == F.col("_pb")) & (F.col("b") == F.col("_gb"))).select(
        "a", "b", (2 * exact(F.col("na")) * exact(F.col("lower"))).cast("decimal(38,0)").alias("twice"), F.lit(0.0).alias("tie"))
    u = inside.select("a", "b", "twice", "tie").unionByName(across).groupBy("a", "b").agg(F.sum("twice").alias("twice"), F.sum("tie").alias("tie"))
    n = per.groupBy("g").agg(F.sum("n").cast("long").alias("n"))
    u = (u.join(n.select(F.col("g").alias("a"), F.col("n").alias("n_a")), "a").join(n.select(F.col("g").alias("b"), F.col("n").alias("n_b")), "b"))
    u_a = F.col("twice").cast("double") / 2.0
    return u.select("a", "b", "n_a", "n_b", u_a.alias("u_a"), (F.col("n_a").cast("double") * F.col("n_b") - u_a).alias("u_b"), "tie")


# --- p-values ---------------------------------------------------------------

def _chi2_sf(x: float, k: int) -> float:
    """Upper tail of chi-square with integer df, closed form."""
    if x is None or k is None or (isinstance(x, float) and math.isnan(x)) or k <= 0:
        return float("nan")
    if x <= 0:
        return 1.0
    if k % 2 == 0:
        term, s = 1.0, 1.0
        for i in range(1, k // 2):
            term *= (x / 2.0) / i
            s += term
        return math.exp(-x / 2.0) * s
    s = math.erfc(math.sqrt(x / 2.0))
    term = math.sqrt(2.0 * x / math.pi) * math.exp(-x / 2.0)
    acc = 0.0
    for j in range(1, (k - 1) // 2 + 1):
        acc += term
        term *= x / (2 * j + 1)
    return s + acc


@F.pandas_udf(T.DoubleType())
def chi2_sf(x: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) else _chi2_sf(float(a), int(b)) for a, b in zip(x, k)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def normal_two_sided_p(z: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(v) else math.erfc(abs(v) / math.sqrt(2.0)) for v in z], dtype="float64")


def kruskal_wallis_p(kw: DataFrame) -> DataFrame:
    return kw.withColumn("p_value", chi2_sf(F.col("h"), F.col("df")))


def mann_whitney_p(mw: DataFrame, continuity: bool = True) -> DataFrame:
    """Two-sided p from the normal approximation with tie correction."""
    n1, n2 = F.col("n_a"), F.col("n_b")
    n = n1 + n2
    mu = n1 * n2 / 2.0
    sigma = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.try_divide(F.col("tie"), n * (n - 1))))
    u = F.greatest("u_a", "u_b")
    z = F.try_divide(u - mu - (0.5 if continuity else 0.0), sigma)  # null when all values tie
    return mw.withColumn("z", z).withColumn("p_value", normal_two_sided_p(F.col("z")))


def blocs(df: DataFrame, col: str, mapping: dict[str, list[str]], out: str = "bloc") -> DataFrame:
    """Regroup values into named blocs (e.g. East / West); others dropped."""
    e = None
    for name, vals in mapping.items():
        cond = F.col(col).isin(list(vals))
        e = F.when(cond, F.lit(name)) if e is None else e.when(cond, F.lit(name))
    return df.withColumn(out, e).where(F.col(out).isNotNull())

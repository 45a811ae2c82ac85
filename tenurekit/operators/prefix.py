"""Exclusive running sums over ordered columns without a single-partition
window, and exact quantiles from them.

``repartitionByRange`` splits the (distinct-value) table into P ordered
ranges; a window inside each range gives the local running sum and the range
total; a P-row table of range totals gives each range's offset.  Every
partition holds about 1/P of the values, so the sum never funnels through
one task.  The ranged table is checkpointed, so that local sums and offsets
come from the same split.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def running_before(df: DataFrame, order_col: str | Sequence[str], value_col: str, out: str = "before",
                   partitions: int | None = None) -> DataFrame:
    """Adds ``out`` = sum of ``value_col`` over rows strictly earlier in the
    order of ``order_col`` (one column or several; ties must not occur: use it
    on a table of distinct values)."""
    spark = df.sparkSession
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = df.repartitionByRange(p, *order).withColumn("_pid", F.spark_partition_id())
    local = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    r = cut_lineage(r.withColumns({"_local": F.coalesce(F.sum(value_col).over(local), F.lit(0)),
                                   "_ptot": F.sum(value_col).over(Window.partitionBy("_pid"))}))
    tot = r.groupBy("_pid").agg(F.max("_ptot").alias("_ptot"))
    # offsets over the P-row table of range totals (P is the partition count)
    offs = tot.select("_pid", F.coalesce(F.sum("_ptot").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (r.join(F.broadcast(offs), "_pid")
            .withColumn(out, F.col("_local") + F.col("_off"))
            .drop("_pid", "_local", "_ptot", "_off"))


def running_sums(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], values: dict[str, str],
                 partitions: int | None = None) -> DataFrame:
    """Adds for each (out, value) of ``values`` the sum of ``value`` over the
    rows of the same group that come strictly earlier in ``order`` (ties must
    not occur).  A group is split over ranges like the whole table: its running
    sums are local sums plus the offsets of its earlier ranges, so neither a hot
    group nor an ungrouped table meets in one task."""
    spark = df.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = list(by)
    r = df.repartitionByRange(p, *by, *order).withColumn("_pid", F.spark_partition_id())
    local = Window.partitionBy("_pid", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    r = cut_lineage(r.withColumns({f"_l_{o}": F.coalesce(F.sum(v).over(local), F.lit(0)) for o, v in values.items()}))
    tot = r.groupBy("_pid", *by).agg(*[F.sum(v).alias(f"_t_{o}") for o, v in values.items()])
    earlier = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # a row per range and group
    offs = tot.select(F.col("_pid").alias("_op"), *[F.col(c).alias(f"_o_{i}") for i, c in enumerate(by)],
                      *[F.coalesce(F.sum(f"_t_{o}").over(earlier), F.lit(0)).alias(f"_f_{o}") for o in values])
    same = F.col("_pid") == F.col("_op")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{i}"))
    out = r.join(offs if by else F.broadcast(offs), same)
    return out.withColumns({o: F.col(f"_l_{o}") + F.col(f"_f_{o}") for o in values}).drop(
        "_pid", "_op", *[f"_o_{i}" for i in range(len(by))], *[f"_{k}_{o}" for k in "lf" for o in values])


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles (linear interpolation between ranks): one column for
    each name in ``probs``, one row for each group of ``by`` that has a value.

    Rows are counted by (group, value); running counts over that table, split
    by range, give the ranks, so neither a wide column nor a hot group has to
    fit one task."""
    by = list(by)
    hist = (df.select(*by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
            .groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c")))
    ranked = running_before(hist, [*by, "_v"], "_c", "_before")
    base = ranked.groupBy(*by).agg(F.min("_before").alias("_base"), F.sum("_c").alias("_n"))
    base = base.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], "_base", "_n")
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    if by:
        ranked = ranked.join(base, same)
    else:
        ranked = ranked.withColumns({"_base": F.lit(0), "_n": F.lit(hist.agg(F.sum("_c")).scalar())})
    first = F.col("_before") - F.col("_base")
    aggs = {}
    for name, p in probs.items():
        pos = (F.col("_n") - 1) * F.lit(float(p))
        for end, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            aggs[f"_{end}_{name}"] = F.max(F.when((first <= rank) & (rank < first + F.col("_c")), F.col("_v")))
    got = ranked.groupBy(*by).agg(F.max("_n").alias("_n"), *[v.alias(k) for k, v in aggs.items()])
    out = [((F.col(f"_lo_{k}") + (F.col(f"_hi_{k}") - F.col(f"_lo_{k}")) * ((F.col("_n") - 1) * p - F.floor((F.col("_n") - 1) * p)))).alias(k)
           for k, p in probs.items()]
    return got.select(*by, *out)

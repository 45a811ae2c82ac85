"""Tenure-based analyses: time-weighted modal region and status by recency.

A tenure is (entity, attribute, start date, end date); a null end means that
it is still open and reaches to ``as_of``.  Tenures of one entity may overlap
(loans, academy and main roster), so time is the length of the union of the
intervals, not the sum of their lengths.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def closed(df: DataFrame, start: str, end: str, as_of: Column) -> DataFrame:
    """Tenures that begin by ``as_of``, with ends open or later cut there, as
    ``_s`` and ``_e``.  Tenures without a start, or that end before they start,
    are left out."""
    s = F.col(start).cast("date")
    e = F.least(F.coalesce(F.col(end).cast("date"), as_of), as_of)
    return df.withColumns({"_s": s, "_e": e}).where(F.col("_s").isNotNull() & (F.col("_s") <= F.col("_e")))


def merged_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str, as_of: Column) -> DataFrame:
    """Gaps and islands: the union of each key's intervals as disjoint ones
    (``start``, ``end``, ``days``); intervals that touch are one.

    Rows are first reduced to one per (key, start day) by a partial aggregate,
    so the window of even the hottest key holds no more rows than the calendar
    has days."""
    c = closed(df, start, end, as_of).groupBy(*keys, "_s").agg(F.max("_e").alias("_e"))
    w = Window.partitionBy(*keys).orderBy("_s")
    reach = F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    c = c.withColumn("_new", F.when(reach >= F.col("_s"), 0).otherwise(1))
    c = c.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = c.groupBy(*keys, "_island").agg(F.min("_s").alias("start"), F.max("_e").alias("end"))
    return out.drop("_island").withColumn("days", F.datediff("end", "start").cast("long"))


def modal_by_time(df: DataFrame, entity: str, attr: str, start: str, end: str, as_of: Column) -> DataFrame:
    """Per entity the attribute with most days; ties go to the one that began
    first, then by name.  Blank attributes are unknown and do not count."""
    known = df.where(F.coalesce(F.trim(F.col(attr)), F.lit("")) != "")
    per = merged_intervals(known, [entity, attr], start, end, as_of).groupBy(entity, attr).agg(
        F.sum("days").alias("days"), F.min("start").alias("first_day"), F.count(F.lit(1)).alias("n_periods"))
    best = F.min_by(F.struct(attr, "days", "n_periods"), F.struct(-F.col("days"), F.col("first_day"), F.col(attr)))
    return per.groupBy(entity).agg(best.alias("b"), F.sum("days").alias("total_days"), F.count(F.lit(1)).alias("n_values")).select(
        entity, F.col(f"b.{attr}").alias(f"primary_{attr}"), F.col("b.days").alias("days"), F.col("b.n_periods").alias("n_periods"),
        "total_days", "n_values")


def recency_status(df: DataFrame, entity: str, start: str, end: str, as_of: Column, retired: str | None = None,
                   active_months: int = 6, inactive_months: int = 18) -> DataFrame:
    """Status by the last day of activity: within ``active_months`` Active,
    within ``inactive_months`` Inactive, else Retired; an announced retirement
    (column ``retired``) counts at once.  ``open`` tells of a tenure without end.
    Announcements of entities without a valid tenure do not count."""
    c = closed(df, start, end, as_of)
    said = F.max(F.coalesce(F.col(retired).cast("boolean"), F.lit(False))) if retired else F.lit(False)
    per = c.groupBy(entity).agg(F.max("_e").alias("last_active"), F.max(F.col(end).isNull()).alias("open"), said.alias("_said"))
    per = per.withColumn("_as_of", as_of)
    return per.select(
        entity, "last_active", "open",
        F.when(F.col("_said"), "Retired").when(F.col("last_active") >= F.add_months("_as_of", -active_months), "Active")
         .when(F.col("last_active") >= F.add_months("_as_of", -inactive_months), "Inactive").otherwise("Retired").alias("status"))

"""Entity-panel collapse: one row per entity (F6) with the debut snapshot
(G1/G2) taken inside the same aggregate.

Plan shape: one exchange on the entity key.  Every output column is a
partial-aggregatable expression (``min``, ``max``, ``min_by`` over a total
order), so a hot entity holding a third of all rows is pre-combined on the
map side and never lands in one task as a list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from .rules import assign_tier_region


LONGITUDINAL_COLUMNS = [
    "player", "debut_season", "debut_lol_season", "debut_league", "debut_tier",
    "debut_region", "first_tier1_season", "first_tier1_lol_season", "ever_reached_tier1",
    "promoted_from_tier2", "seasons_to_promotion", "last_season", "censored",
    "debut_year", "first_tier1_year", "seasons_debut_to_first_tier1",
    "right_censored_no_tier1", "last_year_observed",
]


ORDER = "_order"
# follow from the newest period of all, so no part knows them
CENSORING = ("censored", "right_censored_no_tier1")


def debut_order(period: str, split: str, league: str, tiebreak: str) -> Column:
    """Total order of rows within an entity: period, split rank, league
    (nulls last), then the tie-break column (file order)."""
    return F.struct(F.col(period).alias("p"), clean.split_rank(split).alias("sk"),
                    F.col(league).isNull().alias("ln"), F.col(league).alias("l"),
                    F.col(tiebreak).alias("t"))


def build_longitudinal(roster: DataFrame, rules: DataFrame, current_season=None, *,
                       entity: str = "player", period: str = "year", league: str = "league",
                       split: str = "split", tiebreak: str | None = None,
                       null_skipping: bool = False, label_first_year: int | None = None,
                       label_last_year: int | None = None, label_base: int = 2010,
                       debut_extra: tuple[str, ...] = (), keep_order: bool = False) -> DataFrame:
    """debut period/tier/league/region, first tier-1 period, last period,
    promotion flags, right censoring, season labels and alias columns.

    ``current_season`` None -> the latest period in the data (scalar subquery).
    ``tiebreak`` orders rows that tie on (period, split rank, league); default
    is a row-position id taken at scan time.  ``debut_extra`` columns (e.g.
    role) are taken from the same debut row and returned as ``debut_<col>``.
    ``keep_order`` adds the order of the debut row (``_order``, or one
    ``_order_<column>`` per column when nulls are skipped), which
    ``merge_longitudinal`` needs.
    """
    df = roster
    if tiebreak is None and "_line" in df.columns:
        tiebreak = "_line"
    if tiebreak is None:
        df = df.withColumn("_row", F.monotonically_increasing_id())
        tiebreak = "_row"
    df = df.select(entity, period, league, split, tiebreak, *debut_extra)
    df = assign_tier_region(df, league, rules, "tier", "region_m")
    order = debut_order(period, split, league, tiebreak)
    snap_cols = ["tier", league, "region_m", *debut_extra]
    if null_skipping:
        df = df.withColumn("__ord", order)
        snaps = [F.expr(f"min_by(`{c}`, __ord) FILTER (WHERE `{c}` IS NOT NULL)").alias(f"_d_{c}")
                 for c in snap_cols]
        names = [f"{ORDER}_debut_{c}" for c in ("tier", "league", "region", *debut_extra)] if keep_order else []
        snaps += [F.expr(f"min(__ord) FILTER (WHERE `{c}` IS NOT NULL)").alias(n) for c, n in zip(snap_cols, names)]
    else:
        names = [ORDER] if keep_order else []
        snap = F.min_by(F.struct(*[F.col(c) for c in snap_cols], *[order.alias(n) for n in names]), order)
        snaps = [snap.getField(c).alias(f"_d_{c}") for c in snap_cols] + [snap.getField(n).alias(n) for n in names]
    agg = df.groupBy(entity).agg(
        F.min(period).alias("debut_season"),
        *snaps,
        F.min(F.when(F.col("tier") == 1, F.col(period))).alias("first_tier1_season"),
        F.max(period).alias("last_season"),
    )
    if current_season is None:
        cur = roster.agg(F.max(period)).scalar()
    elif isinstance(current_season, Column):
        cur = current_season
    else:
        cur = F.lit(int(current_season))
    lab = dict(first_year=label_first_year, last_year=label_last_year, base=label_base)
    ever = F.col("first_tier1_season").isNotNull()
    censored = (~ever) & (F.col("last_season") >= cur - 1)
    out = agg.select(
        F.col(entity).alias("player"),
        F.col("debut_season").cast("int").alias("debut_season"),
        clean.season_label("debut_season", **lab).alias("debut_lol_season"),
        F.col(f"_d_{league}").alias("debut_league"),
        F.col("_d_tier").cast("int").alias("debut_tier"),
        F.col("_d_region_m").alias("debut_region"),
        F.col("first_tier1_season").cast("int").alias("first_tier1_season"),
        clean.season_label("first_tier1_season", **lab).alias("first_tier1_lol_season"),
        ever.alias("ever_reached_tier1"),
        ((F.col("_d_tier") == 2) & ever).alias("promoted_from_tier2"),
        (F.col("first_tier1_season") - F.col("debut_season")).cast("int").alias("seasons_to_promotion"),
        F.col("last_season").cast("int").alias("last_season"),
        censored.alias("censored"),
        *[F.col(f"_d_{c}").alias(f"debut_{c}") for c in debut_extra],
        *names,
    )
    extra = [*[f"debut_{c}" for c in debut_extra], *names]
    return out.select(
        "*",
        F.col("debut_season").alias("debut_year"),
        F.col("first_tier1_season").alias("first_tier1_year"),
        F.col("seasons_to_promotion").alias("seasons_debut_to_first_tier1"),
        F.col("censored").cast("int").alias("right_censored_no_tier1"),
        F.col("last_season").alias("last_year_observed"),
    ).select(*[c for c in LONGITUDINAL_COLUMNS], *extra)


def merge_longitudinal(parts: DataFrame) -> DataFrame:
    """One panel row per entity from the rows that ``build_longitudinal(...,
    keep_order=True)`` gave for parts of the roster: what it gives for all of
    it, without ``CENSORING``.  A part that comes twice changes nothing."""
    orders = [c for c in parts.columns if c.startswith(ORDER)]
    extra = [c for c in parts.columns if c not in LONGITUDINAL_COLUMNS and c not in orders]
    snap_cols = ["debut_league", "debut_tier", "debut_region", *extra]
    if orders == [ORDER]:
        snap = F.min_by(F.struct(*snap_cols, ORDER), F.col(ORDER))
        snaps = [snap.getField(c).alias(c) for c in (*snap_cols, ORDER)]
    else:  # a part that has only nulls in a column has no order there
        snaps = [F.min_by(c, f"{ORDER}_{c}").alias(c) for c in snap_cols] + [F.min(o).alias(o) for o in orders]
    season = lambda c, label: F.min(F.struct(F.col(c).isNull(), c, label))
    debut, tier1 = season("debut_season", "debut_lol_season"), season("first_tier1_season", "first_tier1_lol_season")
    df = parts.groupBy("player").agg(
        debut.getField("debut_season").alias("debut_season"), debut.getField("debut_lol_season").alias("debut_lol_season"),
        *snaps,
        tier1.getField("first_tier1_season").alias("first_tier1_season"),
        tier1.getField("first_tier1_lol_season").alias("first_tier1_lol_season"),
        F.max("last_season").alias("last_season"))
    ever = F.col("first_tier1_season").isNotNull()
    between = F.col("first_tier1_season") - F.col("debut_season")
    df = df.withColumns({
        "ever_reached_tier1": ever, "promoted_from_tier2": (F.col("debut_tier") == 2) & ever,
        "seasons_to_promotion": between, "debut_year": F.col("debut_season"), "first_tier1_year": F.col("first_tier1_season"),
        "seasons_debut_to_first_tier1": between, "last_year_observed": F.col("last_season")})
    return df.select(*[c for c in LONGITUDINAL_COLUMNS if c not in CENSORING], *extra, *orders)


def debut_attribute(roster: DataFrame, attr: str, *, entity: str = "player",
                    period: str = "year", league: str = "league", split: str = "split",
                    tiebreak: str | None = None, null_skipping: bool = False,
                    out: str | None = None) -> DataFrame:
    """E4 + G2 standalone: ``attr`` of the first row in the entity's debut
    period.  The order starts with the period, so a single ``min_by`` over the
    entity's rows picks a debut-period row; no join back to the panel."""
    out = out or f"debut_{attr}"
    df = roster
    if tiebreak is None:
        df = df.withColumn("_row", F.monotonically_increasing_id())
        tiebreak = "_row"
    rows = df.select(entity, period, league, split, tiebreak, attr)
    order = debut_order(period, split, league, tiebreak)
    if null_skipping:
        rows = rows.withColumn("__ord", order)
        v = F.expr(f"min_by(`{attr}`, __ord) FILTER (WHERE `{attr}` IS NOT NULL)")
    else:
        v = F.min_by(F.col(attr), order)
    return rows.groupBy(entity).agg(v.alias(out)).withColumnRenamed(entity, "player")

"""Cohort reports over the longitudinal panel (F7–F11) and over career
metrics (F12, F13, I1).

All of these aggregate an entity-level table (one row per entity) down to a
handful of rows.  Medians use the exact ``percentile`` aggregate, whose
buffer is a count per *distinct* value — small for season counts whatever
the number of entities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean, maps


def tier2_cohort(longitudinal: DataFrame) -> DataFrame:
    return longitudinal.where(F.col("debut_tier") == 2)


def cohort_headline(longitudinal: DataFrame) -> DataFrame:
    """n tier-2 debuts, n promoted, rate, median seasons to tier 1,
    % of promoted within 2 seasons (of promoted, not of the cohort), n never."""
    t2 = tier2_cohort(longitudinal)
    prom = F.coalesce(F.col("promoted_from_tier2"), F.lit(False))
    s = F.when(prom, F.col("seasons_to_promotion"))
    n_s = F.count(s)
    return t2.agg(
        F.count(F.lit(1)).alias("n_tier2_debut"),
        F.count_if(prom).alias("n_promoted_to_tier1"),
        F.percentile(s, 0.5).alias("_med"),
        n_s.alias("_n_s"),
        F.count_if(prom & (F.col("seasons_to_promotion") <= 2)).alias("_within2"),
    ).select(
        F.col("n_tier2_debut").cast("long").alias("n_tier2_debut"),
        F.col("n_promoted_to_tier1").cast("long").alias("n_promoted_to_tier1"),
        F.coalesce(F.round(100.0 * F.col("n_promoted_to_tier1") / F.col("n_tier2_debut"), 2),
                   F.lit(0.0)).alias("promotion_rate_pct"),
        F.round(F.col("_med"), 2).alias("median_seasons_to_tier1"),
        F.when(F.col("_n_s") > 0, F.round(100.0 * F.col("_within2") / F.col("_n_s"), 1))
         .alias("pct_promoted_within_2_seasons"),
        (F.col("n_tier2_debut") - F.col("n_promoted_to_tier1")).cast("long").alias("n_never_t1"),
    )


def _rate_cols(prom):
    return [F.count(F.lit(1)).cast("long").alias("n"),
            F.count_if(prom).cast("long").alias("promoted")]


def rate_by_league(longitudinal: DataFrame, short_len: int = 28) -> DataFrame:
    """F8 + C15: rate by debut league, null league kept as '(unknown)'."""
    t2 = tier2_cohort(longitudinal)
    prom = F.coalesce(F.col("promoted_from_tier2"), F.lit(False))
    lg = F.coalesce(F.col("debut_league").cast("string"), F.lit("(unknown)"))
    return (t2.groupBy(lg.alias("league")).agg(*_rate_cols(prom))
            .select("league", clean.short_text("league", short_len).alias("league_short"),
                    "n", "promoted",
                    F.round(100.0 * F.col("promoted") / F.col("n"), 2).alias("rate_pct")))


def top_leagues(by_league: DataFrame, k: int = 40) -> DataFrame:
    """The report keeps the k largest leagues (ties by name)."""
    return by_league.orderBy(F.col("n").desc(), F.col("league").asc()).limit(k)


def league_chart(by_league: DataFrame, min_n: int = 2, k: int = 20) -> DataFrame:
    """D5 + G6 + G7: leagues with n >= min_n, the k largest, re-ordered by rate."""
    top = (by_league.where(F.col("n") >= min_n)
           .orderBy(F.col("n").desc(), F.col("league").asc()).limit(k))
    return top.orderBy(F.col("rate_pct").desc(), F.col("n").desc())


def rate_by_role(longitudinal_with_role: DataFrame, role_col: str = "debut_role") -> DataFrame:
    """F9 + E5 + G7: rate by debut role (null -> '(unknown)'), custom order."""
    t2 = tier2_cohort(longitudinal_with_role)
    prom = F.coalesce(F.col("promoted_from_tier2"), F.lit(False))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit("(unknown)"))
    order = F.array(*[F.lit(r) for r in maps.ROLE_REPORT_ORDER])
    pos = F.array_position(order, F.col("role"))
    return (t2.groupBy(role.alias("role")).agg(*_rate_cols(prom))
            .select("role", "n", "promoted",
                    F.round(100.0 * F.col("promoted") / F.col("n"), 2).alias("rate_pct"),
                    F.when(pos > 0, pos).otherwise(F.lit(99)).cast("int").alias("role_rank"))
            .orderBy("role_rank", F.col("n").desc()))


def promotion_histogram(longitudinal: DataFrame, start: int = 1) -> DataFrame:
    """counts of seasons-to-promotion for bins start..max (empty bins
    kept as 0); values below ``start`` fall out (the report counts them apart
    as ``n_zero``)."""
    t2 = tier2_cohort(longitudinal)
    prom = F.coalesce(F.col("promoted_from_tier2"), F.lit(False))
    s = t2.where(prom & F.col("seasons_to_promotion").isNotNull()).select(
        F.col("seasons_to_promotion").alias("s"))
    counts = s.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    bins = (s.agg(F.max("s").alias("mx"))
            .where(F.col("mx").isNotNull())
            .select(F.explode(F.sequence(F.lit(start), F.greatest(F.lit(start), F.col("mx"))))
                    .alias("seasons")))
    return (bins.join(counts, bins.seasons == counts.s, "left")
            .select(F.col("seasons").cast("int"), F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n_players")))


def promoted_detail(longitudinal: DataFrame, short_len: int = 40) -> DataFrame:
    """promoted tier-2 debuts, ordered by seasons taken then name."""
    t2 = tier2_cohort(longitudinal)
    prom = F.coalesce(F.col("promoted_from_tier2"), F.lit(False))
    return (t2.where(prom).select(
        F.col("player"),
        clean.short_text(F.coalesce(F.col("debut_league").cast("string"), F.lit("")), short_len).alias("league"),
        F.col("debut_lol_season").alias("debut_season_label"),
        F.col("first_tier1_lol_season").alias("first_t1_label"),
        F.col("seasons_to_promotion").alias("seasons_taken"),
        F.lit("T2 → T1").alias("tier_path"))
        .orderBy(F.col("seasons_taken").asc_nulls_last(), F.col("player")))


# --- stability / cohort summary over career metrics ------------------------

def stability_frame(careers: DataFrame) -> DataFrame:
    """C8 + C18 + C19 + D6: coerce, default, drop incomplete rows, derive
    team-change proxy, volatility bucket and the survival flags."""
    w = careers.select(
        F.col("player_id"),
        F.col("career_length_years").cast("string").try_cast("double").alias("career_length_years"),
        F.coalesce(F.col("num_teams").cast("string").try_cast("double"), F.lit(1.0)).alias("num_teams"),
        F.coalesce(F.col("starting_tier").cast("string").try_cast("double"), F.lit(2.0)).alias("starting_tier"),
        F.col("career_start_year").cast("string").try_cast("double").alias("career_start_year"),
    ).dropna(subset=["career_length_years", "career_start_year"])
    return w.select(
        "*",
        clean.team_changes("num_teams").alias("team_changes_proxy"),
        clean.volatility_bucket("num_teams").alias("volatility_bucket"),
        (F.col("career_length_years") >= 5).cast("int").alias("survived_5y"),
        (F.col("career_length_years") <= 2).cast("int").alias("early_exit_2y"),
    )


def by_volatility(stab: DataFrame) -> DataFrame:
    """F12 + G7: per bucket n, mean/median years, share surviving 5y, share
    exiting by 2y, mean changes; buckets in their fixed order."""
    order = F.array(*[F.lit(b) for b in maps.VOLATILITY_ORDER])
    return (stab.groupBy("volatility_bucket").agg(
        F.count("player_id").alias("n_players"),
        F.avg("career_length_years").alias("avg_career_years"),
        F.percentile("career_length_years", 0.5).alias("median_career_years"),
        F.avg("survived_5y").alias("pct_survived_5y"),
        F.avg("early_exit_2y").alias("pct_early_exit_2y"),
        F.avg("team_changes_proxy").alias("avg_team_changes_proxy"))
        .withColumn("bucket_rank", F.array_position(order, F.col("volatility_bucket")).cast("int"))
        .orderBy("bucket_rank"))


def by_start_year(stab: DataFrame) -> DataFrame:
    """start-year cohorts."""
    return (stab.groupBy("career_start_year").agg(
        F.count("player_id").alias("n_players"),
        F.avg("team_changes_proxy").alias("avg_team_changes_proxy"),
        F.avg("early_exit_2y").alias("pct_early_exit_2y"),
        F.avg("career_length_years").alias("avg_career_years"))
        .orderBy("career_start_year"))


def cohort_trends(cohorts: DataFrame) -> DataFrame:
    """Unweighted least-squares slope of cohort means on start year
    (0.0 with fewer than two cohorts)."""
    n = F.count(F.lit(1))
    return cohorts.agg(
        F.when(n >= 2, F.regr_slope("avg_team_changes_proxy", "career_start_year")).otherwise(F.lit(0.0))
         .alias("slope_team_changes_per_year"),
        F.when(n >= 2, F.regr_slope("pct_early_exit_2y", "career_start_year")).otherwise(F.lit(0.0))
         .alias("slope_early_exit_per_year"),
        n.cast("long").alias("n_cohorts"))

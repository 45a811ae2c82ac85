"""Step 0: rule tiering and the longitudinal panel on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.panel import build_longitudinal
from ..operators.rules import league_map
from .driver import PANEL_SQL, RULES_SQL, SPLIT_RANK_SQL, driver_panel, driver_rules, latest_period, with_sql
from .registry import register

# Season labels on this panel: 1995 is labelled S6, through 2004.
LABEL_KW = dict(label_first_year=1995, label_last_year=2004, label_base=1989)


def longitudinal(spark, sf_dir, debut_extra=()):
    panel = driver_panel(spark, sf_dir, need=tuple(debut_extra))
    return build_longitudinal(panel, driver_rules(spark), latest_period(spark, sf_dir), entity="entity", period="period",
                              league="league", split="split", tiebreak="row_id",
                              debut_extra=tuple(debut_extra), **LABEL_KW)


def _label(c: str) -> str:
    return f"CASE WHEN {c} BETWEEN 1995 AND 2004 THEN 'S' || CAST({c} - 1989 AS VARCHAR) ELSE '' END"


LONGITUDINAL_CTE = f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY entity
            ORDER BY period, {SPLIT_RANK_SQL}, league IS NULL, league, row_id) AS rn
  FROM tiered
),
per_entity AS (
  SELECT entity, min(period) AS debut_season,
         min(CASE WHEN tier = 1 THEN period END) AS first_tier1_season,
         max(period) AS last_season
  FROM tiered GROUP BY entity
),
longitudinal AS (
  SELECT a.entity AS player,
         CAST(a.debut_season AS INTEGER) AS debut_season,
         {_label('a.debut_season')} AS debut_lol_season,
         s.league AS debut_league,
         CAST(s.tier AS INTEGER) AS debut_tier,
         s.region_m AS debut_region,
         CAST(a.first_tier1_season AS INTEGER) AS first_tier1_season,
         CASE WHEN a.first_tier1_season IS NULL THEN '' ELSE {_label('a.first_tier1_season')} END AS first_tier1_lol_season,
         a.first_tier1_season IS NOT NULL AS ever_reached_tier1,
         s.tier = 2 AND a.first_tier1_season IS NOT NULL AS promoted_from_tier2,
         CAST(a.first_tier1_season - a.debut_season AS INTEGER) AS seasons_to_promotion,
         CAST(a.last_season AS INTEGER) AS last_season,
         a.first_tier1_season IS NULL AND a.last_season >= (SELECT max(period) FROM panel) - 1 AS censored,
         s.role AS debut_role
  FROM per_entity a JOIN ranked s ON s.entity = a.entity AND s.rn = 1
)"""

LONGITUDINAL_SQL = with_sql(PANEL_SQL, RULES_SQL, LONGITUDINAL_CTE) + """
SELECT player, debut_season, debut_lol_season, debut_league, debut_tier, debut_region,
       first_tier1_season, first_tier1_lol_season, ever_reached_tier1, promoted_from_tier2,
       seasons_to_promotion, last_season, censored,
       debut_season AS debut_year, first_tier1_season AS first_tier1_year,
       seasons_to_promotion AS seasons_debut_to_first_tier1,
       CAST(censored AS INTEGER) AS right_censored_no_tier1, last_season AS last_year_observed
FROM longitudinal"""


@register("panel_longitudinal", LONGITUDINAL_SQL, ("C5", "C11", "C12", "G1", "G2", "E3", "F6"))
def q_longitudinal(spark, sf_dir):
    return longitudinal(spark, sf_dir)


@register("rule_league_map", with_sql(PANEL_SQL, RULES_SQL) + """
SELECT league_key AS league, CAST(tier AS INTEGER) AS tier, region FROM league_map""",
          ("A3", "C11"))
def q_league_map(spark, sf_dir):
    panel = driver_panel(spark, sf_dir, need=())
    m = league_map(panel, "league", driver_rules(spark))
    return m.select(F.col("league_key").alias("league"), "tier", "region")

"""Step 3: career tables, workbook variant, model frame, careers from stints,
and the joins between the career tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import maps
from ..operators import careers
from ..sources.tables import read_table
from .driver import PANEL_SQL, RULES_SQL, STATS_SQL, driver_stats, latest_period, with_sql
from .registry import register
from .sqlkit import case_map, mode_cte


def records(spark, sf_dir):
    return careers.career_records(driver_stats(spark, sf_dir), year_base=0,
                                  latest_season=latest_period(spark, sf_dir))


ROLE_SQL = "coalesce(" + case_map("lower(trim(mode_role))", maps.ROLE_ALIASES) + ", 'Unknown')"
COUNTRY_SQL = ("CASE WHEN mode_country IS NULL OR length(mode_country) = 0 THEN 'Unknown' ELSE coalesce("
               + case_map("trim(mode_country)", maps.COUNTRY_CODES)
               + ", CASE WHEN length(trim(mode_country)) >= 2 THEN upper(substr(trim(mode_country), 1, 2)) ELSE 'XX' END) END")
TIER_LETTER_SQL = lambda e: "coalesce(" + case_map(e, maps.TIER_LETTER) + ", 2)"
REGION_SQL = lambda e: "coalesce(" + case_map(e, maps.LEAGUE_REGION) + ", 'Unknown')"

RECORDS_CTE = f"""
base AS (SELECT * FROM stats WHERE player IS NOT NULL),
latest AS (SELECT max(season) AS mx FROM stats),
agg AS (
  SELECT player, min(season) AS fs, max(season) AS ls, count(DISTINCT season) AS ns,
         count(DISTINCT team) AS nt,
         count(DISTINCT CASE WHEN league IS NOT NULL AND league <> '' THEN {REGION_SQL('league')} END) AS nr,
         coalesce(sum(TRY_CAST(trim(games) AS INTEGER)), 0) AS tg,
         avg(TRY_CAST(replace(trim(win_rate), '%', '') AS DOUBLE) / 100.0) AS awr,
         avg(TRY_CAST(kda AS DOUBLE)) AS akda,
         coalesce(bool_or(tier IS NOT NULL AND tier <> '' AND {TIER_LETTER_SQL('tier')} = 1), false) AS ever,
         bool_or(season = (SELECT mx FROM latest)) AS seen_latest,
         bool_or(season = (SELECT mx FROM latest) - 1) AS seen_prev
  FROM base GROUP BY player
),
{mode_cte('mode_role', 'base', 'player', 'role').strip()},
{mode_cte('mode_league', 'base', 'player', 'league').strip()},
{mode_cte('mode_country', 'base', 'player', 'country').strip()},
{mode_cte('mode_tier', 'base', 'player', 'tier').strip()},
rec AS (
  SELECT a.*, r.mode_role, l.mode_league, c.mode_country, t.mode_tier,
         CASE WHEN t.mode_tier IS NULL THEN 2 ELSE {TIER_LETTER_SQL('t.mode_tier')} END AS starting
  FROM agg a LEFT JOIN mode_role r USING (player) LEFT JOIN mode_league l USING (player)
  LEFT JOIN mode_country c USING (player) LEFT JOIN mode_tier t USING (player)
)"""

CAREER_SELECT = f"""
SELECT player AS player_id,
       CASE WHEN mode_league IS NULL THEN 'Unknown' ELSE {REGION_SQL('mode_league')} END AS primary_region,
       coalesce(mode_league, 'Unknown') AS primary_league,
       CAST((ls - fs + 1) * 12 AS INTEGER) AS career_length_months,
       CAST(ls - fs + 1 AS DOUBLE) AS career_length_years,
       CAST(ns AS INTEGER) AS num_seasons_active,
       CASE WHEN starting <> 1 AND ever THEN CAST(12 AS DOUBLE) END AS time_to_tier1_months,
       CAST(CASE WHEN nt = 0 THEN 1 ELSE nt END AS INTEGER) AS num_teams,
       CAST(CASE WHEN nr = 0 THEN 1 ELSE nr END AS INTEGER) AS num_regions,
       starting = 2 AND ever AS promoted_tier2_to_tier1,
       CAST(starting AS INTEGER) AS starting_tier,
       CAST(fs AS INTEGER) AS career_start_year,
       CAST(ls AS INTEGER) AS career_end_year,
       CAST(tg AS BIGINT) AS total_games,
       awr AS avg_winrate, akda AS avg_kda
FROM rec"""
CAREER_SQL = with_sql(PANEL_SQL, RULES_SQL, STATS_SQL, RECORDS_CTE) + CAREER_SELECT
# career_metrics as a CTE named ``cm`` for queries built on top of it
CM_CTES = with_sql(PANEL_SQL, RULES_SQL, STATS_SQL, RECORDS_CTE) + ",\ncm AS (" + CAREER_SELECT + ")"

PLAYERS_SQL = with_sql(PANEL_SQL, RULES_SQL, STATS_SQL, RECORDS_CTE) + f"""
SELECT player AS player_id,
       coalesce({case_map('lower(trim(mode_role))', maps.ROLE_ALIASES)}, 'Unknown') AS primary_role,
       {COUNTRY_SQL} AS nationality,
       CASE WHEN seen_latest THEN 'Active' WHEN seen_prev THEN 'Inactive' ELSE 'Retired' END AS current_status,
       CASE WHEN ever THEN 1 ELSE 2 END AS peak_tier
FROM rec"""


@register("career_metrics", CAREER_SQL, ("A5", "C3", "C4", "C6", "C7", "C8", "F1", "F4"))
def q_career_metrics(spark, sf_dir):
    return careers.career_metrics(records(spark, sf_dir))


@register("players_processed", PLAYERS_SQL, ("C1", "C2", "C17", "F1", "F4"))
def q_players_processed(spark, sf_dir):
    return careers.players_processed(records(spark, sf_dir))


# Careers ⋈ players (inner), then a per-status summary of career length
JOIN_SQL = with_sql(PANEL_SQL, RULES_SQL, STATS_SQL, RECORDS_CTE) + """
SELECT CASE WHEN seen_latest THEN 'Active' WHEN seen_prev THEN 'Inactive' ELSE 'Retired' END AS current_status,
       count(*) AS n_players,
       round(avg(ls - fs + 1), 6) AS mean_career_years
FROM rec GROUP BY 1"""


@register("careers_join_players", JOIN_SQL, ("E1", "E2", "D4"))
def q_join(spark, sf_dir):
    r = records(spark, sf_dir)
    c = careers.career_metrics(r)
    p = careers.players_processed(r)
    j = c.join(p, "player_id", "inner")
    return j.groupBy("current_status").agg(
        F.count(F.lit(1)).alias("n_players"),
        F.round(F.avg("career_length_years"), 6).alias("mean_career_years"))


WORKBOOK_SQL = with_sql(PANEL_SQL, RULES_SQL, STATS_SQL) + f"""
, base AS (SELECT * FROM stats WHERE player IS NOT NULL),
latest AS (SELECT max(season) AS mx FROM stats),
agg AS (
  SELECT player, min(season) AS fs, max(season) AS ls, count(DISTINCT season) AS ns,
         coalesce(sum(TRY_CAST(trim(games) AS INTEGER)), 0) AS tg,
         coalesce(avg(CASE WHEN contains(trim(win_rate), '%') THEN NULL ELSE TRY_CAST(trim(win_rate) AS DOUBLE) END), 0.5) AS awr,
         coalesce(avg(TRY_CAST(kda AS DOUBLE)), 2.0) AS akda,
         arg_min(country, season * 100000000000 + row_no) FILTER (WHERE country IS NOT NULL) AS first_country,
         bool_or(season = (SELECT mx FROM latest)) AS seen_latest,
         bool_or(season = (SELECT mx FROM latest) - 1) AS seen_prev
  FROM base GROUP BY player
),
enr AS (
  SELECT player, team AS e_team, league AS e_league, role AS e_role, tier AS e_tier, country AS e_country FROM (
    SELECT *, row_number() OVER (PARTITION BY player ORDER BY row_no DESC) AS rk FROM base) WHERE rk = 1
),
j AS (
  SELECT a.*, e.*, coalesce({case_map('e.e_tier', {'S': 1, 'A': 2, 'B': 2})}, 2) AS starting
  FROM agg a LEFT JOIN enr e USING (player)
)
SELECT player AS player_id,
       coalesce({case_map("lower(trim(coalesce(e_role, 'Unknown')))", {k: v for k, v in maps.ROLE_ALIASES.items() if k not in maps.ROLE_ALIASES_WORKBOOK_MISSING})}, 'Unknown') AS primary_role,
       {COUNTRY_SQL.replace('mode_country', 'coalesce(e_country, first_country)')} AS nationality,
       CASE WHEN seen_latest THEN 'Active' WHEN seen_prev THEN 'Inactive' ELSE 'Retired' END AS current_status,
       CASE WHEN starting = 1 OR ns >= 3 THEN 1 ELSE 2 END AS peak_tier,
       coalesce({case_map('e_league', {k: maps.LEAGUE_REGION[k] for k in maps.LEAGUE_REGION_WORKBOOK_KEYS})}, 'Unknown') AS primary_region,
       CAST((ls - fs + 1) * 12 AS INTEGER) AS career_length_months,
       CAST(ls - fs + 1 AS DOUBLE) AS career_length_years,
       CASE WHEN starting <> 1 AND ns >= 2 THEN CAST(12 AS DOUBLE) END AS time_to_tier1_months,
       CAST(least(ns, 5) AS INTEGER) AS num_teams,
       1 AS num_regions,
       starting = 2 AND ns >= 3 AS promoted_tier2_to_tier1,
       CAST(starting AS INTEGER) AS starting_tier,
       CAST(fs AS INTEGER) AS career_start_year,
       CAST(tg AS BIGINT) AS total_games,
       awr AS avg_winrate, akda AS avg_kda
FROM j"""


@register("career_metrics_workbook", WORKBOOK_SQL, ("C6", "E8", "F2"))
def q_workbook(spark, sf_dir):
    s = driver_stats(spark, sf_dir)
    # the workbook's plain-number win-rate rule sees text with '%' as missing
    return careers.career_records_workbook(s, s, year_base=0, latest_season=latest_period(spark, sf_dir))


# model frame over the driver panel; the valid vocabularies are the
# priority and segment values (the reference keeps four leagues, five roles).
MODEL_LEAGUES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
MODEL_ROLES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def model_frame(spark, sf_dir):
    s = driver_stats(spark, sf_dir)
    return careers.model_frame(
        s, metrics={"Avg_KDA": ("kda", "number"), "Avg_WR": ("win_rate", "percent")},
        valid_leagues=MODEL_LEAGUES, valid_roles=MODEL_ROLES, era_cutoff=1997,
        max_season=latest_period(spark, sf_dir))


MODEL_SQL = with_sql(PANEL_SQL, RULES_SQL, STATS_SQL) + """
, firsts AS (
  SELECT player,
         arg_min(trim(league), season * 100000000000 + row_no) FILTER (WHERE league IS NOT NULL AND trim(league) <> '') AS league,
         arg_min(trim(role), season * 100000000000 + row_no) FILTER (WHERE role IS NOT NULL AND trim(role) <> '') AS role_raw,
         count(DISTINCT season) AS cs, max(season) AS ls, min(season) AS debut,
         round(avg(TRY_CAST(kda AS DOUBLE)), 3) AS avg_kda,
         round(avg(TRY_CAST(replace(trim(win_rate), '%', '') AS DOUBLE)), 3) AS avg_wr,
         CAST(coalesce(sum(TRY_CAST(games AS DOUBLE)), 0) AS BIGINT) AS tg
  FROM stats GROUP BY player
)
SELECT player AS "Player", CAST(cs AS INTEGER) AS "Career_Seasons",
       CAST(ls <> (SELECT max(season) FROM stats) AS INTEGER) AS "Observed",
       league AS "League", trim(split_part(coalesce(role_raw, ''), ',', 1)) AS "Role",
       CAST(debut AS INTEGER) AS "Debut", CAST(debut <= 1997 AS INTEGER) AS "Early_Era",
       avg_kda AS "Avg_KDA", avg_wr AS "Avg_WR", tg AS "Total_Games"
FROM firsts
WHERE league IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')
  AND trim(split_part(coalesce(role_raw, ''), ',', 1)) IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')"""


@register("model_frame", MODEL_SQL, ("C16", "C20", "D2", "F3", "F5"))
def q_model_frame(spark, sf_dir):
    return model_frame(spark, sf_dir)


STINTS_SQL = """
SELECT o.o_custkey AS player_title, min(CAST(o.o_orderdate AS DATE)) AS career_start,
       max(CAST(e.last_ship AS DATE)) AS career_end, CAST(count(*) AS INTEGER) AS stints_count,
       CAST(date_diff('day', min(CAST(o.o_orderdate AS DATE)), max(CAST(e.last_ship AS DATE))) AS DOUBLE) AS career_days
FROM orders o JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) e
  ON e.l_orderkey = o.o_orderkey
GROUP BY o.o_custkey"""


@register("careers_from_stints", STINTS_SQL, ("F35",))
def q_stints(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_shipdate")
    ends = li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    st = o.join(ends, o.o_orderkey == ends.l_orderkey, "inner").select(
        F.col("o_custkey").alias("player_title"), F.col("o_orderdate").alias("start"),
        F.col("last_ship").alias("end"))
    return careers.careers_from_stints(st)

"""Step 4: movement — mid-season moves, best-tier record, team history,
season-to-season tier change, de-duplication and the stats ⟕ record join."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import movement
from .driver import APPEARANCES_SQL, PANEL_SQL, driver_appearances, with_sql
from .registry import register

APP = with_sql(PANEL_SQL, APPEARANCES_SQL)
RANK = lambda e: (f"CASE {e} WHEN 'S' THEN 1 WHEN 'A' THEN 2 WHEN 'B' THEN 3 WHEN 'C' THEN 4 "  # noqa: E731
                  f"WHEN 'D' THEN 5 WHEN '?' THEN 6 ELSE 7 END")
RANK99 = lambda e: (f"CASE {e} WHEN 'S' THEN 0 WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 "  # noqa: E731
                    f"WHEN 'D' THEN 4 ELSE 99 END")


@register("movement_mid_season", APP + f""",
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player, season, team
                                   ORDER BY league_no, date, row_no) AS rn FROM app) WHERE rn = 1),
ordered AS (SELECT *, row_number() OVER (PARTITION BY player, season ORDER BY date, league_no, row_no) AS pos,
                   count(*) OVER (PARTITION BY player, season) AS n FROM firsts),
per AS (SELECT player, season, max(n) AS n_teams,
               max(CASE WHEN pos = 1 THEN tier END) AS f_tier, max(CASE WHEN pos = 1 THEN league END) AS f_league,
               max(CASE WHEN pos = n THEN tier END) AS l_tier, max(CASE WHEN pos = n THEN league END) AS l_league,
               count(DISTINCT CASE WHEN tier <> '?' THEN tier END) AS n_real
        FROM ordered GROUP BY player, season)
SELECT player, season,
       CASE WHEN n_teams <= 1 THEN ''
            WHEN f_league <> l_league AND f_league <> '?' AND l_league <> '?' THEN 'Transfer'
            WHEN n_real <= 1 THEN 'Roster'
            WHEN {RANK99('l_tier')} < {RANK99('f_tier')} THEN 'Promotion'
            WHEN {RANK99('l_tier')} > {RANK99('f_tier')} THEN 'Relegation'
            ELSE 'Roster' END AS "MidSeasonMove"
FROM per""", ("G4", "C4", "C9"))
def q_moves(spark, sf_dir):
    return movement.detect_moves(driver_appearances(spark, sf_dir, ()))


@register("movement_best_tier", APP + f""",
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player, season
                                  ORDER BY {RANK('tier')}, league_no, date, row_no) AS rn FROM app) WHERE rn = 1),
tf AS (SELECT player, season, team, min(league_no * 100000000000000 + CAST(strftime(CAST(date AS DATE), '%Y%m%d') AS BIGINT) * 1000000 + row_no) AS k
       FROM app GROUP BY player, season, team),
teams AS (SELECT player, season, string_agg(team, ' → ' ORDER BY k) AS "AllTeams" FROM tf GROUP BY player, season)
SELECT b.player, b.season, b.team AS "Team", b.league AS "League", b.role AS "Role", b.tier AS "Tier", t."AllTeams"
FROM best b JOIN teams t USING (player, season)""", ("F32",))
def q_best(spark, sf_dir):
    return movement.best_tier_record(driver_appearances(spark, sf_dir))


@register("movement_team_history", APP + """,
tf AS (SELECT player, season, year, team, min(date) AS fd FROM app GROUP BY 1, 2, 3, 4),
teams AS (SELECT player, season, year, string_agg(team, ' → ' ORDER BY fd, team) AS "Teams" FROM tf GROUP BY 1, 2, 3),
rest AS (SELECT player, season, year,
                array_to_string(list_sort(list_distinct(list(league))), ', ') AS "Leagues",
                arg_min(region, date || '|' || team) FILTER (WHERE region IS NOT NULL) AS "Region",
                arg_min(role, date || '|' || team) FILTER (WHERE role IS NOT NULL) AS "Role"
         FROM app GROUP BY 1, 2, 3)
SELECT * FROM teams JOIN rest USING (player, season, year)""", ("F31",))
def q_history(spark, sf_dir):
    return movement.team_history_summary(driver_appearances(spark, sf_dir))


@register("movement_tier_change", APP + f""",
ps AS (SELECT player, season, arg_max(tier, row_no) AS st FROM app
       WHERE tier IN ('S', 'A', 'B', 'C', 'D', '?') GROUP BY player, season),
pr AS (SELECT player, season, lag({RANK('st')}) OVER (PARTITION BY player ORDER BY season) AS prev_rank FROM ps)
SELECT a.player, a.season, a.row_no, a.tier,
       CASE WHEN a.tier IS NULL OR a.tier NOT IN ('S', 'A', 'B', 'C', 'D', '?') OR pr.prev_rank IS NULL THEN ''
            WHEN {RANK('a.tier')} < pr.prev_rank THEN 'Promoted'
            WHEN {RANK('a.tier')} > pr.prev_rank THEN 'Relegated'
            ELSE 'Stable' END AS "SeasonTierChange"
FROM app a LEFT JOIN pr USING (player, season)""", ("G3", "E9"))
def q_tier_change(spark, sf_dir):
    app = driver_appearances(spark, sf_dir, ()).select("player", "season", "row_no", "tier")
    return movement.tier_changes(app)


@register("movement_dedupe", APP + """
SELECT player, team, season, date, row_no FROM (
  SELECT *, row_number() OVER (PARTITION BY player, team, season ORDER BY date, row_no) AS rn FROM app)
WHERE rn = 1""", ("F33", "H2"))
def q_dedupe(spark, sf_dir):
    app = driver_appearances(spark, sf_dir, ()).select("player", "team", "season", "date", "row_no")
    return movement.dedupe_first(app, ["player", "team", "season"], ["date", "row_no"])


@register("movement_attach_record", APP + f""",
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player, season
                                  ORDER BY {RANK('tier')}, league_no, date, row_no) AS rn FROM app) WHERE rn = 1)
SELECT s.player, s.season, s.row_no, b.team AS "Team", b.tier AS "Tier"
FROM app s LEFT JOIN best b USING (player, season)""", ("E6", "D7"))
def q_attach(spark, sf_dir):
    app = driver_appearances(spark, sf_dir)
    rec = movement.best_tier_record(app).select("player", "season", "Team", "Tier")
    stats = app.select("player", "season", "row_no")
    return movement.attach_team_record(stats, rec)

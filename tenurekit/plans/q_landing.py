"""File landing: queries that read files which Spark wrote from the tables
(A1, A2, A4, A10, C6, C7, C28, D1, H1).

Season numbers are year - 1989 (1995 is season 6).  The season files differ:
games are integers, decimals (numeric file) or text with dashes; win rates are
fractions (numeric file) or percent texts."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..functions import clean
from ..operators import careers
from ..session import cut_lineage
from ..sources import landing as L
from ..streaming.incremental import scratch_dir
from .driver import PANEL_SQL, RULES_SQL, STATS_SQL, driver_panel, driver_stats, with_sql
from .registry import register

BASE_YEAR = 1989

# games as they count: a decimal is cut in a numeric file (season 1 modulo 3);
# in a text file (2 modulo 3) dashes and decimals are skipped
FILES_SQL = with_sql(PANEL_SQL, RULES_SQL, STATS_SQL) + """,
f AS (
  SELECT player, season - 1989 AS s, row_no, team, league, role, tier, country, kda,
         CAST(games AS INTEGER) AS g, CAST(replace(win_rate, '%', '') AS INTEGER) AS w FROM stats),
typed AS (SELECT *, CASE WHEN s % 3 = 2 AND g % 5 < 2 THEN NULL ELSE g END AS games, w / 100.0 AS wr FROM f)"""


def season_folder(spark, sf_dir) -> str:
    """Write one season file (a folder of parts) per season: games by season
    modulo 3 as integers, as decimals (g.5), or as text in which every fifth is
    '-' and every next fifth a decimal; win rate by season modulo 2 as a
    fraction or a percent text; some rows have a blank player."""
    folder = scratch_dir(spark, "seasons")
    s = driver_stats(spark, sf_dir)
    n = F.col("season") - BASE_YEAR
    g = F.col("games").cast("int")
    w = F.regexp_replace("win_rate", "%", "").cast("int")
    games = (F.when(n % 3 == 0, g.cast("string")).when(n % 3 == 1, F.concat(g.cast("string"), F.lit(".5")))
             .otherwise(F.when(g % 5 == 0, "-").when(g % 5 == 1, F.concat(g.cast("string"), F.lit(".0"))).otherwise(g.cast("string"))))
    rate = F.when(n % 2 == 0, (w / 100).cast("string")).otherwise(F.col("win_rate"))
    values = {"Player": F.when(F.col("row_no") % 97 == 0, F.lit(" ")).otherwise(F.col("player")), "Country": F.col("country"), "Games": games,
              "Win rate": rate, "KDA": F.col("kda").cast("string"), "Team": F.col("team"), "League": F.col("league"), "Role": F.col("role"), "Tier": F.col("tier")}
    cols = [values.get(c, F.lit(None).cast("string")).alias(c) for c in L.SEASON_STAT_COLUMNS + L.ENRICHED_EXTRA]
    rows = cut_lineage(s.select(n.alias("_season"), *cols))
    for r in rows.select("_season").distinct().collect():  # one row per season
        rows.where(F.col("_season") == r[0]).drop("_season").write.option("header", True).csv(f"{folder}/player_careers_S{r[0]}.csv")
    return folder


@register("season_files_careers", FILES_SQL + """,
kept AS (SELECT * FROM typed WHERE row_no % 97 <> 0)
SELECT player AS player_id, CAST(min(s) AS INTEGER) AS first_season, CAST(max(s) AS INTEGER) AS last_season, CAST(count(DISTINCT s) AS INTEGER) AS num_seasons_active,
       CAST(greatest(count(DISTINCT team), 1) AS INTEGER) AS num_teams, coalesce(sum(games), 0)::BIGINT AS total_games,
       round(avg(wr), 9) AS avg_winrate, round(avg(kda), 9) AS avg_kda
FROM kept GROUP BY player""", ("A1", "H1", "C6", "C7", "D1"))
def q_season_files(spark, sf_dir):
    df = L.read_season_folder(spark, season_folder(spark, sf_dir))
    r = careers.career_records(df, entity="Player", team="Team", league="League", role="Role", tier="Tier", country="Country",
                               games="Games", win_rate="Win rate", kda="KDA", row_order="_line", year_base=0)
    return r.select("player_id", F.col("career_start_year").alias("first_season"), F.col("career_end_year").alias("last_season"), "num_seasons_active",
                    "num_teams", "total_games", F.round("avg_winrate", 9).alias("avg_winrate"), F.round("avg_kda", 9).alias("avg_kda"))


@register("season_files_kinds", FILES_SQL + """
SELECT CAST(s AS INTEGER) AS season, s % 3 <> 2 OR count_if(g % 5 = 0) = 0 AS games_numeric, s % 2 = 0 AS rate_numeric, count(*) AS n_rows,
       count_if(row_no % 97 = 0)::BIGINT AS n_blank FROM f GROUP BY s""", ("A1", "H1"))
def q_season_kinds(spark, sf_dir):
    """How each season file was read: the kind of its columns, and its rows."""
    df = L.load_season_csvs(spark, L.season_files(spark, season_folder(spark, sf_dir)))
    kinds = L.numeric_columns(df, "season", ["Games", "Win rate"])
    n = df.groupBy("season").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.trim(F.coalesce("Player", F.lit(""))) == "").alias("n_blank"))
    return n.join(kinds, n.season == F.col("_file")).select("season", F.col("_num_0").alias("games_numeric"), F.col("_num_1").alias("rate_numeric"), "n_rows", "n_blank")


@register("roster_file_panel", with_sql(PANEL_SQL) + """
SELECT period AS year, split, count(*) AS n_rows, count(DISTINCT entity) AS n_players, count(DISTINCT team) AS n_teams,
       count(DISTINCT league) AS n_leagues FROM panel WHERE row_id % 89 <> 0 GROUP BY 1, 2""", ("A4", "D1"))
def q_roster_file(spark, sf_dir):
    """Roster CSV with a declared schema; blank player rows are dropped."""
    path = scratch_dir(spark, "roster")
    p = driver_panel(spark, sf_dir, need=("role", "team"))
    p.select(F.when(F.col("row_id") % 89 == 0, F.lit("  ")).otherwise(F.col("entity").cast("string")).alias("player"), F.col("team").cast("string").alias("team"),
             "role", "league", F.col("period").alias("year"), "split", F.lit(None).cast("string").alias("is_starter")).write.option("header", True).csv(path)
    return L.read_roster(spark, path).groupBy("year", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("player").alias("n_players"), F.countDistinct("team").alias("n_teams"),
        F.countDistinct("league").alias("n_leagues"))


@register("sheet_folders_join", with_sql(PANEL_SQL, RULES_SQL, STATS_SQL) + """,
info AS (SELECT player, any_value(role) AS role FROM stats WHERE season >= 1998 GROUP BY player)
SELECT CAST(s.season - 1989 AS INTEGER) AS season, count(*) AS n_rows, count(DISTINCT s.player) AS n_players, count(info.player) AS n_enriched,
       sum(CAST(s.games AS INTEGER))::BIGINT AS games FROM stats s LEFT JOIN info USING (player) GROUP BY 1""", ("A2", "H1"))
def q_sheets(spark, sf_dir):
    """Workbook sheets landed as folders: season sheets and a career sheet that
    enriches them; a sheet of another name is no season."""
    root = scratch_dir(spark, "sheets")
    s = cut_lineage(driver_stats(spark, sf_dir))
    cols = {"Player": F.col("player"), "Country": F.col("country"), "Games": F.col("games"), "Win rate": F.col("win_rate"), "KDA": F.col("kda").cast("string")}
    sheet = [cols.get(c, F.lit(None).cast("string")).alias(c) for c in L.SEASON_STAT_COLUMNS]
    for r in s.select("season").distinct().collect():
        s.where(F.col("season") == r[0]).select(*sheet).write.option("header", True).csv(f"{root}/S{r[0] - BASE_YEAR}")
    s.where(F.col("season") >= 1998).groupBy("player").agg(F.first("role").alias("Role")).withColumnRenamed("player", "Player").write.option("header", True).csv(f"{root}/Career Info")
    s.limit(3).select(*sheet).write.option("header", True).csv(f"{root}/Notes")
    seasons, info = L.load_sheet_dirs(spark, root)
    j = seasons.join(info.select(F.col("Player").alias("_p")), seasons.Player == F.col("_p"), "left")
    return j.groupBy("season").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("Player").alias("n_players"), F.count("_p").alias("n_enriched"),
                                   F.sum(clean.parse_games("Games").cast("long")).alias("games"))


@register("append_new_rows", with_sql(PANEL_SQL) + """
SELECT step, n::BIGINT AS n_appended FROM (
  SELECT 1 AS step, count_if(period <= 1997) AS n FROM panel UNION ALL
  SELECT 2, count_if(period > 1997) FROM panel UNION ALL SELECT 3, 0 UNION ALL SELECT 4, count(*) FROM panel)""", ("A10",))
def q_append(spark, sf_dir):
    """Append the early periods, then everything (only the rest is new), then
    everything again (nothing is); step 4 is what the target holds."""
    target = os.path.join(scratch_dir(spark, "append"), "target")
    rows = driver_panel(spark, sf_dir, need=()).select("entity", "period", "split", "league", "row_id")
    out = None
    for step, part in enumerate((rows.where(F.col("period") <= 1997), rows, rows), 1):
        n = L.append_new_rows(spark, part, target).agg(F.count(F.lit(1)).alias("n_appended")).select(F.lit(step).alias("step"), "n_appended")
        out = n if out is None else out.unionByName(n)
    total = spark.read.parquet(target).agg(F.count(F.lit(1)).alias("n_appended")).select(F.lit(4).alias("step"), "n_appended")
    return out.unionByName(total)


@register("team_list_append", with_sql(PANEL_SQL) + """,
t AS (SELECT entity, CAST(team AS VARCHAR) AS team, min(row_id) AS first_row, period <= 1997 AS early FROM panel WHERE team IS NOT NULL GROUP BY 1, 2, 4),
e AS (SELECT entity, team, first_row FROM t WHERE early),
n AS (SELECT entity, team, first_row FROM t WHERE NOT early AND (entity, team) NOT IN (SELECT (entity, team) FROM e))
SELECT entity, string_agg(team, ' → ' ORDER BY k, first_row) AS teams, count(*) AS n_teams
FROM (SELECT *, 0 AS k FROM e UNION ALL SELECT *, 1 FROM n) GROUP BY entity""", ("C28",))
def q_team_list(spark, sf_dir):
    """Teams of the early periods as flattened text, to which the later teams
    not yet in it are appended, both in first-seen order."""
    p = driver_panel(spark, sf_dir, need=("team",)).where(F.col("team").isNotNull())
    per = p.groupBy("entity", F.col("team").cast("string").alias("team"), (F.col("period") <= 1997).alias("early")).agg(F.min("row_id").alias("first_row"))
    listed = lambda early: F.transform(F.array_sort(F.collect_list(F.when(F.col("early") == early, F.struct("first_row", "team")))), lambda x: x["team"])
    g = per.groupBy("entity").agg(F.array_join(listed(True), " → ").alias("text"), listed(False).alias("later"))
    teams = clean.append_unseen("text", F.col("later"))
    return g.select("entity", F.array_join(teams, " → ").alias("teams"), F.size(teams).cast("long").alias("n_teams"))

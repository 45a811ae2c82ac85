"""Step 1: cohort reports on the longitudinal panel and the stability summary
on career metrics."""

from __future__ import annotations

from ..operators import cohort
from .driver import PANEL_SQL, RULES_SQL, with_sql
from .q_careers import CM_CTES, records
from .q_panel import LONGITUDINAL_CTE, longitudinal
from .registry import register
from ..operators.careers import career_metrics

LONG = with_sql(PANEL_SQL, RULES_SQL, LONGITUDINAL_CTE) + """,
t2 AS (SELECT * FROM longitudinal WHERE debut_tier = 2)"""

SHORT = lambda e, n: (f"CASE WHEN length(trim(coalesce({e}, ''))) > {n} "  # noqa: E731
                      f"THEN substr(trim(coalesce({e}, '')), 1, {n - 1}) || '…' ELSE trim(coalesce({e}, '')) END")


@register("cohort_headline", LONG + """
SELECT CAST(count(*) AS BIGINT) AS n_tier2_debut,
       CAST(count(*) FILTER (WHERE promoted_from_tier2) AS BIGINT) AS n_promoted_to_tier1,
       coalesce(round(100.0 * count(*) FILTER (WHERE promoted_from_tier2) / count(*), 2), 0.0) AS promotion_rate_pct,
       round(quantile_cont(seasons_to_promotion, 0.5) FILTER (WHERE promoted_from_tier2), 2) AS median_seasons_to_tier1,
       CASE WHEN count(seasons_to_promotion) FILTER (WHERE promoted_from_tier2) > 0 THEN
         round(100.0 * count(*) FILTER (WHERE promoted_from_tier2 AND seasons_to_promotion <= 2)
               / count(seasons_to_promotion) FILTER (WHERE promoted_from_tier2), 1) END AS pct_promoted_within_2_seasons,
       CAST(count(*) - count(*) FILTER (WHERE promoted_from_tier2) AS BIGINT) AS n_never_t1
FROM t2""", ("F7", "C26"))
def q_headline(spark, sf_dir):
    return cohort.cohort_headline(longitudinal(spark, sf_dir))


BY_LEAGUE_SELECT = f"""
SELECT league, {SHORT('league', 28)} AS league_short, n, promoted,
       round(100.0 * promoted / n, 2) AS rate_pct
FROM (SELECT coalesce(debut_league, '(unknown)') AS league, CAST(count(*) AS BIGINT) AS n,
             CAST(count(*) FILTER (WHERE promoted_from_tier2) AS BIGINT) AS promoted
      FROM t2 GROUP BY 1)"""


@register("cohort_by_league", LONG + BY_LEAGUE_SELECT, ("F8", "C15"))
def q_by_league(spark, sf_dir):
    return cohort.rate_by_league(longitudinal(spark, sf_dir))


@register("cohort_league_top", LONG + ", bl AS (" + BY_LEAGUE_SELECT + """)
SELECT * FROM bl ORDER BY n DESC, league LIMIT 40""", ("G6",))
def q_league_top(spark, sf_dir):
    return cohort.top_leagues(cohort.rate_by_league(longitudinal(spark, sf_dir)), 40)


@register("cohort_league_chart", LONG + ", bl AS (" + BY_LEAGUE_SELECT + """)
SELECT * FROM (SELECT * FROM bl WHERE n >= 2 ORDER BY n DESC, league LIMIT 20)
ORDER BY rate_pct DESC, n DESC""", ("D5", "G6", "G7"))
def q_league_chart(spark, sf_dir):
    return cohort.league_chart(cohort.rate_by_league(longitudinal(spark, sf_dir)))


@register("cohort_by_role", LONG + """
SELECT role, n, promoted, round(100.0 * promoted / n, 2) AS rate_pct,
       CAST(CASE role WHEN 'Top' THEN 1 WHEN 'Jungle' THEN 2 WHEN 'Mid' THEN 3 WHEN 'Bot' THEN 4
            WHEN 'ADC' THEN 5 WHEN 'Support' THEN 6 WHEN '(unknown)' THEN 7 ELSE 99 END AS INTEGER) AS role_rank
FROM (SELECT coalesce(debut_role, '(unknown)') AS role, CAST(count(*) AS BIGINT) AS n,
             CAST(count(*) FILTER (WHERE promoted_from_tier2) AS BIGINT) AS promoted
      FROM t2 GROUP BY 1)""", ("F9", "E4", "E5", "G2"))
def q_by_role(spark, sf_dir):
    return cohort.rate_by_role(longitudinal(spark, sf_dir, debut_extra=("role",)))


@register("cohort_histogram", LONG + """
, s AS (SELECT seasons_to_promotion AS s FROM t2 WHERE promoted_from_tier2 AND seasons_to_promotion IS NOT NULL)
SELECT CAST(b.seasons AS INTEGER) AS seasons, CAST(coalesce(c.n, 0) AS BIGINT) AS n_players
FROM (SELECT unnest(range(1, greatest(1, max(s)) + 1)) AS seasons FROM s HAVING max(s) IS NOT NULL) b
LEFT JOIN (SELECT s, count(*) AS n FROM s GROUP BY s) c ON c.s = b.seasons""", ("F10",))
def q_hist(spark, sf_dir):
    return cohort.promotion_histogram(longitudinal(spark, sf_dir))


@register("cohort_promoted_detail", LONG + f"""
SELECT player, {SHORT('debut_league', 40)} AS league, debut_lol_season AS debut_season_label,
       first_tier1_lol_season AS first_t1_label, seasons_to_promotion AS seasons_taken,
       'T2 → T1' AS tier_path
FROM t2 WHERE promoted_from_tier2""", ("F11", "C5"))
def q_detail(spark, sf_dir):
    return cohort.promoted_detail(longitudinal(spark, sf_dir))


STAB = CM_CTES + """,
w AS (
  SELECT player_id, career_length_years, CAST(coalesce(num_teams, 1) AS DOUBLE) AS num_teams,
         career_start_year, greatest(0.0, CAST(coalesce(num_teams, 1) AS DOUBLE) - 1.0) AS team_changes_proxy,
         CASE WHEN greatest(0.0, num_teams - 1.0) <= 1 THEN 'Stable (0-1 changes)'
              WHEN greatest(0.0, num_teams - 1.0) <= 2 THEN 'Moderate (2 changes)'
              ELSE 'High (3+ changes)' END AS volatility_bucket,
         CAST(career_length_years >= 5 AS INTEGER) AS survived_5y,
         CAST(career_length_years <= 2 AS INTEGER) AS early_exit_2y
  FROM cm WHERE career_length_years IS NOT NULL AND career_start_year IS NOT NULL
)"""


def stab(spark, sf_dir):
    return cohort.stability_frame(career_metrics(records(spark, sf_dir)))


@register("stability_by_volatility", STAB + """
SELECT volatility_bucket, count(player_id) AS n_players, avg(career_length_years) AS avg_career_years,
       quantile_cont(career_length_years, 0.5) AS median_career_years,
       avg(survived_5y) AS pct_survived_5y, avg(early_exit_2y) AS pct_early_exit_2y,
       avg(team_changes_proxy) AS avg_team_changes_proxy,
       CAST(CASE volatility_bucket WHEN 'Stable (0-1 changes)' THEN 1 WHEN 'Moderate (2 changes)' THEN 2 ELSE 3 END AS INTEGER) AS bucket_rank
FROM w GROUP BY volatility_bucket""", ("C8", "C18", "C19", "D6", "F12"))
def q_volatility(spark, sf_dir):
    return cohort.by_volatility(stab(spark, sf_dir))


START_SELECT = """
SELECT CAST(career_start_year AS DOUBLE) AS career_start_year, count(player_id) AS n_players,
       avg(team_changes_proxy) AS avg_team_changes_proxy, avg(early_exit_2y) AS pct_early_exit_2y,
       avg(career_length_years) AS avg_career_years
FROM w GROUP BY career_start_year"""


@register("stability_by_start_year", STAB + START_SELECT, ("F13",))
def q_start(spark, sf_dir):
    return cohort.by_start_year(stab(spark, sf_dir))


@register("stability_trends", STAB + ", c AS (" + START_SELECT + """)
SELECT CASE WHEN count(*) >= 2 THEN regr_slope(avg_team_changes_proxy, career_start_year) ELSE 0.0 END AS slope_team_changes_per_year,
       CASE WHEN count(*) >= 2 THEN regr_slope(pct_early_exit_2y, career_start_year) ELSE 0.0 END AS slope_early_exit_per_year,
       CAST(count(*) AS BIGINT) AS n_cohorts
FROM c""", ("I1",))
def q_trends(spark, sf_dir):
    return cohort.cohort_trends(cohort.by_start_year(stab(spark, sf_dir)))


@register("cohort_summary_report", None, ("A9", "F7", "F8", "F9", "F10", "G6"))
def q_summary_report(spark, sf_dir):
    """The promotion-cohort payload as one JSON document: sizes, headline,
    league table (40 largest), role table and time histogram (as a map).
    Only bounded parts go into the single document; the promoted-entity
    list grows with the data and is served as rows by
    ``cohort_promoted_detail`` instead of being packed into one value."""
    from pyspark.sql import functions as F
    from ..sources.landing import report_json
    from .driver import driver_panel
    lon = longitudinal(spark, sf_dir, debut_extra=("role",))
    panel = driver_panel(spark, sf_dir, need=())
    by_league = cohort.rate_by_league(lon)
    sizes = panel.agg(F.count(F.lit(1)).alias("n_roster_rows")).select(
        "n_roster_rows",
        lon.agg(F.count(F.lit(1))).scalar().alias("n_unique_players_panel"),
        by_league.agg(F.count(F.lit(1))).scalar().alias("n_debut_leagues_distinct"))
    # 0-season promotions fall outside the 1..max histogram; count them beside it
    n_zero = (cohort.tier2_cohort(lon).where(F.col("promoted_from_tier2") & (F.col("seasons_to_promotion") < 1))
              .agg(F.count(F.lit(1))).scalar())
    head = cohort.cohort_headline(lon).withColumn("n_promoted_outside_histogram", n_zero)
    hist = cohort.promotion_histogram(lon).agg(
        F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("seasons", "n_players"))),
                                       lambda x: F.struct(x["seasons"].cast("string"), x["n_players"])))
        .alias("time_histogram"))
    top = cohort.top_leagues(by_league, 40).withColumn(
        "_ord", F.struct(-F.col("n"), F.col("league")))
    roles = cohort.rate_by_role(lon).withColumn("_ord", F.struct("role_rank", -F.col("n"))).drop("role_rank")
    return report_json({"sizes": sizes, "summary": head, "time_histogram": hist,
                        "league_table": top, "role_table": roles})

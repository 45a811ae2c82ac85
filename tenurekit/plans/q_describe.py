"""Step 5: descriptive statistics on the careers view (career records ⟕
customer dimension) and on the stats panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import maps
from ..operators import describe as D
from .driver import PANEL_SQL, RULES_SQL, STATS_SQL, dims, driver_stats, with_sql
from .q_careers import RECORDS_CTE, records
from .registry import register
from ..sources.tables import read_table


def r6(df: DataFrame) -> DataFrame:
    """Round every double column to 6 digits (oracle comparison)."""
    return df.select(*[F.round(F.col(f.name), 6).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def sql_r6(sql: str, cols: list[str]) -> str:
    rep = ", ".join(f'round("{c}", 6) AS "{c}"' for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS t"


def careers_view(spark, sf_dir):
    """Career records ⟕ customer dimension (segment, nation, region)."""
    rec = records(spark, sf_dir)
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    d = dims(spark, sf_dir)
    cd = c.join(d, c.c_nationkey == d.n_nationkey, "left").select(
        F.col("c_custkey").cast("string").alias("player_id"),
        F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
    return rec.join(cd, "player_id", "left")


CV = with_sql(PANEL_SQL, RULES_SQL, STATS_SQL, RECORDS_CTE) + """,
cv AS (
  SELECT r.player AS player_id,
         CAST(ls - fs + 1 AS DOUBLE) AS career_length_years,
         CAST((ls - fs + 1) * 12 AS INTEGER) AS career_length_months,
         CAST(CASE WHEN nt = 0 THEN 1 ELSE nt END AS INTEGER) AS num_teams,
         CAST(CASE WHEN nr = 0 THEN 1 ELSE nr END AS INTEGER) AS num_regions,
         CAST(starting AS INTEGER) AS starting_tier, CAST(fs AS INTEGER) AS career_start_year,
         CAST(tg AS BIGINT) AS total_games, awr AS avg_winrate, akda AS avg_kda,
         starting = 2 AND ever AS promoted_tier2_to_tier1,
         CASE WHEN seen_latest THEN 'Active' WHEN seen_prev THEN 'Inactive' ELSE 'Retired' END AS current_status,
         CASE WHEN starting <> 1 AND ever THEN CAST(12 AS DOUBLE) END AS time_to_tier1_months,
         coalesce(mode_league, 'Unknown') AS primary_league,
         c.c_mktsegment AS segment, n.n_name AS nation, rg.r_name AS region
  FROM rec r LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = r.player
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region rg ON n.n_regionkey = rg.r_regionkey
)"""


def reg(name, sql, covers, round_cols=()):
    if sql is not None and round_cols:
        sql = sql_r6(sql, list(round_cols))
    return register(name, sql, covers)


@reg("describe_group_stats", CV + """
SELECT region, avg(career_length_years) AS mean, quantile_cont(career_length_years, 0.5) AS median,
       stddev_samp(career_length_years) AS std, count(career_length_years) AS count
FROM cv GROUP BY region""", ("F14",), ("mean", "median", "std"))
def q_group_stats(spark, sf_dir):
    return r6(D.group_stats(careers_view(spark, sf_dir), "region", "career_length_years"))


@reg("describe_league_summary", CV + """
SELECT primary_league, avg(avg_kda) AS mean, quantile_cont(avg_kda, 0.5) AS median,
       stddev_samp(avg_kda) AS std, count(avg_kda) AS count, quantile_cont(avg_kda, 0.75) AS p75
FROM cv GROUP BY primary_league""", ("F15",), ("mean", "median", "std", "p75"))
def q_league_summary(spark, sf_dir):
    return r6(D.group_stats(careers_view(spark, sf_dir), "primary_league", "avg_kda", quantiles=(0.75,)))


@reg("describe_scalar_summary", CV + """
SELECT avg(career_length_years) AS mean, quantile_cont(career_length_years, 0.5) AS median,
       stddev_samp(career_length_years) AS std, min(career_length_years) AS min, max(career_length_years) AS max,
       skewness(career_length_years) AS skew,
       quantile_cont(career_length_years, 0.75) - quantile_cont(career_length_years, 0.25) AS iqr,
       count(*) AS n,
       100.0 * avg(CAST(current_status = 'Active' AS DOUBLE)) AS active_pct,
       100.0 * avg(CAST(current_status = 'Retired' AS DOUBLE)) AS retired_pct
FROM cv""", ("F16", "F21"), ("mean", "median", "std", "min", "max", "skew", "iqr", "active_pct", "retired_pct"))
def q_scalar(spark, sf_dir):
    return r6(D.scalar_summary(careers_view(spark, sf_dir), "career_length_years", "current_status"))


DESC_COLS = ["career_length_years", "num_teams", "total_games", "avg_kda"]


@reg("describe_columns", CV + """, long AS (
  UNPIVOT (SELECT CAST(career_length_years AS DOUBLE) AS career_length_years, CAST(num_teams AS DOUBLE) AS num_teams,
                  CAST(total_games AS DOUBLE) AS total_games, CAST(avg_kda AS DOUBLE) AS avg_kda FROM cv)
  ON career_length_years, num_teams, total_games, avg_kda INTO NAME "column" VALUE value)
SELECT "column", count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
       quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75,
       max(value) AS max
FROM long GROUP BY "column\"""", ("F17",), ("mean", "std", "min", "p25", "p50", "p75", "max"))
def q_describe(spark, sf_dir):
    return r6(D.describe(careers_view(spark, sf_dir), DESC_COLS))


@reg("describe_value_counts", CV + """
SELECT segment, count(*) AS count FROM cv GROUP BY segment""", ("F18",))
def q_vc(spark, sf_dir):
    return D.value_counts(careers_view(spark, sf_dir), "segment")


@reg("describe_top_nations", CV + """
SELECT nation, count(*) AS count FROM cv GROUP BY nation ORDER BY count DESC, nation LIMIT 10""", ("F18", "G6"))
def q_top_nations(spark, sf_dir):
    return D.value_counts(careers_view(spark, sf_dir), "nation", top_k=10)


MISSING_COLS = ["avg_winrate", "avg_kda", "time_to_tier1_months", "segment", "region"]


@reg("describe_missing", CV + """, long AS (
  UNPIVOT (SELECT count(*) AS _n,
                  count(*) FILTER (WHERE avg_winrate IS NULL) AS avg_winrate,
                  count(*) FILTER (WHERE avg_kda IS NULL) AS avg_kda,
                  count(*) FILTER (WHERE time_to_tier1_months IS NULL) AS time_to_tier1_months,
                  count(*) FILTER (WHERE segment IS NULL) AS segment,
                  count(*) FILTER (WHERE region IS NULL) AS region FROM cv)
  ON avg_winrate, avg_kda, time_to_tier1_months, segment, region INTO NAME "column" VALUE missing)
SELECT "column", CAST(missing AS BIGINT) AS missing, round(100.0 * missing / _n, 2) AS percent FROM long""",
     ("F19",))
def q_missing(spark, sf_dir):
    return D.missing_report(careers_view(spark, sf_dir), MISSING_COLS)


@reg("describe_duplicates", CV + """
SELECT count(*) - count(DISTINCT player_id) AS duplicate_keys, count(DISTINCT region) AS n_distinct
FROM cv""", ("F20",))
def q_dups(spark, sf_dir):
    return D.duplicate_report(careers_view(spark, sf_dir), "player_id", "region")


@reg("describe_distinct_values", CV + """
SELECT DISTINCT nation FROM cv ORDER BY nation""", ("F20",))
def q_distinct(spark, sf_dir):
    return D.distinct_values(careers_view(spark, sf_dir), "nation")


CORR_COLS = ["career_length_months", "num_teams", "num_regions", "starting_tier", "career_start_year"]


def _corr(a, b):
    x, y = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    return (f"CASE WHEN stddev_samp({x}) FILTER (WHERE {y} IS NOT NULL) > 0 "
            f"AND stddev_samp({y}) FILTER (WHERE {x} IS NOT NULL) > 0 THEN corr({x}, {y}) END")


def _corr_sql():
    parts = []
    for a in CORR_COLS:
        for b in CORR_COLS:
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {_corr(a, b)} AS corr FROM cv")
    return CV + "\n" + "\nUNION ALL\n".join(parts)


@reg("describe_correlations", _corr_sql(), ("F22",), ("corr",))
def q_corr(spark, sf_dir):
    return r6(D.correlations(careers_view(spark, sf_dir), CORR_COLS))


@reg("describe_corr_ranked", CV + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{b}' AS \"column\", {_corr('career_length_years', b)} AS corr FROM cv"
    for b in ["num_teams", "total_games", "avg_kda", "career_start_year"]), ("F22",), ("corr",))
def q_corr_ranked(spark, sf_dir):
    return r6(D.correlations_with(careers_view(spark, sf_dir), "career_length_years",
                                  ["num_teams", "total_games", "avg_kda", "career_start_year"]))


EDGES = [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 8.0]


@reg("describe_histogram_fixed", CV + """, b AS (
  SELECT CASE WHEN career_length_years >= 0 AND career_length_years < 1 THEN 0
              WHEN career_length_years >= 1 AND career_length_years < 2 THEN 1
              WHEN career_length_years >= 2 AND career_length_years < 3 THEN 2
              WHEN career_length_years >= 3 AND career_length_years < 4 THEN 3
              WHEN career_length_years >= 4 AND career_length_years < 5 THEN 4
              WHEN career_length_years >= 5 AND career_length_years < 6 THEN 5
              WHEN career_length_years >= 6 AND career_length_years <= 8 THEN 6 END AS bin FROM cv)
SELECT bin, CAST([0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 8.0][bin + 1] AS DOUBLE) AS lo,
       CAST([0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 8.0][bin + 2] AS DOUBLE) AS hi, count(*) AS count
FROM b WHERE bin IS NOT NULL GROUP BY bin""", ("F23",))
def q_hist_fixed(spark, sf_dir):
    return D.histogram_fixed(careers_view(spark, sf_dir), "career_length_years", EDGES)


@reg("describe_histogram_width", CV + """, rng AS (SELECT min(avg_kda) AS lo, max(avg_kda) AS hi FROM cv),
b AS (SELECT CASE WHEN hi = lo THEN 0 ELSE least(CAST(floor((avg_kda - lo) / ((hi - lo) / 10)) AS INTEGER), 9) END AS bin
      FROM cv, rng WHERE avg_kda IS NOT NULL)
SELECT bin, lo + bin * ((hi - lo) / 10) AS lo, lo + (bin + 1) * ((hi - lo) / 10) AS hi, count(*) AS count
FROM b, rng GROUP BY bin, rng.lo, rng.hi""", ("F23",), ("lo", "hi"))
def q_hist_width(spark, sf_dir):
    return r6(D.histogram_equal_width(careers_view(spark, sf_dir), "avg_kda", 10))


@reg("describe_box_stats", CV + """, q AS (
  SELECT segment, quantile_cont(avg_kda, 0.25) AS q1, quantile_cont(avg_kda, 0.5) AS median,
         quantile_cont(avg_kda, 0.75) AS q3 FROM cv GROUP BY segment),
j AS (SELECT cv.segment, avg_kda AS v, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS hf
      FROM cv JOIN q ON cv.segment = q.segment)
SELECT segment, q1, median, q3, min(CASE WHEN v >= lf AND v <= hf THEN v END) AS whisker_low,
       max(CASE WHEN v >= lf AND v <= hf THEN v END) AS whisker_high,
       count(*) FILTER (WHERE NOT (v >= lf AND v <= hf)) AS n_outliers, count(v) AS n, q3 - q1 AS iqr
FROM j GROUP BY segment, q1, median, q3""", ("F24",), ("q1", "median", "q3", "whisker_low", "whisker_high", "iqr"))
def q_box(spark, sf_dir):
    return r6(D.box_stats(careers_view(spark, sf_dir), "segment", "avg_kda"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@reg("describe_pivot", CV + "\nSELECT region, " + ", ".join(
    f"avg(career_length_years) FILTER (WHERE segment = '{s}') AS \"{s}\"" for s in SEGMENTS)
    + " FROM cv GROUP BY region", ("F25",), tuple(SEGMENTS))
def q_pivot(spark, sf_dir):
    return r6(D.pivot_mean(careers_view(spark, sf_dir), "region", "segment", "career_length_years", SEGMENTS))


@reg("describe_promotion_by_region", CV + """, per AS (
  SELECT CAST(region AS VARCHAR) AS "group", 100.0 * avg(CAST(promoted_tier2_to_tier1 AS DOUBLE)) AS rate_pct,
         count(*) AS n FROM cv GROUP BY region),
allr AS (SELECT '(all)' AS "group", 100.0 * avg(CAST(promoted_tier2_to_tier1 AS DOUBLE)) AS rate_pct, count(*) AS n FROM cv),
bw AS (SELECT arg_max("group", (rate_pct, "group")) AS best, arg_min("group", (rate_pct, "group")) AS worst FROM per)
SELECT u.*, u."group" = bw.best AS is_best, u."group" = bw.worst AS is_worst
FROM (SELECT * FROM per UNION ALL SELECT * FROM allr) u, bw""", ("F26", "C23"), ("rate_pct",))
def q_promo_region(spark, sf_dir):
    return r6(D.promotion_by_group(careers_view(spark, sf_dir), "region", "promoted_tier2_to_tier1"))


@reg("describe_entries_per_year", CV + """
SELECT career_start_year, count(*) AS n_entrants,
       avg(CASE WHEN current_status = 'Retired' THEN career_length_years END) AS mean_length_retired
FROM cv GROUP BY career_start_year""", ("F27", "D4"), ("mean_length_retired",))
def q_entries(spark, sf_dir):
    return r6(D.entries_per_year(careers_view(spark, sf_dir), "career_start_year", "current_status",
                                 "career_length_years"))


NORM = ["career_length_years", "num_teams", "avg_kda"]


@reg("describe_normalized_means", CV + """, m AS (
  SELECT region, avg(career_length_years) AS a, avg(num_teams) AS b, avg(avg_kda) AS c FROM cv GROUP BY region)
SELECT region, a AS career_length_years_mean,
       CASE WHEN max(a) OVER () > min(a) OVER () THEN (a - min(a) OVER ()) / (max(a) OVER () - min(a) OVER ()) END AS career_length_years_norm,
       b AS num_teams_mean,
       CASE WHEN max(b) OVER () > min(b) OVER () THEN (b - min(b) OVER ()) / (max(b) OVER () - min(b) OVER ()) END AS num_teams_norm,
       c AS avg_kda_mean,
       CASE WHEN max(c) OVER () > min(c) OVER () THEN (c - min(c) OVER ()) / (max(c) OVER () - min(c) OVER ()) END AS avg_kda_norm
FROM m""", ("F28",), tuple(f"{m}_{k}" for m in NORM for k in ("mean", "norm")))
def q_norm(spark, sf_dir):
    return r6(D.normalized_group_means(careers_view(spark, sf_dir), "region", NORM))


@reg("describe_time_to_event", CV + """
SELECT region, avg(time_to_tier1_months) AS mean_time, count(time_to_tier1_months) AS n
FROM cv WHERE time_to_tier1_months IS NOT NULL GROUP BY region""", ("F29", "D8"), ("mean_time",))
def q_tte(spark, sf_dir):
    return r6(D.mean_time_to_event(careers_view(spark, sf_dir), "time_to_tier1_months", "region"))


@reg("describe_consistency", with_sql(PANEL_SQL, RULES_SQL, STATS_SQL, RECORDS_CTE) + f"""
SELECT count(*) AS n, count(*) FILTER (WHERE ls - fs + 1 <= 0) AS non_positive_length,
       count(*) FILTER (WHERE starting = 1 AND (starting = 2 AND ever)) AS tier1_start_flagged_promoted,
       round(100.0 * count(*) FILTER (WHERE coalesce(mode_role, '') <> '' AND lower(trim(mode_role)) IN
             ({", ".join("'" + k + "'" for k in maps.ROLE_ALIASES)})) / count(*), 2) AS known_role_pct,
       round(100.0 * count(*) FILTER (WHERE mode_league IN
             ({", ".join("'" + k + "'" for k in maps.LEAGUE_REGION)})) / count(*), 2) AS known_region_pct
FROM rec""", ("F30",))
def q_consistency(spark, sf_dir):
    return D.consistency_report(records(spark, sf_dir))


@reg("describe_seasons_covered", with_sql(PANEL_SQL, RULES_SQL, STATS_SQL) + """
SELECT player, array_to_string(list_sort(list_distinct(list(season))), ',') AS seasons,
       count(DISTINCT season) AS n_seasons
FROM stats GROUP BY player""", ("F30",))
def q_seasons(spark, sf_dir):
    return D.seasons_covered(driver_stats(spark, sf_dir), "player", "season")


EAST = ["ASIA", "MIDDLE EAST"]
WEST = ["EUROPE", "AMERICA"]


@reg("describe_east_west", CV + """
SELECT CASE WHEN region IN ('ASIA', 'MIDDLE EAST') THEN 'East' WHEN region IN ('EUROPE', 'AMERICA') THEN 'West'
            ELSE 'Other' END AS bloc, avg(career_length_years) AS mean, count(career_length_years) AS n
FROM cv GROUP BY 1""", ("F34",), ("mean",))
def q_east_west(spark, sf_dir):
    return r6(D.east_west(careers_view(spark, sf_dir), "region", "career_length_years", EAST, WEST))


@reg("describe_length_distribution", CV + """
SELECT career_length_years, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM cv), 4) AS pct,
       round(100.0 * (SELECT count(*) FROM cv WHERE career_length_years <= 3) / (SELECT count(*) FROM cv), 4) AS pct_le_3
FROM cv GROUP BY career_length_years""", ("F36",))
def q_lendist(spark, sf_dir):
    return D.length_distribution(careers_view(spark, sf_dir), "career_length_years")


@reg("describe_long_share_by_league", CV + """
SELECT primary_league, round(100.0 * avg(CAST(career_length_years >= 5 AS DOUBLE)), 4) AS pct_ge_5, count(*) AS n
FROM cv GROUP BY primary_league""", ("F36",))
def q_long_share(spark, sf_dir):
    return D.long_career_share(careers_view(spark, sf_dir), "primary_league", "career_length_years")


@reg("describe_profile", None, ("F37",))
def q_profile(spark, sf_dir):
    return D.table_profile(careers_view(spark, sf_dir))


@reg("describe_gated_group_stats", CV + """
SELECT segment, avg(avg_kda) AS mean, quantile_cont(avg_kda, 0.5) AS median, stddev_samp(avg_kda) AS std,
       count(avg_kda) AS count
FROM cv WHERE segment <> 'Unknown' GROUP BY segment
HAVING (SELECT count(*) FROM cv WHERE segment <> 'Unknown') >= 50""", ("D3",), ("mean", "median", "std"))
def q_gated(spark, sf_dir):
    return r6(D.gated_group_stats(careers_view(spark, sf_dir), "segment", "avg_kda"))


@reg("describe_veterans", CV + """
SELECT primary_league, count(*) AS n FROM cv WHERE career_length_years >= 7 GROUP BY primary_league""", ("D9",))
def q_veterans(spark, sf_dir):
    return D.veterans(careers_view(spark, sf_dir), "career_length_years").groupBy("primary_league").agg(
        F.count(F.lit(1)).alias("n"))


@reg("describe_survival_steps", CV + """, c AS (
  SELECT segment, career_length_months AS t, count(*) AS n_at FROM cv WHERE career_length_months IS NOT NULL GROUP BY 1, 2),
w AS (SELECT *, coalesce(sum(n_at) OVER (PARTITION BY segment ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             sum(n_at) OVER (PARTITION BY segment) AS n FROM c)
SELECT segment, t AS career_length_months, n_at, (n - before) / n AS surv_first, (n - before - n_at + 1) / n AS surv_last
FROM w""", ("G5",), ("surv_first", "surv_last"))
def q_surv(spark, sf_dir):
    return r6(D.survival_steps(careers_view(spark, sf_dir), "career_length_months", "segment"))

"""Career tables under known names, and the report payloads (A9, I15) with the
model bundle (A11) behind them.

The oracles state role, region and country values literally."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bundle as B, careers, models as M, reports, score as S
from ..session import cut_lineage
from ..streaming.incremental import scratch_dir
from .driver import NAMED_SQL, PANEL_SQL, RULES_SQL, STATS_SQL, driver_stats_named, latest_period, with_sql
from .q_careers import MODEL_LEAGUES, MODEL_ROLES, RECORDS_CTE, REGION_SQL
from .q_cohort import STAB, START_SELECT, stab
from .q_models import (COX_FEATURES, MF_CTE, NUMERIC, REF_LEAGUE, REF_ROLE, RF_FEATURES, SPLIT_SQL, requests,
                       split_frame)
from .registry import register


# ---- F1 with roles, regions and countries that differ -----------------------

def named_records(spark, sf_dir):
    return careers.career_records(driver_stats_named(spark, sf_dir), year_base=0, latest_season=latest_period(spark, sf_dir))


def _region(e):
    return f"CASE {e} WHEN 'LCK' THEN 'LCK' WHEN 'EU LCS' THEN 'LEC' WHEN 'NALCS' THEN 'LCS' WHEN 'LMS' THEN 'PCS' ELSE 'Unknown' END"


NAMED_CTES = with_sql(PANEL_SQL, RULES_SQL, STATS_SQL, NAMED_SQL,
                      RECORDS_CTE.replace(REGION_SQL("league"), _region("league")).replace("FROM stats", "FROM named"))

NAMED_CAREERS = f"""
SELECT player AS player_id, CASE WHEN mode_league IS NULL THEN 'Unknown' ELSE {_region('mode_league')} END AS primary_region,
       coalesce(mode_league, 'Unknown') AS primary_league, CAST((ls - fs + 1) * 12 AS INTEGER) AS career_length_months,
       CAST(ls - fs + 1 AS DOUBLE) AS career_length_years, CAST(ns AS INTEGER) AS num_seasons_active,
       CASE WHEN starting <> 1 AND ever THEN CAST(12 AS DOUBLE) END AS time_to_tier1_months,
       CAST(greatest(nt, 1) AS INTEGER) AS num_teams, CAST(greatest(nr, 1) AS INTEGER) AS num_regions,
       starting = 2 AND ever AS promoted_tier2_to_tier1, CAST(starting AS INTEGER) AS starting_tier,
       CAST(fs AS INTEGER) AS career_start_year, CAST(ls AS INTEGER) AS career_end_year, CAST(tg AS BIGINT) AS total_games,
       awr AS avg_winrate, akda AS avg_kda
FROM rec"""
NAMED_PLAYERS = """
SELECT player AS player_id,
       CASE lower(trim(mode_role)) WHEN 'top' THEN 'Top' WHEN 'jng' THEN 'Jungle' WHEN 'middle' THEN 'Mid' WHEN 'ad carry' THEN 'ADC' ELSE 'Unknown' END AS primary_role,
       CASE WHEN mode_country IS NULL THEN 'Unknown'
            ELSE CASE trim(mode_country) WHEN 'South Korea' THEN 'KR' WHEN 'China' THEN 'CN' WHEN 'Denmark' THEN 'DK' ELSE 'AT' END END AS nationality,
       CASE WHEN seen_latest THEN 'Active' WHEN seen_prev THEN 'Inactive' ELSE 'Retired' END AS current_status,
       CASE WHEN ever THEN 1 ELSE 2 END AS peak_tier
FROM rec"""


@register("career_metrics_named", NAMED_CTES + NAMED_CAREERS, ("F1", "C4"))
def q_named_careers(spark, sf_dir):
    return careers.career_metrics(named_records(spark, sf_dir))


@register("players_processed_named", NAMED_CTES + NAMED_PLAYERS, ("F1", "C1", "C2"))
def q_named_players(spark, sf_dir):
    return careers.players_processed(named_records(spark, sf_dir))


# ---- A9 payloads ---------------------------------------------------------------

EDA_SQL = NAMED_CTES + f""",
c AS ({NAMED_CAREERS}),
p AS ({NAMED_PLAYERS}),
j AS (SELECT *, career_length_years AS y FROM c JOIN p USING (player_id)),
reg AS (SELECT primary_region AS l, avg(y) AS m, median(y) AS q, stddev_samp(y) AS s, count(*) AS n FROM j WHERE primary_region <> 'Unknown' GROUP BY 1),
rol AS (SELECT primary_role AS l, avg(y) AS m, median(y) AS q, stddev_samp(y) AS s, count(*) AS n FROM j WHERE primary_role <> 'Unknown' GROUP BY 1),
lists AS (
  SELECT k, sum(n)::BIGINT AS size, {{'sampleSize': sum(n)::BIGINT, 'labels': list(l ORDER BY m DESC, l), 'means': list(round(m, 2) ORDER BY m DESC, l),
         'medians': list(round(q, 2) ORDER BY m DESC, l), 'stds': list(round(s, 2) ORDER BY m DESC, l), 'counts': list(n ORDER BY m DESC, l)}} AS o
  FROM (SELECT 'regions' AS k, * FROM reg UNION ALL SELECT 'roles', * FROM rol) GROUP BY k)
SELECT to_json({{
  'summary': {{'totalPlayers': count(*), 'avgCareerYears': round(avg(y), 2), 'medianCareerYears': round(median(y), 2),
              'stdCareerYears': round(stddev_samp(y), 2), 'maxCareerYears': round(max(y), 2), 'skewness': round(skewness(y), 2),
              'activeRate': round(100.0 * avg((current_status = 'Active')::INT), 1), 'retiredRate': round(100.0 * avg((current_status = 'Retired')::INT), 1)}},
  'dataGaps': {{'unknownRegionPct': round(avg((primary_region = 'Unknown')::INT) * 100, 1), 'unknownRolePct': round(avg((primary_role = 'Unknown')::INT) * 100, 1),
               'knownRegionCount': count_if(primary_region <> 'Unknown')::BIGINT, 'knownRoleCount': count_if(primary_role <> 'Unknown')::BIGINT}},
  'regions': (SELECT CASE WHEN size >= 50 THEN o END FROM lists WHERE k = 'regions'),
  'roles': (SELECT CASE WHEN size >= 50 THEN o END FROM lists WHERE k = 'roles')}})::VARCHAR AS value
FROM j"""


@register("eda_payload", EDA_SQL, ("A9", "F14", "F15", "F16"))
def q_eda(spark, sf_dir):
    r = cut_lineage(named_records(spark, sf_dir))
    return reports.eda_payload(careers.career_metrics(r), careers.players_processed(r))


_QUOTED = lambda s: "'" + s.replace("'", "''") + "'"
STABILITY_SQL = STAB + ", c AS (" + START_SELECT + f"""),
b AS (
  SELECT volatility_bucket AS bucket, count(*) AS n, avg(career_length_years) AS a, median(career_length_years) AS m, avg(survived_5y) AS s,
         avg(early_exit_2y) AS e, avg(team_changes_proxy) AS t FROM w GROUP BY 1)
SELECT to_json({{
  'n_players': (SELECT count(*) FROM w),
  'volatility_vs_survival': (SELECT list({{'bucket': bucket, 'n_players': n, 'avg_career_years': round(a, 2), 'median_career_years': round(m, 2),
      'pct_survived_5y': round(s * 100, 1), 'pct_early_exit_2y': round(e * 100, 1), 'avg_team_changes_proxy': round(t, 2)}}
      ORDER BY CASE bucket WHEN 'Stable (0-1 changes)' THEN 1 WHEN 'Moderate (2 changes)' THEN 2 ELSE 3 END) FROM b),
  'cohort_volatility': (SELECT list({{'career_start_year': career_start_year::INT, 'n_players': n_players, 'avg_team_changes_proxy': round(avg_team_changes_proxy, 2),
      'pct_early_exit_2y': round(pct_early_exit_2y * 100, 1), 'avg_career_years': round(avg_career_years, 2)}} ORDER BY career_start_year) FROM c),
  'trend_summary': (SELECT {{'slope_team_changes_per_year': round(CASE WHEN count(*) >= 2 THEN regr_slope(avg_team_changes_proxy, career_start_year) ELSE 0 END, 4),
      'slope_early_exit_rate_per_year': round(CASE WHEN count(*) >= 2 THEN regr_slope(pct_early_exit_2y, career_start_year) ELSE 0 END, 4),
      'interpretation': {_QUOTED(reports.maps_text.TREND_READING)}}} FROM c),
  'notes': [{", ".join(map(_QUOTED, reports.maps_text.STABILITY_NOTES))}]}})::VARCHAR AS value"""


@register("stability_payload", STABILITY_SQL, ("A9", "F12", "F13", "I1"))
def q_stability(spark, sf_dir):
    return reports.stability_payload(cut_lineage(stab(spark, sf_dir)))


@register("stability_payload_with_models", None, ("A9", "I2"))
def q_stability_models(spark, sf_dir):
    st = cut_lineage(stab(spark, sf_dir))
    feats = ["team_changes_proxy", "starting_tier", "career_start_year"]
    return reports.stability_payload(st, {t: M.fit_logit(st, t, feats) for t in ("survived_5y", "early_exit_2y")})


# ---- A11 bundle, I15 report ------------------------------------------------------

PARAMS = {"forest": {"num_trees": 200, "max_depth": 8, "min_leaf": 5}, "cox": {"penalizer": 0.1}}


def fit_bundle(spark, sf_dir, split=None) -> B.Bundle:
    """Fit every model on the training part of the driver frame."""
    split = split if split is not None else cut_lineage(split_frame(spark, sf_dir))
    train = split.where(F.col("split") == "train")
    rows = M.assemble(split, RF_FEATURES)
    forest = M.fit_random_forest(rows.where(F.col("split") == "train"), RF_FEATURES, "Career_Seasons", **PARAMS["forest"])
    coefs, baseline, info = M.fit_cox(train, "Career_Seasons", "Observed", COX_FEATURES, **PARAMS["cox"])
    baseline = cut_lineage(baseline)
    rf = M.regression_metrics(forest.transform(rows), "Career_Seasons", by="split").select(
        F.lit("forest").alias("model"), "split", F.expr("stack(3, 'mae', mae, 'rmse', rmse, 'r2', r2) AS (metric, value)"))
    risk = cut_lineage(M.partial_hazard(split, coefs, info["means"]).select("split", "Career_Seasons", "Observed", (-F.col("risk")).alias("score")))
    for part in ("train", "test"):
        c = M.concordance(risk.where(F.col("split") == part), "Career_Seasons", "Observed", "score")
        rf = rf.unionByName(c.select(F.lit("cox").alias("model"), F.lit(part).alias("split"), F.lit("c_index").alias("metric"), F.col("c_index").alias("value")))
    rf = cut_lineage(rf)  # a few rows; whoever saves the bundle again need not predict every row again
    return B.assemble(
        spark, forest=forest, features=RF_FEATURES, medians=M.median_values(split, NUMERIC), cox_coefs=coefs, baseline=baseline,
        cox_means=info["means"], nb_coefs=M.fit_negbin(train, "Career_Seasons", COX_FEATURES), labels=S.confidence_labels(train),
        vocabulary={"league": (MODEL_LEAGUES, REF_LEAGUE), "role": (MODEL_ROLES, REF_ROLE)}, metrics=rf)


def _scored(b: B.Bundle, req, rows):
    scored = B.score_requests(b, req, role_case="upper", long_league="1-URGENT")
    length = B.predict_length(b, rows).select(F.col("Player").alias("request_id"), "predicted_length")
    j = scored.join(length, "request_id")
    return j.select("request_id", "league", F.size("errors").alias("n_errors"), F.to_json(F.struct(*[c for c in j.columns if c != "request_id"])).alias("row"))


@register("model_bundle_score", MF_CTE + """
SELECT "League" AS league, count(*) AS n_requests, count(*) AS n_valid, 0::BIGINT AS n_different FROM mf GROUP BY 1""", ("A11", "I14"))
def q_bundle_score(spark, sf_dir):
    """Fit, save, reload; score every request in memory and from the reloaded
    version, and count the rows that differ."""
    rows = cut_lineage(split_frame(spark, sf_dir))
    made = fit_bundle(spark, sf_dir, rows)
    root = scratch_dir(spark, "bundle")
    back = B.load(spark, root, B.save(made, root))
    req = requests(rows)
    a, b = _scored(made, req, rows), _scored(back, req, rows).withColumnsRenamed({"row": "row_b", "league": "league_b", "n_errors": "errors_b"})
    return a.join(b, "request_id", "full").groupBy("league").agg(
        F.count(F.lit(1)).alias("n_requests"), F.count_if(F.col("errors_b") == 0).alias("n_valid"),
        F.count_if(~F.col("row").eqNullSafe(F.col("row_b"))).alias("n_different"))


_FEATURE_ROWS = ", ".join(f"('feature', {i}, '{f}', NULL::DOUBLE)" for i, f in enumerate(RF_FEATURES))
_LEVEL_ROWS = ", ".join([f"('league', {i}, '{v}', {float(v == REF_LEAGUE)})" for i, v in enumerate(MODEL_LEAGUES)]
                        + [f"('role', {i}, '{v}', {float(v == REF_ROLE)})" for i, v in enumerate(MODEL_ROLES)])


@register("model_bundle_contents", MF_CTE + f""",
lab AS (SELECT m."League" AS l, count(*) AS n FROM mf m JOIN (
          SELECT player FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY draw, player::VARCHAR) AS up,
                                     row_number() OVER (PARTITION BY stratum ORDER BY draw DESC, player::VARCHAR DESC) AS down
                              FROM (SELECT "Player" AS player, CASE WHEN "Career_Seasons" <= 1 THEN '1' WHEN "Career_Seasons" <= 2 THEN '2'
                                             WHEN "Career_Seasons" <= 3 THEN '3' WHEN "Career_Seasons" <= 5 THEN '4-5' ELSE '6+' END AS stratum,
                                           ('0x' || substr(md5("Player"::VARCHAR || ':42'), 1, 8))::BIGINT AS draw FROM mf))
          WHERE NOT (up = 1 OR (draw % 100 < 20 AND down > 1))) t ON t.player = m."Player" GROUP BY 1)
SELECT * FROM (VALUES {_FEATURE_ROWS}, {_LEVEL_ROWS}) v(kind, position, name, value)
UNION ALL SELECT 'median', NULL, k, round(v, 6) FROM (
  SELECT 'Avg_KDA' AS k, quantile_cont(CAST("Avg_KDA" AS DOUBLE), 0.5) AS v FROM mf UNION ALL
  SELECT 'Avg_WR', quantile_cont(CAST("Avg_WR" AS DOUBLE), 0.5) FROM mf UNION ALL SELECT 'Total_Games', quantile_cont(CAST("Total_Games" AS DOUBLE), 0.5) FROM mf)
UNION ALL SELECT 'label', NULL, l || ':' || CASE WHEN n >= 150 THEN 'high' WHEN n >= 80 THEN 'medium' ELSE 'low' END, NULL FROM lab""", ("A11", "I4", "C25"))
def q_bundle_contents(spark, sf_dir):
    """What the reloaded newest version holds, without the fitted numbers; two
    versions are written, so that the newest is not the first."""
    made = fit_bundle(spark, sf_dir)
    root = scratch_dir(spark, "bundle")
    B.save(made, root)
    B.save(made, root)
    t = B.load(spark, root).tables
    null_int, null = F.lit(None).cast("int"), F.lit(None).cast("double")
    return (t["features"].select(F.lit("feature").alias("kind"), "position", F.col("feature").alias("name"), null.alias("value"))
            .unionByName(t["vocabulary"].select("kind", "position", F.col("value").alias("name"), F.col("is_reference").cast("double").alias("value")))
            .unionByName(t["medians"].select(F.lit("median").alias("kind"), null_int.alias("position"), F.col("feature").alias("name"), F.round("median", 6).alias("value")))
            .unionByName(t["labels"].select(F.lit("label").alias("kind"), null_int.alias("position"),
                                            F.concat("league_v", F.lit(":"), "confidence").alias("name"), null.alias("value"))))


_JSON_LIST = lambda names: "[" + ", ".join(f"'{n}'" for n in names) + "]"


@register("training_report_dataset", SPLIT_SQL + f"""
SELECT to_json({{'dataset': {{'players': (SELECT count(*) FROM sp)}},
  'split': {{'strategy': 'stratified by career length bucket', 'seed': 42,
            'parts': (SELECT {{'test': max(CASE WHEN split = 'test' THEN s END), 'train': max(CASE WHEN split = 'train' THEN s END)}}
                      FROM (SELECT split, {{'size': count(*), 'mean_length': round(avg(y), 4)}} AS s FROM sp GROUP BY split)),
            'strata': (SELECT json_group_object(stratum, s) FROM (SELECT stratum, {{'train': count_if(split = 'train')::BIGINT, 'test': count_if(split = 'test')::BIGINT}} AS s
                       FROM sp GROUP BY stratum ORDER BY stratum))}},
  'feature_cols': {_JSON_LIST(RF_FEATURES)}, 'cox_features': {_JSON_LIST(COX_FEATURES)}}})::VARCHAR AS value""", ("I15",))
def q_report_dataset(spark, sf_dir):
    from ..sources.landing import report_json
    return report_json(reports.training_dataset(cut_lineage(split_frame(spark, sf_dir)), RF_FEATURES, COX_FEATURES), nulls=True)

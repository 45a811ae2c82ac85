"""Report payloads (A9, I15): nested JSON assembled from many small frames in
one plan, keys in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.landing import report_json
from . import cohort, describe, maps_text
from .bundle import Bundle


def _pct(c) -> Column:
    return F.round(F.avg(c.cast("double")) * 100, 1)


def stability_payload(stab: DataFrame, logits: dict[str, DataFrame] | None = None) -> DataFrame:
    """Volatility against survival, start-year cohorts, their trends and, where
    given, the fitted logit models (frames of ``fit_logit`` by target)."""
    buckets = cohort.by_volatility(stab).select(
        F.col("bucket_rank").alias("_ord"), F.col("volatility_bucket").alias("bucket"), "n_players",
        F.round("avg_career_years", 2).alias("avg_career_years"), F.round("median_career_years", 2).alias("median_career_years"),
        F.round(F.col("pct_survived_5y") * 100, 1).alias("pct_survived_5y"), F.round(F.col("pct_early_exit_2y") * 100, 1).alias("pct_early_exit_2y"),
        F.round("avg_team_changes_proxy", 2).alias("avg_team_changes_proxy"))
    years = cohort.by_start_year(stab)
    cohorts = years.select(
        F.col("career_start_year").alias("_ord"), F.col("career_start_year").cast("int").alias("career_start_year"), "n_players",
        F.round("avg_team_changes_proxy", 2).alias("avg_team_changes_proxy"), F.round(F.col("pct_early_exit_2y") * 100, 1).alias("pct_early_exit_2y"),
        F.round("avg_career_years", 2).alias("avg_career_years"))
    trends = cohort.cohort_trends(years).select(
        F.round("slope_team_changes_per_year", 4).alias("slope_team_changes_per_year"),
        F.round("slope_early_exit_per_year", 4).alias("slope_early_exit_rate_per_year"),
        F.lit(maps_text.TREND_READING).alias("interpretation"))
    parts = {"n_players": stab.agg(F.count(F.lit(1)).alias("n_players")), "volatility_vs_survival": buckets,
             "cohort_volatility": cohorts, "trend_summary": trends}
    if logits:
        parts["logit_models"] = {
            target: {"method": "logit",
                     "fit": m.agg(F.first("n_obs").alias("n_obs"), F.first("pseudo_r2").alias("pseudo_r2"), F.first("aic").alias("aic")),
                     "coefficients": m.select(F.col("term").alias("_key"), "coef", "p_value", "odds_ratio")}
            for target, m in logits.items()}
    return report_json({**parts, "notes": maps_text.STABILITY_NOTES}, nulls=True)


def _known(df: DataFrame, group: str, length: str, least: int) -> DataFrame:
    """Group statistics of the known rows as one object of parallel lists; null
    when fewer than ``least`` rows are known."""
    known = df.where(F.col(group) != "Unknown")
    g = describe.group_stats(known, group, length).select(
        F.struct(-F.col("mean"), F.col(group)).alias("o"), group, *[F.round(c, 2).alias(c) for c in ("mean", "median", "std")], "count")
    rows = g.agg(F.array_sort(F.collect_list(F.struct("o", group, "mean", "median", "std", "count"))).alias("r"))
    take = lambda c: F.transform("r", lambda x: x[c])
    n = known.agg(F.count(F.lit(1))).scalar()
    return rows.select(n.alias("sampleSize"), take(group).alias("labels"), take("mean").alias("means"), take("median").alias("medians"),
                       take("std").alias("stds"), take("count").alias("counts")).where(F.col("sampleSize") >= least)


def eda_payload(careers: DataFrame, players: DataFrame, least: int = 50, length: str = "career_length_years") -> DataFrame:
    """Headline figures, data gaps and the statistics by known region and role."""
    j = careers.join(players, "player_id")
    s = describe.scalar_summary(j, length, "current_status")
    summary = s.select(
        F.col("n").alias("totalPlayers"), F.round("mean", 2).alias("avgCareerYears"), F.round("median", 2).alias("medianCareerYears"),
        F.round("std", 2).alias("stdCareerYears"), F.round("max", 2).alias("maxCareerYears"), F.round("skew", 2).alias("skewness"),
        F.round("active_pct", 1).alias("activeRate"), F.round("retired_pct", 1).alias("retiredRate"))
    no_region, no_role = F.col("primary_region") == "Unknown", F.col("primary_role") == "Unknown"
    gaps = j.agg(_pct(no_region).alias("unknownRegionPct"), _pct(no_role).alias("unknownRolePct"),
                 F.count_if(~no_region).alias("knownRegionCount"), F.count_if(~no_role).alias("knownRoleCount"))
    return report_json({"summary": summary, "dataGaps": gaps, "regions": _known(j, "primary_region", length, least),
                        "roles": _known(j, "primary_role", length, least)}, nulls=True)


def training_dataset(split: DataFrame, features: list[str], cox_features: list[str], seed: int = 42, length: str = "Career_Seasons") -> dict:
    """The deterministic parts of the training report."""
    sizes = split.agg(F.count(F.lit(1)).alias("players"))
    by = split.groupBy("split").agg(F.count(F.lit(1)).alias("size"), F.round(F.avg(length), 4).alias("mean_length")).withColumnRenamed("split", "_key")
    strata = split.groupBy("stratum").agg(F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "test").alias("test"))
    return {"dataset": sizes, "split": {"strategy": "stratified by career length bucket", "seed": seed, "parts": by,
                                        "strata": strata.withColumnRenamed("stratum", "_key")},
            "feature_cols": features, "cox_features": cox_features}


def training_report(bundle: Bundle, split: DataFrame, cox_features: list[str], params: dict) -> DataFrame:
    """Data set, split, forest metrics and importances, both C-indices and
    the hazard ratios, from the tables of a bundle."""
    m = bundle.tables["metrics"].withColumn("value", F.round("value", 3))

    def wide(model, *names):
        return (m.where(F.col("model") == model).groupBy(F.col("split").alias("_key"))
                .agg(*[F.max(F.when(F.col("metric") == x, F.col("value"))).alias(x) for x in names]))
    ratios = bundle.coefficients("cox").select(
        F.col("position").alias("_ord"), F.col("term").alias("_key"), F.round("hazard_ratio", 3).alias("hazard_ratio"),
        F.round("p_value", 4).alias("p_value"), (F.col("p_value") < 0.05).alias("significant"))
    importances = bundle.tables["features"].select(
        F.struct(-F.col("importance"), F.col("position")).alias("_ord"), "feature", F.round("importance", 4).alias("importance"))
    return report_json({**training_dataset(split, bundle.feature_list(), cox_features),
                        "random_forest": {"parameters": params["forest"], "metrics": wide("forest", "mae", "rmse", "r2"), "importances": importances},
                        "cox": {"parameters": params["cox"], "c_index": wide("cox", "c_index"), "hazard_ratios": ratios}}, nulls=True)

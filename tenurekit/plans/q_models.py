"""Step 8: models and scoring on the driver model frame.

Vocabulary on this panel: leagues are the priorities 1-URGENT, 2-HIGH,
3-MEDIUM, 5-LOW (5-LOW is the reference level), roles are the market
segments (AUTOMOBILE is the reference), debut is the season number
(year - 1989, so 1995 is season 6) and the early era is debut <= 9.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean
from ..operators import cohort, models as M, score as S
from ..operators.careers import career_metrics
from ..session import cut_lineage
from .q_careers import MODEL_LEAGUES, MODEL_ROLES, MODEL_SQL, model_frame, records
from .q_describe import r6, sql_r6
from .registry import register

REF_LEAGUE, REF_ROLE = "5-LOW", "AUTOMOBILE"
NUMERIC = ["Avg_KDA", "Avg_WR", "Total_Games"]
LEAGUE_COLS = [f"League_{S.clean_name(l)}" for l in MODEL_LEAGUES if l != REF_LEAGUE]
ROLE_COLS = [f"Role_{S.clean_name(r)}" for r in MODEL_ROLES if r != REF_ROLE]
COX_FEATURES = LEAGUE_COLS + ROLE_COLS + ["Early_Era"]
RF_FEATURES = ["Debut", "Early_Era", *NUMERIC, *LEAGUE_COLS, *ROLE_COLS]


def encoded(spark, sf_dir):
    """The model frame with its features; a row per entity, stored once, as the
    medians, the split and the fits all read it."""
    mf = cut_lineage(model_frame(spark, sf_dir)).withColumn("Debut", (F.col("Debut") - 1989).cast("int"))
    mf = mf.withColumn("Early_Era", clean.early_era("Debut"))
    mf = M.impute_medians(mf, NUMERIC)
    mf = M.one_hot(mf, "League", MODEL_LEAGUES, REF_LEAGUE, "League_")
    return M.one_hot(mf, "Role", MODEL_ROLES, REF_ROLE, "Role_")


MF_CTE = MODEL_SQL.replace("\nSELECT player AS \"Player\"", ",\nmf AS (SELECT player AS \"Player\"", 1) + ")"


@register("model_medians", sql_r6(MF_CTE + """
SELECT quantile_cont(CAST("Avg_KDA" AS DOUBLE), 0.5) AS "Avg_KDA", quantile_cont(CAST("Avg_WR" AS DOUBLE), 0.5) AS "Avg_WR",
       quantile_cont(CAST("Total_Games" AS DOUBLE), 0.5) AS "Total_Games" FROM mf""", NUMERIC), ("I4",))
def q_medians(spark, sf_dir):
    return r6(M.median_values(model_frame(spark, sf_dir), NUMERIC))


def _onehot_sql():
    parts = [f'CAST("League" = \'{l}\' AS INTEGER) AS "League_{S.clean_name(l)}"' for l in MODEL_LEAGUES if l != REF_LEAGUE]
    parts += [f'CAST("Role" = \'{r}\' AS INTEGER) AS "Role_{S.clean_name(r)}"' for r in MODEL_ROLES if r != REF_ROLE]
    return ", ".join(parts)


@register("model_encoded", sql_r6(MF_CTE + f"""
SELECT "Player", "Career_Seasons", "Observed", "League", "Role", CAST("Debut" - 1989 AS INTEGER) AS "Debut",
       CAST("Debut" - 1989 <= 9 AS INTEGER) AS "Early_Era",
       coalesce(CAST("Avg_KDA" AS DOUBLE), (SELECT quantile_cont("Avg_KDA", 0.5) FROM mf)) AS "Avg_KDA",
       coalesce(CAST("Avg_WR" AS DOUBLE), (SELECT quantile_cont("Avg_WR", 0.5) FROM mf)) AS "Avg_WR",
       coalesce(CAST("Total_Games" AS DOUBLE), (SELECT quantile_cont("Total_Games", 0.5) FROM mf)) AS "Total_Games",
       {_onehot_sql()}
FROM mf""", NUMERIC), ("C20", "C22", "I4"))
def q_encoded(spark, sf_dir):
    return r6(encoded(spark, sf_dir))


def split_frame(spark, sf_dir):
    return M.split_train_test(encoded(spark, sf_dir), "Player", 42, 20,
                              stratum=clean.career_bucket("Career_Seasons"))


SPLIT_SQL = MF_CTE + """,
st AS (SELECT "Player" AS player, "Career_Seasons" AS y,
              CASE WHEN "Career_Seasons" <= 1 THEN '1' WHEN "Career_Seasons" <= 2 THEN '2' WHEN "Career_Seasons" <= 3 THEN '3'
                   WHEN "Career_Seasons" <= 5 THEN '4-5' ELSE '6+' END AS stratum,
              ('0x' || substr(md5("Player"::VARCHAR || ':42'), 1, 8))::BIGINT AS draw FROM mf),
ends AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY draw, player::VARCHAR) AS up,
                row_number() OVER (PARTITION BY stratum ORDER BY draw DESC, player::VARCHAR DESC) AS down FROM st),
sp AS (SELECT *, CASE WHEN up = 1 OR (draw % 100 < 20 AND down > 1) THEN 'test' ELSE 'train' END AS split FROM ends)
"""


@register("model_split_counts", SPLIT_SQL + "SELECT stratum, split, count(*) AS n FROM sp GROUP BY 1, 2", ("I5", "C21"))
def q_split(spark, sf_dir):
    return split_frame(spark, sf_dir).groupBy("stratum", "split").agg(F.count(F.lit(1)).alias("n"))


@register("model_rf_report", None, ("I6", "I7", "G6"))
def q_rf(spark, sf_dir):
    d = M.assemble(cut_lineage(split_frame(spark, sf_dir)), RF_FEATURES)
    train = d.where(F.col("split") == "train")
    model = M.fit_random_forest(train, RF_FEATURES, "Career_Seasons")
    pred = model.transform(d)
    met = M.regression_metrics(pred, "Career_Seasons", by="split")
    rows = met.select(F.lit("metric").alias("kind"), F.col("split").alias("name"),
                      F.to_json(F.struct("mae", "rmse", "r2", "n")).alias("value"))
    imp = (M.importances(spark, model, RF_FEATURES).orderBy(F.col("importance").desc(), "feature").limit(10)
           .select(F.lit("importance").alias("kind"), F.col("feature").alias("name"),
                   F.format_number("importance", 4).alias("value")))
    return rows.unionByName(imp)


@register("model_baseline_metrics", sql_r6(MF_CTE + """,
p AS (SELECT "Career_Seasons" AS y, avg("Career_Seasons") OVER (PARTITION BY "League") AS yhat FROM mf)
SELECT avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, count(*) AS n,
       1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) AS r2 FROM p""", ["mae", "rmse", "r2"]), ("I7",))
def q_baseline_metrics(spark, sf_dir):
    mf = model_frame(spark, sf_dir)
    means = mf.groupBy("League").agg(F.avg("Career_Seasons").alias("prediction"))
    return r6(M.regression_metrics(mf.join(means, "League"), "Career_Seasons"))


def stability(spark, sf_dir):
    return cohort.stability_frame(career_metrics(records(spark, sf_dir)))


@register("model_logit", None, ("I2",))
def q_logit(spark, sf_dir):
    feats = ["team_changes_proxy", "starting_tier", "career_start_year"]
    st = cut_lineage(stability(spark, sf_dir).select("survived_5y", "early_exit_2y", *feats))
    a = M.fit_logit(st, "survived_5y", feats).withColumn("target", F.lit("survived_5y"))
    b = M.fit_logit(st, "early_exit_2y", feats).withColumn("target", F.lit("early_exit_2y"))
    return a.unionByName(b)


@register("model_ols", None, ("I3",))
def q_ols(spark, sf_dir):
    st = stability(spark, sf_dir)
    return M.fit_ols(st, "survived_5y", ["team_changes_proxy", "starting_tier", "career_start_year"])


def cox(spark, sf_dir, split=None):
    tr = (split_frame(spark, sf_dir) if split is None else split).where(F.col("split") == "train")
    return M.fit_cox(tr, "Career_Seasons", "Observed", COX_FEATURES, penalizer=0.1)


@register("model_cox", None, ("I8", "I10"))
def q_cox(spark, sf_dir):
    coefs, _, _ = cox(spark, sf_dir)
    return coefs


@register("model_cindex_fixed_score", MF_CTE + """,
g AS (SELECT CAST("Career_Seasons" AS DOUBLE) AS t, "Avg_KDA" AS s, sum("Observed") AS ne, count(*) AS na FROM mf GROUP BY 1, 2),
pr AS (SELECT a.s AS sa, b.s AS sb, a.ne * b.na AS w FROM g a JOIN g b ON b.t > a.t WHERE a.ne > 0)
SELECT sum(CASE WHEN sa < sb THEN w ELSE 0 END) AS concordant, sum(CASE WHEN sa = sb THEN w ELSE 0 END) AS tied,
       sum(w) AS comparable,
       (sum(CASE WHEN sa < sb THEN w ELSE 0 END) + 0.5 * sum(CASE WHEN sa = sb THEN w ELSE 0 END)) / sum(w) AS c_index
FROM pr""", ("I9",))
def q_cindex(spark, sf_dir):
    return M.concordance(model_frame(spark, sf_dir), "Career_Seasons", "Observed", "Avg_KDA")


@register("model_cox_cindex", None, ("I8", "I9"))
def q_cox_cindex(spark, sf_dir):
    split = cut_lineage(split_frame(spark, sf_dir))
    coefs, _, info = cox(spark, sf_dir, split)
    d = M.partial_hazard(split, coefs, info["means"])
    d = d.withColumn("score", -F.col("risk"))
    tr = M.concordance(d.where(F.col("split") == "train"), "Career_Seasons", "Observed", "score")
    te = M.concordance(d.where(F.col("split") == "test"), "Career_Seasons", "Observed", "score")
    return tr.withColumn("split", F.lit("train")).unionByName(te.withColumn("split", F.lit("test")))


def profiles(split):
    """Every observed (league, role, debut) profile of the model frame."""
    return split.select("League", "Role", "Debut", *COX_FEATURES).distinct().withColumn(
        "profile", F.concat_ws("|", "League", "Role", F.col("Debut").cast("string")))


@register("model_survival_profiles", None, ("I11", "I12"))
def q_survival(spark, sf_dir):
    split = cut_lineage(split_frame(spark, sf_dir))
    coefs, baseline, info = cox(spark, sf_dir, split)
    pr = M.partial_hazard(profiles(split), coefs, info["means"])
    surv = M.survival_at(pr.select("profile", "risk"), baseline)
    med = M.median_survival(surv, "profile")
    return surv.select("profile", "t", F.round("surv", 4).alias("surv")).join(med, "profile")


def negbin(spark, sf_dir, split=None):
    tr = (split_frame(spark, sf_dir) if split is None else split).where(F.col("split") == "train")
    return M.fit_negbin(tr, "Career_Seasons", COX_FEATURES)


@register("model_negbin", None, ("J3",))
def q_negbin(spark, sf_dir):
    return negbin(spark, sf_dir)


@register("model_negbin_predict", None, ("I13",))
def q_nb_predict(spark, sf_dir):
    split = cut_lineage(split_frame(spark, sf_dir))
    return M.predict_linear_exp(profiles(split), negbin(spark, sf_dir, split), COX_FEATURES).select(
        "profile", "predicted")


def requests(rows):
    """Scoring requests built from the rows of the encoded model frame (one per
    entity), plus their raw spelling: lower-case league, season-number debut."""
    return rows.select(F.col("Player").alias("request_id"), F.col("Player").alias("name"),
                       F.lower("League").alias("league"), F.col("Role").alias("role"),
                       F.col("Debut").alias("debut"))


@register("score_batch", None, ("I14", "C24", "C25"))
def q_score(spark, sf_dir):
    split = cut_lineage(split_frame(spark, sf_dir))
    coefs, baseline, info = cox(spark, sf_dir, split)
    nb = negbin(spark, sf_dir, split)
    labels = S.confidence_labels(split.where(F.col("split") == "train"))
    out = S.score(requests(split), nb_coefs=nb, cox_coefs=coefs, baseline=baseline,
                  cox_means=info["means"], labels=labels, leagues=MODEL_LEAGUES, roles=MODEL_ROLES,
                  ref_league=REF_LEAGUE, ref_role=REF_ROLE, role_case="upper", long_league="1-URGENT")
    return out.withColumn("survival_probs", F.to_json("survival_probs")).withColumn(
        "errors", F.array_join("errors", "; "))


@register("model_training_report", None, ("I15", "A9"))
def q_report(spark, sf_dir):
    """The whole report, read from a saved and reloaded bundle."""
    from ..operators import bundle as B, reports
    from ..streaming.incremental import scratch_dir
    from .q_reports import PARAMS, fit_bundle
    split = cut_lineage(split_frame(spark, sf_dir))
    root = scratch_dir(spark, "bundle")
    back = B.load(spark, root, B.save(fit_bundle(spark, sf_dir, split), root))
    return reports.training_report(back, split, COX_FEATURES, PARAMS)

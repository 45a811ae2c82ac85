"""Fits and scoring steps against SQL: the oracles run the same iterations as
recursive queries (one covariate, so that each step is a closed form), or score
with coefficients written down in the query."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean
from ..operators import models as M, score as S
from .q_careers import CM_CTES, MODEL_LEAGUES, MODEL_ROLES, model_frame
from .q_cohort import stab
from .q_models import MF_CTE, REF_LEAGUE, REF_ROLE, split_frame
from .registry import register


def _frame(spark, sf_dir):
    mf = model_frame(spark, sf_dir)
    return mf.withColumns({"urgent": (F.col("League") == "1-URGENT").cast("double"), "late": (F.col("Debut") - 1995).cast("double")})


# ---- I8, I10: Cox with one covariate, Efron ties, ridge penalty --------------

COX_SQL = MF_CTE + """,
raw AS (SELECT "Career_Seasons"::DOUBLE AS t, "Observed" AS e, ("League" = '1-URGENT')::INT::DOUBLE AS x FROM mf),
st AS (SELECT count(*) AS n, avg(x) AS m, stddev_pop(x) AS s FROM raw),
cells AS (SELECT t, e, (x - m) / s AS z, count(*) AS c FROM raw, st GROUP BY ALL),
times AS (SELECT t, sum(c) AS d FROM cells WHERE e = 1 GROUP BY t),
it AS (
  SELECT 0 AS k, 0.0::DOUBLE AS b
  UNION ALL
  SELECT k + 1, b - g / h FROM (
    SELECT k, b, sum(CASE WHEN l = 0 THEN zs ELSE 0 END) - sum((s1 - f * d1) / (s0 - f * d0)) - any_value(n) * 0.1 * b AS g,
           -sum((s2 - f * d2) / (s0 - f * d0) - pow((s1 - f * d1) / (s0 - f * d0), 2)) - any_value(n) * 0.1 AS h
    FROM (
      SELECT *, unnest(range(d::BIGINT)) AS l, unnest(range(d::BIGINT))::DOUBLE / d AS f FROM (
        SELECT it.k, it.b, u.t, any_value(u.d) AS d, any_value(st.n) AS n,
               sum(c * exp(b * z)) FILTER (cells.t >= u.t) AS s0, sum(c * z * exp(b * z)) FILTER (cells.t >= u.t) AS s1, sum(c * z * z * exp(b * z)) FILTER (cells.t >= u.t) AS s2,
               sum(c * exp(b * z)) FILTER (cells.t = u.t AND e = 1) AS d0, sum(c * z * exp(b * z)) FILTER (cells.t = u.t AND e = 1) AS d1,
               sum(c * z * z * exp(b * z)) FILTER (cells.t = u.t AND e = 1) AS d2, sum(c * z) FILTER (cells.t = u.t AND e = 1) AS zs
        FROM it, times u, cells, st WHERE it.k < 25 GROUP BY it.k, it.b, u.t))
    GROUP BY k, b)),
fit AS (SELECT b FROM it WHERE k = 25)"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@register("model_cox_one", _recursive(COX_SQL) + """
SELECT 'urgent' AS term, round(b / s, 6) AS coef, round(exp(b / s), 6) AS hazard_ratio FROM fit, st""", ("I8",))
def q_cox_one(spark, sf_dir):
    coefs, _, _ = M.fit_cox(_frame(spark, sf_dir), "Career_Seasons", "Observed", ["urgent"], penalizer=0.1)
    return coefs.select("term", F.round("coef", 6).alias("coef"), F.round("hazard_ratio", 6).alias("hazard_ratio"))


@register("model_cox_baseline_one", _recursive(COX_SQL) + """,
hz AS (SELECT a.t, coalesce(any_value(times.d), 0) / sum(c * exp(b * z)) FILTER (cells.t >= a.t) AS h
       FROM (SELECT DISTINCT t FROM cells) a CROSS JOIN cells CROSS JOIN fit LEFT JOIN times ON times.t = a.t GROUP BY a.t)
SELECT t AS time, round(sum(h) OVER (ORDER BY t), 6) AS cum_hazard FROM hz""", ("I10",))
def q_cox_baseline_one(spark, sf_dir):
    _, baseline, _ = M.fit_cox(_frame(spark, sf_dir), "Career_Seasons", "Observed", ["urgent"], penalizer=0.1)
    return baseline.select("time", F.round("cum_hazard", 6).alias("cum_hazard"))


# ---- J3: negative binomial with one covariate -----------------------------------

NB_SQL = MF_CTE + """,
cells AS (SELECT "Career_Seasons"::DOUBLE AS y, ("Debut" - 1995)::DOUBLE AS x, count(*) AS c FROM mf GROUP BY ALL),
start AS (SELECT ln(sum(c * y) / sum(c)) AS b0 FROM cells),
it AS (
  SELECT 0 AS k, b0 AS a0, 0.0::DOUBLE AS a1, greatest(sum(c * (pow(y - exp(b0), 2) - exp(b0))) / sum(c * exp(2 * b0)), 1e-8::DOUBLE) AS alpha FROM cells, start GROUP BY b0
  UNION ALL
  SELECT k + 1, n0, n1, greatest(sum(c * (pow(y - exp(n0 + n1 * x), 2) - exp(n0 + n1 * x))) / sum(c * exp(2 * (n0 + n1 * x))), 1e-8::DOUBLE)
  FROM (
    SELECT k, (s11 * r0 - s01 * r1) / (s00 * s11 - s01 * s01) AS n0, (s00 * r1 - s01 * r0) / (s00 * s11 - s01 * s01) AS n1 FROM (
      SELECT k, sum(c * w) AS s00, sum(c * w * x) AS s01, sum(c * w * x * x) AS s11, sum(c * w * v) AS r0, sum(c * w * v * x) AS r1 FROM (
        SELECT it.k, c, x, exp(a0 + a1 * x) / (1 + alpha * exp(a0 + a1 * x)) AS w, a0 + a1 * x + (y - exp(a0 + a1 * x)) / exp(a0 + a1 * x) AS v
        FROM it, cells WHERE it.k < 60)
      GROUP BY k)), cells
  GROUP BY k, n0, n1)"""


@register("model_negbin_one", _recursive(NB_SQL) + """
SELECT term, round(coef, 5) AS coef, round(alpha, 5) AS alpha FROM (
  SELECT unnest([{'t': 'const', 'c': a0}, {'t': 'late', 'c': a1}]).t AS term, unnest([{'t': 'const', 'c': a0}, {'t': 'late', 'c': a1}]).c AS coef, alpha FROM it WHERE k = 60)""", ("J3",))
def q_negbin_one(spark, sf_dir):
    m = M.fit_negbin(_frame(spark, sf_dir), "Career_Seasons", ["late"])
    return m.select("term", F.round("coef", 5).alias("coef"), F.round("alpha", 5).alias("alpha"))


# ---- I2, I3: logistic and linear with one covariate --------------------------------

STAB_SQL = CM_CTES + """,
w AS (SELECT (career_start_year - 1995)::DOUBLE AS x, (career_length_years >= 5)::INT::DOUBLE AS y FROM cm WHERE career_length_years IS NOT NULL AND career_start_year IS NOT NULL),
cells AS (SELECT x, y, count(*) AS c FROM w GROUP BY ALL)"""


def _stab(spark, sf_dir):
    return stab(spark, sf_dir).withColumn("start", F.col("career_start_year") - 1995)


LOGIT_SQL = STAB_SQL + """,
it AS (
  SELECT 0 AS k, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b
  UNION ALL
  SELECT k + 1, a + (s11 * g0 - s01 * g1) / (s00 * s11 - s01 * s01), b + (s00 * g1 - s01 * g0) / (s00 * s11 - s01 * s01) FROM (
    SELECT k, a, b, sum(c * (y - p)) AS g0, sum(c * x * (y - p)) AS g1, sum(c * p * (1 - p)) AS s00, sum(c * x * p * (1 - p)) AS s01, sum(c * x * x * p * (1 - p)) AS s11
    FROM (SELECT it.*, cells.*, 1 / (1 + exp(-(a + b * x))) AS p FROM it, cells WHERE it.k < 25) GROUP BY k, a, b)),
fit AS (SELECT a, b FROM it WHERE k = 25),
ll AS (SELECT sum(c * (y * ln(p) + (1 - y) * ln(1 - p))) AS ll, sum(c) AS n FROM (SELECT *, 1 / (1 + exp(-(a + b * x))) AS p FROM cells, fit)),
l0 AS (SELECT sum(c * (y * ln(m) + (1 - y) * ln(1 - m))) AS ll0 FROM cells, (SELECT sum(c * y) / sum(c) AS m FROM cells))"""


@register("model_logit_one", _recursive(LOGIT_SQL) + """
SELECT term, round(coef, 4) AS coef, round(exp(coef), 4) AS odds_ratio, n::BIGINT AS n_obs, round(1 - ll / ll0, 5) AS pseudo_r2, round(4 - 2 * ll, 3) AS aic
FROM (SELECT 'start' AS term, b AS coef FROM fit UNION ALL SELECT 'const', a FROM fit), ll, l0""", ("I2",))
def q_logit_one(spark, sf_dir):
    m = M.fit_logit(_stab(spark, sf_dir), "survived_5y", ["start"])
    return m.select("term", F.round("coef", 4).alias("coef"), F.round("odds_ratio", 4).alias("odds_ratio"), "n_obs",
                    F.round("pseudo_r2", 5).alias("pseudo_r2"), F.round("aic", 3).alias("aic"))


@register("model_ols_one", STAB_SQL + """
SELECT term, round(coef, 6) AS coef, round(r2, 6) AS r2 FROM (
  SELECT 'start' AS term, regr_slope(y, x) AS coef, regr_r2(y, x) AS r2 FROM w UNION ALL SELECT 'const', regr_intercept(y, x), regr_r2(y, x) FROM w)""", ("I3",))
def q_ols_one(spark, sf_dir):
    m = M.fit_ols(_stab(spark, sf_dir), "survived_5y", ["start"])
    return m.select("term", F.round("coef", 6).alias("coef"), F.round("r2", 6).alias("r2"))


# ---- C24, C25, I11-I14: scoring with coefficients that are written down --------------

NB_COEFS = {"const": 1.5, "League_1_URGENT": 0.2, "League_2_HIGH": -0.1, "League_3_MEDIUM": 0.05, "Role_BUILDING": 0.1, "Role_FURNITURE": -0.2,
            "Role_HOUSEHOLD": 0.0, "Role_MACHINERY": 0.3, "Early_Era": 0.15}
COX_COEFS = {"League_1_URGENT": -0.4, "League_2_HIGH": 0.3, "Role_BUILDING": 0.2, "Early_Era": -0.25}
COX_MEANS = {"League_1_URGENT": 0.25, "League_2_HIGH": 0.25, "Role_BUILDING": 0.2, "Early_Era": 0.9}


def raw_requests(spark, sf_dir):
    """Requests as they are sent: another spelling, and some with faults."""
    mf = model_frame(spark, sf_dir)
    k = F.col("Player").cast("long")
    return mf.select(
        F.col("Player").alias("request_id"), F.col("Player").alias("name"),
        F.when(k % 11 == 0, "nowhere").when(k % 13 == 0, F.lit(None)).otherwise(F.lower("League")).alias("league"),
        F.when(k % 17 == 0, "coach").otherwise(F.initcap("Role")).alias("role"),
        F.when(k % 7 == 0, F.lit(None)).when(k % 19 == 0, F.lit(16)).otherwise(F.col("Debut") - 1989).cast("int").alias("debut"))


def _case(col: str, coefs: dict, kind: str) -> str:
    parts = [f"WHEN {col} = '{v}' THEN {coefs.get(kind + S.clean_name(v), 0.0)}" for v in (MODEL_LEAGUES if kind == "League_" else MODEL_ROLES)]
    return "CASE " + " ".join(parts) + " ELSE 0.0 END::DOUBLE"


def _list(values):
    return "[" + ", ".join(f"''{v}''" for v in values) + "]"


_BASE = sum(COX_COEFS[k] * m for k, m in COX_MEANS.items())
SCORE_SQL = MF_CTE + f""",
req AS (
  SELECT "Player" AS request_id, CASE WHEN k % 11 = 0 THEN 'nowhere' WHEN k % 13 = 0 THEN NULL ELSE lower("League") END AS league_r,
         CASE WHEN k % 17 = 0 THEN 'coach' ELSE "Role" END AS role_r, CASE WHEN k % 7 = 0 THEN NULL WHEN k % 19 = 0 THEN 16 ELSE "Debut" - 1989 END::INT AS debut
  FROM (SELECT *, "Player"::BIGINT AS k FROM mf)),
v AS (
  SELECT *, upper(coalesce(league_r, '')) AS league, upper(role_r) AS role,
         list_filter([CASE WHEN upper(coalesce(league_r, '')) NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') THEN '''league'' must be one of {_list(MODEL_LEAGUES)}' END,
                      CASE WHEN upper(role_r) NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY') THEN '''role'' must be one of {_list(MODEL_ROLES)}' END,
                      CASE WHEN debut IS NULL THEN '''debut'' (season number 6-15) is required' WHEN debut NOT BETWEEN 6 AND 15 THEN '''debut'' must be an integer between 6 and 15' END],
                     lambda x: x IS NOT NULL) AS errors FROM req),
base AS (SELECT t, sum(h) OVER (ORDER BY t) AS h FROM (
           SELECT a.t, (SELECT count(*) FROM mf WHERE "Career_Seasons" = a.t AND "Observed" = 1)::DOUBLE / (SELECT count(*) FROM mf WHERE "Career_Seasons" >= a.t) AS h
           FROM (SELECT DISTINCT "Career_Seasons" AS t FROM mf) a)),
h0 AS (SELECT list(coalesce((SELECT h FROM base WHERE t <= i ORDER BY t DESC LIMIT 1), 0.0) ORDER BY i) AS h FROM range(1, 11) r(i)),
lab AS (SELECT "League" AS league, CASE WHEN count(*) >= 150 THEN 'high' WHEN count(*) >= 80 THEN 'medium' ELSE 'low' END AS confidence FROM mf GROUP BY 1),
p AS (
  SELECT v.*, lab.confidence, len(errors) = 0 AS ok,
         round(exp(1.5::DOUBLE + {_case('v.league', NB_COEFS, 'League_')} + {_case('v.role', NB_COEFS, 'Role_')} + CASE WHEN debut <= 9 THEN 0.15 ELSE 0 END::DOUBLE), 2) AS pred,
         list_transform(h0.h, lambda x: exp(-x * exp({_case('v.league', COX_COEFS, 'League_')} + {_case('v.role', COX_COEFS, 'Role_')}
                                                + CASE WHEN debut <= 9 THEN -0.25 ELSE 0 END::DOUBLE - ({_BASE})::DOUBLE))) AS s
  FROM v CROSS JOIN h0 LEFT JOIN lab ON lab.league = v.league)"""


def scored(spark, sf_dir):
    """Length by the written coefficients, survival over the Nelson-Aalen
    baseline of the model frame (a Cox baseline with no effects)."""
    mf = model_frame(spark, sf_dir)
    per = mf.groupBy(F.col("Career_Seasons").cast("double").alias("t")).agg(F.sum("Observed").alias("d"), F.count(F.lit(1)).alias("c"))
    from ..operators.prefix import running_sums
    steps = running_sums(per, [], [F.desc("t")], {"later": "c"}).select("t", (F.col("d") / (F.col("later") + F.col("c"))).alias("h"))
    baseline = running_sums(steps, [], ["t"], {"_h": "h"}).select(F.col("t").alias("time"), (F.col("_h") + F.col("h")).alias("cum_hazard"))
    frame = lambda d: spark.createDataFrame([(k, float(v)) for k, v in d.items()], "term string, coef double")
    zeros = {f"League_{S.clean_name(v)}": 0.0 for v in MODEL_LEAGUES} | {f"Role_{S.clean_name(v)}": 0.0 for v in MODEL_ROLES}
    return S.score(raw_requests(spark, sf_dir), nb_coefs=frame(zeros | NB_COEFS), cox_coefs=frame(COX_COEFS), baseline=baseline, cox_means=COX_MEANS,
                   labels=S.confidence_labels(mf), leagues=MODEL_LEAGUES, roles=MODEL_ROLES, ref_league=REF_LEAGUE, ref_role=REF_ROLE,
                   role_case="upper", long_league="1-URGENT")


@register("score_request_errors", SCORE_SQL + """
SELECT request_id, league, role, debut, array_to_string(errors, '; ') AS errors FROM p""", ("C24",))
def q_errors(spark, sf_dir):
    return scored(spark, sf_dir).select("request_id", "league", "role", "debut", F.array_join("errors", "; ").alias("errors"))


@register("score_fixed_model", SCORE_SQL + """
SELECT request_id, CASE WHEN ok THEN pred END AS predicted_seasons, CASE WHEN ok THEN round(s[3], 4) END AS s3, CASE WHEN ok THEN round(s[10], 4) END AS s10,
       CASE WHEN ok THEN coalesce(list_position(list_transform(s, lambda x: x <= 0.5), TRUE), 10) END AS survival_50pct,
       CASE WHEN ok THEN coalesce(confidence, 'low') END AS confidence,
       CASE WHEN ok THEN CASE WHEN pred >= 4 THEN 'above-average' WHEN pred >= 2.5 THEN 'an average' ELSE 'below-average' END END AS level,
       CASE WHEN ok THEN league = '1-URGENT' END AS longer, CASE WHEN ok THEN debut <= 9 END AS early
FROM p""", ("C25", "I11", "I12", "I13", "I14"))
def q_fixed(spark, sf_dir):
    s = scored(spark, sf_dir)
    text = F.col("interpretation")
    return s.select(
        "request_id", "predicted_seasons", F.element_at("survival_probs", F.lit(3)).alias("s3"), F.element_at("survival_probs", F.lit(10)).alias("s10"), "survival_50pct",
        "confidence", F.regexp_extract(text, "(above-average|an average|below-average) career", 1).alias("level"),
        text.contains("average longer").alias("longer"), text.contains("early era").alias("early"))

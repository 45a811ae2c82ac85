"""Step 7: rank tests on career length across leagues and regional blocs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ranktests as R
from .q_describe import CV, careers_view, r6, sql_r6
from .registry import register

EAST_WEST = {"East": ["ASIA", "MIDDLE EAST"], "West": ["EUROPE", "AMERICA"]}

KW_SQL = CV + """,
rws AS (SELECT CAST(primary_league AS VARCHAR) AS g, CAST(career_length_years AS DOUBLE) AS v FROM cv
        WHERE primary_league IS NOT NULL AND career_length_years IS NOT NULL),
r AS (SELECT g, v, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS mr FROM rws),
tot AS (SELECT count(*) AS n FROM rws),
ties AS (SELECT sum(t * t * t - t) AS tie FROM (SELECT count(*) AS t FROM rws GROUP BY v)),
grp AS (SELECT g, sum(mr) AS rsum, count(*) AS ng FROM r GROUP BY g)
SELECT CAST(count(*) AS BIGINT) AS k, CAST(any_value(tot.n) AS BIGINT) AS n,
       (12.0 / (any_value(tot.n) * (any_value(tot.n) + 1)) * sum(rsum * rsum / ng) - 3.0 * (any_value(tot.n) + 1))
         / (1.0 - any_value(ties.tie) / (pow(any_value(tot.n), 3) - any_value(tot.n))) AS h,
       CAST(count(*) - 1 AS INTEGER) AS df
FROM grp, tot, ties"""


@register("rank_kruskal_wallis", sql_r6(KW_SQL, ["h"]), ("J1",))
def q_kw(spark, sf_dir):
    return r6(R.kruskal_wallis(careers_view(spark, sf_dir), "primary_league", "career_length_years"))


# chi-square upper tail for even df in closed form: exp(-x/2) * sum_{i<df/2} (x/2)^i / i!
KW_P_SQL = sql_r6("SELECT *, CASE WHEN df % 2 = 0 THEN exp(-h / 2) * (SELECT sum(pow(h / 2, i) / factorial(CAST(i AS INTEGER))) "
                  "FROM range(0, CAST(df / 2 AS BIGINT)) r(i)) END AS p_value FROM (" + KW_SQL + ") kw", ["h", "p_value"])


@register("rank_kruskal_wallis_p", KW_P_SQL, ("J1",))
def q_kw_p(spark, sf_dir):
    return r6(R.kruskal_wallis_p(R.kruskal_wallis(careers_view(spark, sf_dir), "primary_league",
                                                  "career_length_years")))


def _mw_sql(rows_sql: str) -> str:
    return CV + f""",
rws AS ({rows_sql}),
gs AS (SELECT DISTINCT g FROM rws),
pairs AS (SELECT x.g AS a, y.g AS b FROM gs x JOIN gs y ON x.g < y.g),
pr AS (SELECT p.a, p.b, r.g, r.v FROM pairs p JOIN rws r ON r.g = p.a OR r.g = p.b),
rk AS (SELECT a, b, g, v, rank() OVER (PARTITION BY a, b ORDER BY v)
                + (count(*) OVER (PARTITION BY a, b, v) - 1) / 2.0 AS mr FROM pr),
tie AS (SELECT a, b, sum(t * t * t - t) AS tie FROM (SELECT a, b, v, count(*) AS t FROM pr GROUP BY a, b, v) GROUP BY a, b),
per AS (SELECT a, b, sum(CASE WHEN g = a THEN mr END) AS ra, count(*) FILTER (WHERE g = a) AS na,
               count(*) FILTER (WHERE g = b) AS nb FROM rk GROUP BY a, b)
SELECT per.a, per.b, CAST(na AS BIGINT) AS n_a, CAST(nb AS BIGINT) AS n_b,
       ra - na * (na + 1) / 2.0 AS u_a, na * nb - (ra - na * (na + 1) / 2.0) AS u_b, CAST(tie AS DOUBLE) AS tie
FROM per JOIN tie USING (a, b)"""


LEAGUE_ROWS = """SELECT CAST(primary_league AS VARCHAR) AS g, CAST(career_length_years AS DOUBLE) AS v FROM cv
                 WHERE primary_league IS NOT NULL AND career_length_years IS NOT NULL"""
BLOC_ROWS = """SELECT CASE WHEN region IN ('ASIA', 'MIDDLE EAST') THEN 'East' ELSE 'West' END AS g,
                      CAST(career_length_years AS DOUBLE) AS v FROM cv
               WHERE region IN ('ASIA', 'MIDDLE EAST', 'EUROPE', 'AMERICA') AND career_length_years IS NOT NULL"""


def _mw_frame(mw):
    return r6(mw.withColumn("tie", F.col("tie").cast("double")))


@register("rank_mann_whitney_pairs", sql_r6(_mw_sql(LEAGUE_ROWS), ["u_a", "u_b", "tie"]), ("J2",))
def q_mw(spark, sf_dir):
    return _mw_frame(R.mann_whitney_pairs(careers_view(spark, sf_dir), "primary_league", "career_length_years"))


@register("rank_mann_whitney_east_west", sql_r6(_mw_sql(BLOC_ROWS), ["u_a", "u_b", "tie"]), ("J2", "F34"))
def q_mw_ew(spark, sf_dir):
    b = R.blocs(careers_view(spark, sf_dir), "region", EAST_WEST)
    return _mw_frame(R.mann_whitney_pairs(b, "bloc", "career_length_years"))


@register("rank_mann_whitney_p", None, ("J2",))
def q_mw_p(spark, sf_dir):
    return R.mann_whitney_p(R.mann_whitney_pairs(careers_view(spark, sf_dir), "primary_league",
                                                 "career_length_years"))

"""Step 10: the analyses the reference documents but never codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import extras as X
from .driver import APPEARANCES_SQL, PANEL_SQL, RULES_SQL, driver_appearances, with_sql
from .q_panel import LONGITUDINAL_CTE
from .q_describe import CV, careers_view, r6, sql_r6
from .registry import register


def _cv_event(spark, sf_dir):
    return careers_view(spark, sf_dir).withColumn("retired", (F.col("current_status") == "Retired").cast("int"))


@register("extra_kaplan_meier", sql_r6(CV + """,
c AS (SELECT segment, CAST(career_length_years AS DOUBLE) AS t,
             sum(CAST(current_status = 'Retired' AS BIGINT)) AS d, count(*) AS c
      FROM cv WHERE career_length_years IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, sum(c) OVER (PARTITION BY segment)
                - coalesce(sum(c) OVER (PARTITION BY segment ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                AS n_at_risk FROM c)
SELECT segment, t, n_at_risk, d,
       CASE WHEN max(CAST(d = n_at_risk AS INTEGER)) OVER w > 0 THEN 0.0
            ELSE exp(sum(CASE WHEN d = n_at_risk THEN 0.0 ELSE ln(1 - d / n_at_risk) END) OVER w) END AS survival
FROM r WINDOW w AS (PARTITION BY segment ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
                                        ["survival"]), ("G5",))
def q_km(spark, sf_dir):
    return r6(X.kaplan_meier(_cv_event(spark, sf_dir), "career_length_years", "retired", "segment"))


@register("extra_logrank", sql_r6(CV + """,
d AS (SELECT CAST(career_length_years AS DOUBLE) AS t, segment AS g, CAST(current_status = 'Retired' AS BIGINT) AS e
      FROM cv WHERE segment IN ('AUTOMOBILE', 'BUILDING') AND career_length_years IS NOT NULL),
per AS (SELECT t, sum(CASE WHEN g = 'AUTOMOBILE' THEN e ELSE 0 END) AS d1, sum(e) AS d,
               count(*) FILTER (WHERE g = 'AUTOMOBILE') AS c1, count(*) AS c FROM d GROUP BY t),
r AS (SELECT *, sum(c1) OVER () - coalesce(sum(c1) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n1,
                sum(c) OVER () - coalesce(sum(c) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n
      FROM per)
SELECT sum(d1) AS observed_a, sum(d * n1 / n) AS expected_a,
       sum(CASE WHEN n > 1 THEN d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1) ELSE 0.0 END) AS variance,
       (sum(d1) - sum(d * n1 / n)) ^ 2 / sum(CASE WHEN n > 1 THEN d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1) ELSE 0.0 END) AS statistic
FROM r WHERE d > 0""", ["expected_a", "variance", "statistic"]), ("G5",))
def q_logrank(spark, sf_dir):
    return r6(X.logrank(_cv_event(spark, sf_dir), "career_length_years", "retired", "segment",
                        "AUTOMOBILE", "BUILDING"))


@register("extra_tier_transitions", with_sql(PANEL_SQL, APPEARANCES_SQL) + """,
per AS (SELECT player, season, arg_max(tier, row_no) AS tier FROM app WHERE tier IS NOT NULL GROUP BY 1, 2),
pr AS (SELECT lag(tier) OVER (PARTITION BY player ORDER BY season) AS from_tier, tier AS to_tier FROM per)
SELECT from_tier, to_tier, count(*) AS n,
       CAST(CASE from_tier WHEN 'S' THEN 1 WHEN 'A' THEN 2 WHEN 'B' THEN 3 WHEN 'C' THEN 4 WHEN 'D' THEN 5 WHEN '?' THEN 6 ELSE 7 END AS INTEGER) AS from_rank,
       CAST(CASE to_tier WHEN 'S' THEN 1 WHEN 'A' THEN 2 WHEN 'B' THEN 3 WHEN 'C' THEN 4 WHEN 'D' THEN 5 WHEN '?' THEN 6 ELSE 7 END AS INTEGER) AS to_rank
FROM pr WHERE from_tier IS NOT NULL GROUP BY 1, 2""", ("G3",))
def q_transitions(spark, sf_dir):
    return X.tier_transitions(driver_appearances(spark, sf_dir), "player", "season", "tier", "row_no")


@register("extra_chi_square", sql_r6(CV + """,
cells AS (SELECT primary_league AS a, current_status AS b, count(*) AS o FROM cv GROUP BY 1, 2),
ra AS (SELECT a, sum(o) AS r FROM cells GROUP BY a), cb AS (SELECT b, sum(o) AS k FROM cells GROUP BY b),
tot AS (SELECT sum(o) AS n FROM cells),
full_ AS (SELECT ra.a, cb.b, ra.r, cb.k, coalesce(cells.o, 0) AS o FROM ra CROSS JOIN cb
          LEFT JOIN cells ON cells.a = ra.a AND cells.b = cb.b)
SELECT sum((o - r * k / n) ^ 2 / (r * k / n)) AS statistic,
       CAST(((SELECT count(*) FROM ra) - 1) * ((SELECT count(*) FROM cb) - 1) AS INTEGER) AS df,
       CAST(any_value(n) AS BIGINT) AS n
FROM full_, tot""", ["statistic"]), ("F26",))
def q_chi(spark, sf_dir):
    return r6(X.chi_square(careers_view(spark, sf_dir), "primary_league", "current_status"))


@register("extra_anova", sql_r6(CV + """,
g AS (SELECT region, count(career_length_years) AS n, sum(career_length_years) AS s,
             sum(career_length_years * career_length_years) AS ss,
             avg(career_length_years) AS m FROM cv WHERE career_length_years IS NOT NULL GROUP BY region),
o AS (SELECT avg(career_length_years) AS gm, count(career_length_years) AS nn FROM cv WHERE career_length_years IS NOT NULL)
SELECT CAST(count(*) AS INTEGER) AS k, CAST(any_value(nn) AS BIGINT) AS n,
       sum(n * (m - gm) ^ 2) AS ss_between, sum(ss - n * m * m) AS ss_within,
       (sum(n * (m - gm) ^ 2) / (count(*) - 1)) / (sum(ss - n * m * m) / (any_value(nn) - count(*))) AS f_statistic
FROM g, o""", ["ss_between", "ss_within", "f_statistic"]), ("F14",))
def q_anova(spark, sf_dir):
    return r6(X.anova_oneway(careers_view(spark, sf_dir), "region", "career_length_years"))


@register("extra_bootstrap_mean_ci", None, ("F14",))
def q_bootstrap(spark, sf_dir):
    return X.bootstrap_mean_ci(careers_view(spark, sf_dir), "region", "career_length_years", "player_id")


@register("model_cross_validation", None, ("I6", "I7"))
def q_cv(spark, sf_dir):
    from .q_models import RF_FEATURES, encoded
    from ..operators import models as M
    return M.cross_validate_forest(encoded(spark, sf_dir), RF_FEATURES, "Career_Seasons", "Player")


def _date_checks(spark, sf_dir):
    from ..sources.tables import read_table
    from .q_wiki import tournaments_view
    from .q_panel import longitudinal
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_shipdate")
    ship = o.join(li, o.o_orderkey == li.l_orderkey)
    lon = longitudinal(spark, sf_dir)
    return X.date_order_checks({
        "order_before_ship": (ship, "o_orderdate", "l_shipdate"),
        "tournament_start_end": (tournaments_view(spark, sf_dir), "DateStart", "DateEnd"),
        "debut_before_first_tier1": (lon, "debut_season", "first_tier1_season"),
        "first_tier1_before_last": (lon, "first_tier1_season", "last_season"),
    })


@register("extra_date_order_checks", with_sql(PANEL_SQL, RULES_SQL, LONGITUDINAL_CTE) + """
SELECT 'order_before_ship' AS "check", count(*) AS n, count(*) FILTER (WHERE o_orderdate IS NOT NULL AND l_shipdate IS NOT NULL) AS n_dated,
       count(*) FILTER (WHERE o_orderdate > l_shipdate) AS n_bad
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
UNION ALL
SELECT 'tournament_start_end', count(*), count(*), count(*) FILTER (WHERE ds > de)
FROM (SELECT strftime(min(o_orderdate), '%Y-%m-%d') AS ds, strftime(max(o_orderdate), '%Y-%m-%d') AS de
      FROM orders GROUP BY o_orderpriority, year(o_orderdate))
UNION ALL
SELECT 'debut_before_first_tier1', count(*), count(*) FILTER (WHERE first_tier1_season IS NOT NULL),
       count(*) FILTER (WHERE debut_season > first_tier1_season) FROM longitudinal
UNION ALL
SELECT 'first_tier1_before_last', count(*), count(*) FILTER (WHERE first_tier1_season IS NOT NULL),
       count(*) FILTER (WHERE first_tier1_season > last_season) FROM longitudinal""", ("F30",))
def q_date_checks(spark, sf_dir):
    return _date_checks(spark, sf_dir)

"""Listings and exports by row: veterans, first rows and types of a table,
players and redirects by themselves, rejected payloads, the model frame on all
six metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import careers, describe as D, wiki as W
from ..sources.landing import normalize_json_payload
from ..sources.tables import read_table
from .driver import PANEL_SQL, RULES_SQL, STATS_SQL, driver_stats, latest_period, with_sql
from .q_careers import CM_CTES, MODEL_LEAGUES, MODEL_ROLES, records
from .q_wiki import ITEM, players, redirects
from .registry import register


@register("veterans_listing", CM_CTES + """
SELECT player_id, primary_league, num_seasons_active AS seasons, career_start_year AS debut, career_end_year AS last_season
FROM cm WHERE num_seasons_active >= 6""", ("D9",))
def q_veterans(spark, sf_dir):
    """Veterans row by row; the panel spans seven years, so six seasons count."""
    return D.veterans_listing(careers.career_metrics(records(spark, sf_dir)), min_len=6)


@register("table_first_rows", """
SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS row,
       to_json({'o_orderkey': o_orderkey, 'o_custkey': o_custkey, 'o_orderstatus': o_orderstatus, 'o_orderpriority': o_orderpriority})::VARCHAR AS value
FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)""", ("F37",))
def q_first_rows(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    o = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", (-F.col("o_totalprice")).alias("p"))
    top = D.first_rows(o, ["p", "o_orderkey"])
    return top.select("row", F.regexp_replace("value", r',"p":[^}]*', "").alias("value"))


@register("table_column_profile", """
WITH n AS (SELECT count(*) AS r, count(o_orderkey) AS a, count(o_custkey) AS b, count(o_totalprice) AS c,
                  count(CASE WHEN year(o_orderdate) >= 1998 THEN o_orderstatus END) AS d, count(o_orderpriority) AS e FROM orders)
SELECT u.x.k AS "column", u.x.t AS type, u.x.v AS non_null, r AS rows, 5 AS n_columns
FROM (SELECT r, unnest([{'k': 'o_orderkey', 't': 'bigint', 'v': a}, {'k': 'o_custkey', 't': 'bigint', 'v': b}, {'k': 'o_totalprice', 't': 'double', 'v': c},
                        {'k': 'late', 't': 'string', 'v': d}, {'k': 'o_orderpriority', 't': 'string', 'v': e}]) AS x FROM n) u""", ("F37",))
def q_profile(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority")
    return D.table_profile(o.select("o_orderkey", "o_custkey", "o_totalprice", F.when(F.year("o_orderdate") >= 1998, F.col("o_orderstatus")).alias("late"), "o_orderpriority"))


@register("wiki_players_only", """
SELECT CAST(c.c_custkey AS VARCHAR) AS "ID", c.c_name AS "Player", n.n_name AS "Country", r.r_name AS "Region", c.c_mktsegment AS "Role",
       concat_ws(', ', r.r_name, n.n_name) AS "Residency"
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""", ("B11",))
def q_players_only(spark, sf_dir):
    return W.players_only(players(spark, sf_dir))


@register("wiki_redirects_only", """
SELECT lower(c_name) AS "AllName", CAST(c_custkey AS VARCHAR) AS "ID" FROM customer
UNION ALL SELECT regexp_replace(c_name, 'Customer#0*', 'C'), CAST(c_custkey AS VARCHAR) FROM customer""", ("B11",))
def q_redirects_only(spark, sf_dir):
    return W.redirects_only(redirects(spark, sf_dir))


@register("json_payload_rejected", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN '"oops"' WHEN 1 THEN '{"other": [' || props || ']}' WHEN 2 THEN '[' || props ELSE '' END AS payload, TRUE AS bad_shape
FROM events WHERE event_type = 'error'""", ("A7",))
def q_rejected(spark, sf_dir):
    """Payloads of no known shape are kept apart, whole, with what stood beside them."""
    e = read_table(spark, sf_dir, "events", "event_id", "event_type", "props")
    k = F.pmod("event_id", F.lit(4))
    bad = (F.when(k == 0, F.lit('"oops"')).when(k == 1, F.concat(F.lit('{"other": ['), F.col("props"), F.lit("]}")))
           .when(k == 2, F.concat(F.lit("["), F.col("props"))).otherwise(F.lit("")))
    payload = F.when(F.col("event_type") == "error", bad).otherwise(F.concat(F.lit('{"data": ['), F.col("props"), F.lit("]}")))
    _, rejected = normalize_json_payload(e.select("event_id", payload.alias("payload")), "payload", ITEM)
    return rejected.withColumnRenamed("_bad_shape", "bad_shape")


METRICS = {"Avg_KDA": ("kda", "number"), "Avg_GPM": ("gpm", "number"), "Avg_CSM": ("csm", "number"), "Avg_DPM": ("dpm", "number"),
           "Avg_WR": ("win_rate", "percent"), "Avg_KP": ("kp", "percent")}


def six_metrics(spark, sf_dir):
    """The stats with the three further rates, as text with dashes, and a share."""
    g = F.col("games").cast("int")
    return driver_stats(spark, sf_dir).withColumns({
        "gpm": (F.lit(300) + g).cast("string"), "csm": F.when(g % 7 == 0, "-").otherwise((g % 10).cast("string")),
        "dpm": (g * 12.5).cast("string"), "kp": F.when(g % 5 == 0, "").otherwise(F.concat((g % 100).cast("string"), F.lit(".5%")))})


@register("model_frame_six_metrics", with_sql(PANEL_SQL, RULES_SQL, STATS_SQL) + """
, s AS (SELECT *, CAST(games AS INTEGER) AS g FROM stats),
firsts AS (
  SELECT player,
         arg_min(trim(league), season * 100000000000 + row_no) FILTER (WHERE league IS NOT NULL AND trim(league) <> '') AS league,
         arg_min(trim(role), season * 100000000000 + row_no) FILTER (WHERE role IS NOT NULL AND trim(role) <> '') AS role,
         count(DISTINCT season) AS cs, max(season) AS ls, min(season) AS debut, round(avg(kda), 3) AS kda, round(avg(300.0::DOUBLE + g), 3) AS gpm,
         round(avg(CASE WHEN g % 7 <> 0 THEN (g % 10)::DOUBLE END), 3) AS csm, round(avg(g * 12.5::DOUBLE), 3) AS dpm,
         round(avg(replace(win_rate, '%', '')::DOUBLE), 3) AS wr, round(avg(CASE WHEN g % 5 <> 0 THEN g % 100 + 0.5::DOUBLE END), 3) AS kp, sum(g)::BIGINT AS tg
  FROM s GROUP BY player)
SELECT player AS "Player", CAST(cs AS INTEGER) AS "Career_Seasons", CAST(ls <> (SELECT max(season) FROM stats) AS INTEGER) AS "Observed",
       league AS "League", trim(role) AS "Role", CAST(debut AS INTEGER) AS "Debut", CAST(debut <= 1997 AS INTEGER) AS "Early_Era", kda AS "Avg_KDA", gpm AS "Avg_GPM",
       csm AS "Avg_CSM", dpm AS "Avg_DPM", wr AS "Avg_WR", kp AS "Avg_KP", tg AS "Total_Games"
FROM firsts WHERE league IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') AND role IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')""", ("F3", "C16"))
def q_six(spark, sf_dir):
    return careers.model_frame(six_metrics(spark, sf_dir), metrics=METRICS, valid_leagues=MODEL_LEAGUES, valid_roles=MODEL_ROLES, era_cutoff=1997,
                               max_season=latest_period(spark, sf_dir))

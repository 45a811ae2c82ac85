"""The entity panel over the driver's TPC-H-style tables.

``entity = o_custkey``, ``period = year(o_orderdate)``, ``split = 'Q' || quarter``,
``date = o_orderdate``, ``league = o_orderpriority``, ``role = c_mktsegment``,
``region = r_name``, ``country = n_name``, ``team`` = supplier of the order's
first line (ordered by line number, then supplier), ``value = o_totalprice``,
``row_id = o_orderkey``.

Plan shape: only the parts a query uses are joined (``need``).  Orders meet
customers on ``o_custkey`` (both large: shuffle join, AQE splits a hot
customer); nation ⋈ region is a fixed 25-row dimension, broadcast after a
size check; the first-line supplier is a partial aggregate of lineitem on
``l_orderkey`` joined on the order key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rules import rules_frame
from ..session import broadcast_by_estimate
from ..sources.tables import read_table

ALL_PARTS = ("role", "region", "country", "team", "value", "date", "status")

# Rule table for the driver panel: urgent orders are tier 1, high priority is a
# named tier-2 league, everything else falls to the default rule.
DRIVER_RULES = [
    ("1-URGENT", "exact", 1, "FAST"),
    ("high", "contains", 2, "PRIORITY"),
    ("__DEFAULT__", "default", 2, "Unknown"),
]


def latest_period(spark: SparkSession, sf_dir: str):
    """Newest period as a scalar subquery over the one column it needs."""
    o = read_table(spark, sf_dir, "orders", "o_orderdate")
    return o.agg(F.max(F.year("o_orderdate"))).scalar()


def driver_rules(spark: SparkSession) -> DataFrame:
    return rules_frame(spark, DRIVER_RULES)


def dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    nr = n.join(broadcast_by_estimate(r), n.n_regionkey == r.r_regionkey, "left")
    return broadcast_by_estimate(nr.select("n_nationkey", "n_name", "r_name"))


def first_line_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier of each order's first line: lowest line number, then lowest
    supplier, nulls last.

    Line and supplier are packed into one decimal, line * 10^20 + supplier +
    10^19 (a null line counts as 2^33, a null supplier as 5 * 10^19), so that the
    minimum is a hash aggregate over a fixed-width value; ``min_by`` over a
    struct would sort all lines first."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey")
    line = "coalesce(cast(l_linenumber as decimal(20, 0)) + 2147483648, cast(8589934592 as decimal(20, 0)))"
    supplier = "coalesce(cast(l_suppkey as decimal(20, 0)) + 10000000000000000000, cast(50000000000000000000 as decimal(20, 0)))"
    packed = F.expr(f"cast({line} * cast(100000000000000000000 as decimal(21, 0)) + {supplier} as decimal(38, 0))")
    low = li.groupBy("l_orderkey").agg(F.min(packed).alias("_p"))
    rest = F.expr("cast(_p % cast(100000000000000000000 as decimal(21, 0)) as decimal(38, 0))")
    return low.withColumn("_s", rest).select(
        "l_orderkey", F.expr("case when _s < 50000000000000000000 then cast(_s - 10000000000000000000 as bigint) end").alias("team"))


def driver_panel(spark: SparkSession, sf_dir: str, need: tuple[str, ...] = ALL_PARTS) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate",
                   "o_orderpriority", "o_totalprice", "o_orderstatus")
    df = o.select(
        F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").alias("entity"),
        F.year("o_orderdate").cast("int").alias("period"),
        F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string")).alias("split"),
        F.col("o_orderdate").alias("date"),
        F.col("o_orderpriority").alias("league"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderkey").alias("row_id"),
    )
    if any(p in need for p in ("role", "region", "country")):
        c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
        df = df.join(c, df.entity == c.c_custkey, "left")
        if "region" in need or "country" in need:
            d = dims(spark, sf_dir)
            df = df.join(d, df.c_nationkey == d.n_nationkey, "left")
            df = df.withColumnsRenamed({"r_name": "region", "n_name": "country"})
        df = df.withColumnRenamed("c_mktsegment", "role")
    if "team" in need:
        t = first_line_supplier(spark, sf_dir)
        df = df.join(t, df.row_id == t.l_orderkey, "left")
    keep = ["entity", "period", "split", "date", "league", "value", "row_id"] + \
        [p for p in ("role", "region", "country", "team", "status") if p in need]
    return df.select(*keep)


# Shared oracle view text (DuckDB): the same panel, written independently with
# a window for the first line instead of an aggregate.
PANEL_SQL = """
panel AS (
  SELECT o.o_custkey AS entity,
         CAST(year(o.o_orderdate) AS INTEGER) AS period,
         'Q' || CAST(quarter(o.o_orderdate) AS VARCHAR) AS split,
         o.o_orderdate AS date,
         o.o_orderpriority AS league,
         o.o_totalprice AS value,
         o.o_orderkey AS row_id,
         o.o_orderstatus AS status,
         c.c_mktsegment AS role,
         r.r_name AS region,
         n.n_name AS country,
         fl.l_suppkey AS team
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT l_orderkey, l_suppkey FROM (
               SELECT l_orderkey, l_suppkey,
                      row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) AS rn
               FROM lineitem) WHERE rn = 1) fl ON fl.l_orderkey = o.o_orderkey
)"""

RULES_SQL = """
rules(league_pattern, match_mode, tier, region, rule_no) AS (
  VALUES ('1-URGENT', 'exact', 1, 'FAST', 0),
         ('high', 'contains', 2, 'PRIORITY', 1),
         ('__DEFAULT__', 'default', 2, 'Unknown', 2)
),
league_map AS (
  SELECT league_key, tier, region FROM (
    SELECT l.league_key, r.tier, r.region,
           row_number() OVER (PARTITION BY l.league_key
                              ORDER BY r.match_mode = 'default',
                                       CASE WHEN r.match_mode = 'default' THEN 0 ELSE length(r.league_pattern) END DESC, r.rule_no) AS rn
    FROM (SELECT DISTINCT league AS league_key FROM panel) l
    JOIN rules r ON (r.match_mode = 'exact' AND trim(coalesce(l.league_key, '')) = trim(r.league_pattern))
                 OR (r.match_mode = 'contains' AND contains(lower(trim(coalesce(l.league_key, ''))), lower(trim(r.league_pattern))))
                 OR r.match_mode = 'default'
  ) WHERE rn = 1
),
tiered AS (
  SELECT p.*, coalesce(m.tier, 2) AS tier, coalesce(m.region, 'Unknown') AS region_m
  FROM panel p LEFT JOIN league_map m ON p.league IS NOT DISTINCT FROM m.league_key
)"""

SPLIT_RANK_SQL = """CASE WHEN split IS NULL THEN 100
  WHEN contains(lower(split), 'play-in') THEN 5 WHEN contains(lower(split), 'spring') THEN 10
  WHEN contains(lower(split), 'summer') THEN 20 WHEN contains(lower(split), 'split 1') THEN 15
  WHEN contains(lower(split), 'split 2') THEN 25 WHEN contains(lower(split), 'winter') THEN 8
  WHEN contains(lower(split), 'fall') THEN 30 WHEN contains(lower(split), 'playoffs') THEN 40
  WHEN contains(lower(split), 'showmatch') THEN 50 WHEN contains(lower(split), 'qualifier') THEN 3
  ELSE 35 END"""


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def driver_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity × period) stats panel over the driver tables, landed as text the
    way season files arrive: games and win rate are strings ('62%')."""
    from ..operators.rules import assign_tier_region
    p = driver_panel(spark, sf_dir, need=("role", "country", "team"))
    p = assign_tier_region(p, "league", driver_rules(spark), "tier_no", "region_m")
    return _stats_select(p)


def _stats_select(p: DataFrame) -> DataFrame:
    return p.select(
        F.col("entity").cast("string").alias("player"),
        F.col("period").alias("season"),
        F.col("row_id").alias("row_no"),
        F.col("team").cast("string").alias("team"),
        F.col("league"),
        F.col("role"),
        F.when(F.col("tier_no") == 1, "S").otherwise("A").alias("tier"),
        F.col("country"),
        F.floor(F.col("value") / 10000).cast("int").cast("string").alias("games"),
        F.concat(F.floor(100 * F.col("value") / (F.col("value") + 100000)).cast("int").cast("string"),
                 F.lit("%")).alias("win_rate"),
        (F.col("value") / 9973).alias("kda"),
    )


STATS_SQL = """
stats AS (
  SELECT CAST(entity AS VARCHAR) AS player, period AS season, row_id AS row_no,
         CAST(team AS VARCHAR) AS team, league, role,
         CASE WHEN tier = 1 THEN 'S' ELSE 'A' END AS tier, country,
         CAST(CAST(floor(value / 10000) AS INTEGER) AS VARCHAR) AS games,
         CAST(CAST(floor(100 * value / (value + 100000)) AS INTEGER) AS VARCHAR) || '%' AS win_rate,
         value / 9973 AS kda
  FROM tiered
)"""


# Appearance panel for the movement operators: each order is an appearance of
# the customer with the order's first-line supplier as team.  League is the
# order status (F/O/P, encounter order in that list); the tier letter comes
# from the priority: 1 -> S, 2 -> A, 3 -> B, 5 -> C, anything else '?'.
STATUS_ORDER = ["F", "O", "P"]
PRIORITY_TIER = {"1-URGENT": "S", "2-HIGH": "A", "3-MEDIUM": "B", "5-LOW": "C"}


def driver_appearances(spark: SparkSession, sf_dir: str, need: tuple[str, ...] = ("role", "region")) -> DataFrame:
    """One row per order with its team; ``need`` names the customer columns
    wanted, so that queries without them read and join no customer table."""
    from ..functions.clean import map_literal
    p = driver_panel(spark, sf_dir, need=(*need, "team", "status"))
    lno = F.array_position(F.array(*[F.lit(s) for s in STATUS_ORDER]), F.col("status")).cast("int")
    d = F.date_format("date", "yyyy-MM-dd")
    return p.where(F.col("team").isNotNull()).select(
        F.col("entity").cast("string").alias("player"),
        F.col("period").alias("season"),
        F.col("period").alias("year"),
        d.alias("date"),
        F.col("team").cast("string").alias("team"),
        F.col("status").alias("league"),
        lno.alias("league_no"),
        F.coalesce(F.element_at(map_literal(PRIORITY_TIER), F.col("league")), F.lit("?")).alias("tier"),
        *need,
        F.col("row_id").alias("row_no"),
        F.struct(lno.alias("league_no"), d.alias("date"), F.col("row_id").alias("row_no")).alias("enc"),
    )


APPEARANCES_SQL = """
app AS (
  SELECT CAST(entity AS VARCHAR) AS player, period AS season, period AS year,
         strftime(date, '%Y-%m-%d') AS date, CAST(team AS VARCHAR) AS team, status AS league,
         CASE status WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 ELSE 0 END AS league_no,
         CASE league WHEN '1-URGENT' THEN 'S' WHEN '2-HIGH' THEN 'A' WHEN '3-MEDIUM' THEN 'B'
                     WHEN '5-LOW' THEN 'C' ELSE '?' END AS tier,
         role, region, row_id AS row_no
  FROM panel WHERE team IS NOT NULL
)"""


# The same stats under names that the lookup tables know: four roles and four
# leagues in their spellings, one of each unknown, countries by nation number.
NAMED_ROLE = {"AUTOMOBILE": "Top", "BUILDING": "jng", "FURNITURE": "Middle", "HOUSEHOLD": "AD Carry"}
NAMED_LEAGUE = {"1-URGENT": "LCK", "2-HIGH": "EU LCS", "3-MEDIUM": "NALCS", "5-LOW": "LMS"}
NAMED_COUNTRY = ["South Korea", "China", " Denmark ", "Atlantis", ""]


def driver_stats_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.clean import map_literal
    number = F.regexp_extract("country", r"(\d+)$", 1).try_cast("int")
    return driver_stats(spark, sf_dir).withColumns({
        "role": F.coalesce(F.element_at(map_literal(NAMED_ROLE), F.col("role")), F.lit("Analyst")),
        "league": F.coalesce(F.element_at(map_literal(NAMED_LEAGUE), F.col("league")), F.lit("Nowhere Cup")),
        "country": F.get(F.array(*[F.lit(c) for c in NAMED_COUNTRY]), number % 5)})


NAMED_SQL = """
named AS (
  SELECT player, season, row_no, team,
         CASE league WHEN '1-URGENT' THEN 'LCK' WHEN '2-HIGH' THEN 'EU LCS' WHEN '3-MEDIUM' THEN 'NALCS' WHEN '5-LOW' THEN 'LMS' ELSE 'Nowhere Cup' END AS league,
         CASE role WHEN 'AUTOMOBILE' THEN 'Top' WHEN 'BUILDING' THEN 'jng' WHEN 'FURNITURE' THEN 'Middle' WHEN 'HOUSEHOLD' THEN 'AD Carry' ELSE 'Analyst' END AS role,
         tier, ['South Korea', 'China', ' Denmark ', 'Atlantis', ''][1 + CAST(regexp_extract(country, '(\\d+)$', 1) AS INTEGER) % 5] AS country,
         games, win_rate, kda
  FROM stats
)"""

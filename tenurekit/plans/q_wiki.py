"""Step 6: wiki-table queries on views derived from the driver tables.

players      <- customer ⋈ nation ⋈ region   (ID, Player, Country, Region, Role, Residency list)
tournaments  <- orders per (priority, year)   (OverviewPage, League, Region, Year, DateStart, ...)
roster       <- orders ⋈ customer             (Player, Team, OverviewPage, Role, DateJoin)
scoreboard   <- lineitem (Link, GameId); games <- orders (GameId, Tournament)
redirects    <- two alternate spellings of every customer name
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import wiki as W
from ..sources.landing import normalize_json_payload
from ..sources.tables import read_table
from .driver import dims
from .registry import register


def players(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    d = dims(spark, sf_dir)
    return c.join(d, c.c_nationkey == d.n_nationkey, "left").select(
        F.col("c_custkey").cast("string").alias("ID"), F.col("c_name").alias("Player"),
        F.col("n_name").alias("Country"), F.col("r_name").alias("Region"),
        F.col("c_mktsegment").alias("Role"),
        F.concat_ws(", ", F.col("r_name"), F.col("n_name")).alias("Residency"))


PLAYERS_SQL = """players AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS "ID", c.c_name AS "Player", n.n_name AS "Country", r.r_name AS "Region",
         c.c_mktsegment AS "Role", concat_ws(', ', r.r_name, n.n_name) AS "Residency"
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def _page(o_orderpriority, o_orderdate):
    return F.concat(o_orderpriority, F.lit("/"), F.year(o_orderdate).cast("string"))


def tournaments_view(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderpriority", "o_orderdate")
    return (o.groupBy(F.col("o_orderpriority").alias("League"), F.year("o_orderdate").alias("Year"))
            .agg(F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("DateStart"),
                 F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("DateEnd"))
            .select(F.concat("League", F.lit("/"), F.col("Year").cast("string")).alias("OverviewPage"),
                    F.concat("League", F.lit("/"), F.col("Year").cast("string")).alias("Name"),
                    "League", F.when(F.col("League").isin("1-URGENT", "2-HIGH"), "Korea").otherwise("Europe").alias("Region"),
                    F.col("Year").cast("int").alias("Year"), "DateStart", "DateEnd",
                    (F.col("League") == "5-LOW").alias("IsQualifier"),
                    F.when(F.col("League") == "1-URGENT", "Primary").when(F.col("League") == "2-HIGH", "Secondary")
                    .otherwise("Tertiary").alias("TournamentLevel")))


TOURN_SQL = """tournaments AS (
  SELECT o_orderpriority || '/' || CAST(year(o_orderdate) AS VARCHAR) AS "OverviewPage",
         o_orderpriority || '/' || CAST(year(o_orderdate) AS VARCHAR) AS "Name",
         o_orderpriority AS "League",
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Korea' ELSE 'Europe' END AS "Region",
         CAST(year(o_orderdate) AS INTEGER) AS "Year",
         strftime(min(o_orderdate), '%Y-%m-%d') AS "DateStart", strftime(max(o_orderdate), '%Y-%m-%d') AS "DateEnd",
         o_orderpriority = '5-LOW' AS "IsQualifier",
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Primary' WHEN '2-HIGH' THEN 'Secondary' ELSE 'Tertiary' END AS "TournamentLevel"
  FROM orders GROUP BY o_orderpriority, year(o_orderdate))"""


def roster_view(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        F.col("c_name").alias("Player"), F.concat(F.lit("Team"), F.col("o_orderstatus")).alias("Team"),
        _page(F.col("o_orderpriority"), F.col("o_orderdate")).alias("OverviewPage"),
        F.col("c_mktsegment").alias("Role"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("DateJoin"),
        F.col("o_orderkey").alias("row_id"))


ROSTER_SQL = """roster AS (
  SELECT c.c_name AS "Player", 'Team' || o.o_orderstatus AS "Team",
         o.o_orderpriority || '/' || CAST(year(o.o_orderdate) AS VARCHAR) AS "OverviewPage",
         c.c_mktsegment AS "Role", strftime(o.o_orderdate, '%Y-%m-%d') AS "DateJoin", o.o_orderkey AS row_id
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""


def W_(*ctes):
    return "WITH " + ",\n".join(ctes)


@register("wiki_generic_query", W_(PLAYERS_SQL) + """
SELECT "Player" AS name, "Country" AS country FROM players WHERE "Region" = 'EUROPE'
ORDER BY "Player" LIMIT 100 OFFSET 20""", ("B1", "B6"))
def q_generic(spark, sf_dir):
    return W.panel_query(players(spark, sf_dir), fields={"name": "Player", "country": "Country"},
                         where="Region = 'EUROPE'", order_by=["name"], limit=100, offset=20)


@register("wiki_players_region", W_(PLAYERS_SQL) + """
SELECT * FROM players WHERE "Region" = 'ASIA' ORDER BY "Player\"""", ("B2", "B11"))
def q_players_region(spark, sf_dir):
    return W.all_players(players(spark, sf_dir), "ASIA")


@register("wiki_player_history", W_(ROSTER_SQL) + """
SELECT * FROM roster WHERE "Player" = 'Customer#000000001' ORDER BY "DateJoin\"""", ("B3",))
def q_history(spark, sf_dir):
    return W.player_history(roster_view(spark, sf_dir), "Customer#000000001")


@register("wiki_tournaments", W_(TOURN_SQL) + """
SELECT * FROM tournaments WHERE "Region" = 'Korea' AND starts_with("DateStart", '1997')
ORDER BY "DateStart" DESC""", ("B4",))
def q_tourn(spark, sf_dir):
    return W.tournaments(tournaments_view(spark, sf_dir), "Korea", 1997)


@register("wiki_holds", W_(PLAYERS_SQL) + """
SELECT * FROM players WHERE list_contains(list_transform(string_split("Residency", ','), lambda x: trim(x)), 'NATION_3')""",
          ("B5",))
def q_holds(spark, sf_dir):
    p = players(spark, sf_dir)
    return p.where(W.holds("Residency", "NATION_3"))


@register("wiki_export_tournaments", W_(TOURN_SQL) + """
SELECT * FROM tournaments WHERE "Year" >= 1997 AND NOT "IsQualifier" ORDER BY "Year", "DateStart\"""", ("B7",))
def q_export_t(spark, sf_dir):
    return W.export_tournaments(tournaments_view(spark, sf_dir), 1997, "NOT IsQualifier")


def scoreboard(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber")
    return li.select(F.col("l_suppkey").cast("string").alias("Link"),
                     F.col("l_orderkey").cast("string").alias("GameId"), "l_linenumber")


def games(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderdate")
    return o.select(F.col("o_orderkey").cast("string").alias("GameId"),
                    _page(F.col("o_orderpriority"), F.col("o_orderdate")).alias("Tournament"))


SB_SQL = """sb AS (SELECT CAST(l_suppkey AS VARCHAR) AS "Link", CAST(l_orderkey AS VARCHAR) AS "GameId", l_linenumber FROM lineitem),
games AS (SELECT CAST(o_orderkey AS VARCHAR) AS "GameId",
                 o_orderpriority || '/' || CAST(year(o_orderdate) AS VARCHAR) AS "Tournament" FROM orders)"""


@register("wiki_scoreboard_year", W_(SB_SQL) + """
SELECT * FROM sb JOIN games USING ("GameId") WHERE contains("Tournament", '1998') OR contains("GameId", '1998')""",
          ("B8",))
def q_sb_year(spark, sf_dir):
    return W.scoreboard_for_year(scoreboard(spark, sf_dir).join(games(spark, sf_dir), "GameId"), 1998)


@register("wiki_tournament_players", W_(ROSTER_SQL) + """
SELECT "Player", "Team", "OverviewPage" AS "Tournament", "Role" FROM roster WHERE "Role" = 'MACHINERY'""", ("B9",))
def q_tp(spark, sf_dir):
    return W.tournament_players(roster_view(spark, sf_dir), "Role = 'MACHINERY'")


def redirects(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    a = c.select(F.lower("c_name").alias("AllName"), F.col("c_custkey").cast("string").alias("ID"))
    b = c.select(F.regexp_replace("c_name", "Customer#0*", "C").alias("AllName"),
                 F.col("c_custkey").cast("string").alias("ID"))
    return a.unionByName(b)


@register("wiki_alias_resolution", W_(PLAYERS_SQL, """redirects AS (
  SELECT lower(c_name) AS "AllName", CAST(c_custkey AS VARCHAR) AS "ID" FROM customer
  UNION ALL
  SELECT regexp_replace(c_name, 'Customer#0*', 'C') AS "AllName", CAST(c_custkey AS VARCHAR) AS "ID" FROM customer)""") + """
SELECT r."ID", r."AllName", p."Player", p."Country", p."Region", p."Role", p."Residency"
FROM redirects r JOIN players p ON r."ID" = p."ID\"""", ("B10",))
def q_alias(spark, sf_dir):
    return W.resolve_aliases(redirects(spark, sf_dir), players(spark, sf_dir)).select(
        "ID", "AllName", "Player", "Country", "Region", "Role", "Residency")


@register("wiki_roster_in_range", W_(ROSTER_SQL, TOURN_SQL) + """
SELECT r.*, t."Name", t."League", t."Region", t."Year", t."DateStart", t."DateEnd", t."IsQualifier", t."TournamentLevel"
FROM roster r JOIN tournaments t ON r."OverviewPage" = t."OverviewPage"
WHERE t."DateStart" BETWEEN '1996-01-01' AND '1996-12-31' AND t."League" = '1-URGENT'""", ("B12",))
def q_roster_range(spark, sf_dir):
    return W.roster_in_range(roster_view(spark, sf_dir), tournaments_view(spark, sf_dir),
                             "1996-01-01", "1996-12-31", league="1-URGENT")


@register("wiki_scoreboard_join", W_(SB_SQL, TOURN_SQL) + """
SELECT t."League", t."Year", count(*) AS n_rows, count(DISTINCT s."Link") AS n_links
FROM sb s JOIN games g ON s."GameId" = g."GameId" JOIN tournaments t ON g."Tournament" = t."OverviewPage"
GROUP BY t."League", t."Year\"""", ("B13",))
def q_sb_join(spark, sf_dir):
    j = W.scoreboard_join(scoreboard(spark, sf_dir), games(spark, sf_dir), tournaments_view(spark, sf_dir))
    return j.groupBy("League", "Year").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("Link").alias("n_links"))


@register("wiki_batched_lookup", W_(PLAYERS_SQL) + """
SELECT * FROM players WHERE "ID" IN (
  SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1998)""",
          ("B14", "D7", "E10"))
def q_lookup(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_custkey", "o_orderpriority", "o_orderdate")
    keys = o.where((F.col("o_orderpriority") == "1-URGENT") & (F.year("o_orderdate") == 1998)).select(
        F.col("o_custkey").cast("string").alias("ID"))
    return W.lookup_ids(players(spark, sf_dir), keys)


PROBES = ["Customer#000000001", "customer#00000012", "Nobody", "NATION"]


@register("wiki_name_probe", W_(PLAYERS_SQL, """probes(probe) AS (VALUES ('Customer#000000001'), ('customer#00000012'), ('Nobody'), ('NATION')),
names AS (SELECT DISTINCT "Player" AS name FROM players WHERE "Player" IS NOT NULL),
st AS (SELECT p.probe, EXISTS (SELECT 1 FROM names n WHERE n.name = p.probe) AS found FROM probes p)""") + """
SELECT probe, found, CAST(NULL AS VARCHAR) AS suggestion FROM st WHERE found
UNION ALL
SELECT st.probe, st.found, n.name AS suggestion FROM st LEFT JOIN names n ON contains(lower(n.name), lower(st.probe))
WHERE NOT st.found""", ("B15", "H3", "E10"))
def q_probe(spark, sf_dir):
    return W.name_probe(players(spark, sf_dir), PROBES)


ITEM = T.StructType([T.StructField("k", T.LongType())])


@register("json_payload_normalize", """
WITH payloads AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN '"oops"'
                        WHEN event_id % 3 = 0 THEN '[' || props || ', 5]'
                        WHEN event_id % 3 = 1 THEN '{"rows": [' || props || ']}'
                        ELSE '{"cargoquery": [{"title": ' || props || '}]}' END AS payload
  FROM events)
SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events WHERE event_type <> 'error'""", ("A7",))
def q_json(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", "event_id", "event_type", "props")
    payload = (F.when(F.col("event_type") == "error", F.lit('"oops"'))
               .when(F.pmod("event_id", F.lit(3)) == 0, F.concat(F.lit("["), F.col("props"), F.lit(", 5]")))
               .when(F.pmod("event_id", F.lit(3)) == 1, F.concat(F.lit('{"rows": ['), F.col("props"), F.lit("]}")))
               .otherwise(F.concat(F.lit('{"cargoquery": [{"title": '), F.col("props"), F.lit("}]}"))))
    good, _bad = normalize_json_payload(e.select(payload.alias("payload")), "payload", ITEM)
    return good

"""Queries over landed wiki tables.

The reference sends these as remote queries, page by page; here they are
plain DataFrame operators over the landed tables, so Catalyst pushes the
filters and projections into the scans and no paging is needed to read.
Errors raise instead of returning an empty list.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small


def _expr(e) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def panel_query(df: DataFrame, fields: dict[str, str | Column] | Sequence[str] | None = None,
                where: str | Column | None = None, join: tuple | None = None,
                order_by: Sequence[str | Column] = (), limit: int | None = None,
                offset: int = 0) -> DataFrame:
    """B1 + B6: select/alias, filter, join, order, page.

    ``join`` is ``(other, on, how)``.  ``limit``/``offset`` give one ordered
    page (the page size is the feature; a scan never needs paging)."""
    if join is not None:
        other, on, how = join
        df = df.join(other, on, how)
    if where is not None:
        df = df.where(_expr(where))
    if fields:
        if isinstance(fields, dict):
            df = df.select(*[_expr(e).alias(a) for a, e in fields.items()])
        else:
            df = df.select(*[_expr(e) for e in fields])
    if order_by:
        df = df.orderBy(*[_expr(o) for o in order_by])
    if offset:
        df = df.offset(offset)
    if limit is not None:
        df = df.limit(limit)
    return df


def all_players(players: DataFrame, region: str | None = None, region_col: str = "Region",
                name_col: str = "Player") -> DataFrame:
    """B2: optional equality filter, sorted by name."""
    if region is not None:
        players = players.where(F.col(region_col) == region)
    return players.orderBy(name_col)


def player_history(tenures: DataFrame, player: str, player_col: str = "Player",
                   join_col: str = "DateJoin") -> DataFrame:
    """Tenures of one player by join date."""
    return tenures.where(F.col(player_col) == player).orderBy(join_col)


def tournaments(t: DataFrame, region: str | None = None, year: int | None = None) -> DataFrame:
    """Optional region equality and year (DateStart starts with the year),
    newest first."""
    conds = []
    if region is not None:
        conds.append(F.col("Region") == region)
    if year is not None:
        conds.append(F.col("DateStart").cast("string").startswith(str(year)))
    for c in conds:
        t = t.where(c)
    return t.orderBy(F.col("DateStart").desc())


def holds(c: str | Column, code: str, sep: str = ",") -> Column:
    """List-valued field membership (``HOLDS``)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_contains(F.transform(F.split(col, sep), lambda x: F.trim(x)), code)


def export_tournaments(t: DataFrame, year_min: int, extra_where: str | None = None) -> DataFrame:
    """Year >= year_min AND an extra predicate, sorted by Year, DateStart."""
    t = t.where(F.col("Year") >= year_min)
    if extra_where:
        t = t.where(F.expr(extra_where))
    return t.orderBy("Year", "DateStart")


def scoreboard_for_year(sp: DataFrame, year: int) -> DataFrame:
    """Rows whose Tournament or GameId mentions the year."""
    y = str(year)
    return sp.where(F.col("Tournament").contains(y) | F.col("GameId").contains(y))


def tournament_players(tp: DataFrame, extra_where: str | None = None) -> DataFrame:
    """Projection with rename (OverviewPage -> Tournament)."""
    if extra_where:
        tp = tp.where(F.expr(extra_where))
    return tp.select("Player", "Team", F.col("OverviewPage").alias("Tournament"), "Role")


def resolve_aliases(redirects: DataFrame, players: DataFrame, id_col: str = "ID") -> DataFrame:
    """One row per alternate name with the player it resolves to
    (unmatched redirects dropped)."""
    return redirects.join(players, id_col, "inner")


def roster_in_range(roster: DataFrame, tourn: DataFrame, start: str, end: str,
                    league: str | None = None, player: str | None = None) -> DataFrame:
    """Roster ⋈ tournaments on OverviewPage with the date range (and
    optional league / player equality) applied to the tournament side first."""
    t = tourn.where(F.col("DateStart").between(start, end))
    if league is not None:
        t = t.where(F.col("League") == league)
    r = roster if player is None else roster.where(F.col("Player") == player)
    return r.join(t, "OverviewPage")


def scoreboard_join(sp: DataFrame, games: DataFrame, tourn: DataFrame) -> DataFrame:
    """Scoreboard players ⋈ games (GameId) ⋈ tournaments."""
    return sp.join(games, "GameId").join(tourn, F.col("Tournament") == F.col("OverviewPage"))


def lookup_ids(players: DataFrame, keys: DataFrame, id_col: str = "ID") -> DataFrame:
    """``ID IN (...)`` as a semi-join with the key list (no batching)."""
    return players.join(keys.select(id_col).distinct(), id_col, "left_semi")


def name_probe(names: DataFrame, probes: Iterable[str] | DataFrame, name_col: str = "Player") -> DataFrame:
    """For each probe name: found by exact match; if not found, one row
    per distinct name containing it (case-insensitive) as a suggestion.  Rows
    rather than a list, so a probe that matches many names never builds one
    big value.  The probe list is broadcast where its row count allows; the
    names table is streamed through the nested-loop match."""
    spark = names.sparkSession
    if not isinstance(probes, DataFrame):
        probes = spark.createDataFrame([(p,) for p in probes], "probe string")
    probes = broadcast_if_small(probes.select("probe").distinct())
    distinct_names = names.select(F.col(name_col).alias("name")).where(F.col("name").isNotNull()).distinct()
    exact = (distinct_names.join(probes, F.col("name") == F.col("probe"), "inner")
             .select("probe").distinct().withColumn("found", F.lit(True)))
    status = probes.join(exact, "probe", "left").select(
        "probe", F.coalesce(F.col("found"), F.lit(False)).alias("found"))
    sugg = (distinct_names.join(probes, F.lower(F.col("name")).contains(F.lower(F.col("probe"))), "inner")
            .select("probe", F.col("name").alias("suggestion")))
    missing = status.where(~F.col("found"))
    return (status.where(F.col("found")).withColumn("suggestion", F.lit(None).cast("string"))
            .unionByName(missing.join(sugg, "probe", "left")))


def players_only(players: DataFrame) -> DataFrame:
    """The players table by itself, by id."""
    return players.orderBy("ID")


def redirects_only(redirects: DataFrame) -> DataFrame:
    """Alternate names by themselves, with or without a player, by id and name."""
    return redirects.select("AllName", "ID").orderBy("ID", "AllName")

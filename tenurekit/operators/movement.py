"""Movement between teams and tiers.

Rows are appearances ``(entity, season, date, team, tier letter, league,
role, encounter order)``.  Everything is computed with partial aggregates on
``(entity, season, team)`` and then ``(entity, season)``; lists are built only
over the *distinct teams* of one entity-season, never over its rows.  The
tier-change operator (G3) runs its window over one row per (entity, season)
and joins the result back, so a hot entity never lands in one window task
with all of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean, maps


def _rank99(c: Column) -> Column:
    """Tier rank for move detection: S..D = 0..4, '?' (or unknown) = 99."""
    pos = F.array_position(F.array(*[F.lit(t) for t in maps.TIER_ORDER]), c)
    return F.when((c == "?") | (pos == 0) | c.isNull(), F.lit(99)).otherwise(pos - 1)


def first_appearance_per_team(app: DataFrame, entity="player", season="season", team="team",
                              date="date", tier="tier", league="league",
                              enc="enc") -> DataFrame:
    """Keep each team's first encountered appearance within (entity, season)."""
    return app.groupBy(entity, season, team).agg(
        F.min_by(F.struct(F.col(date).alias("date"), F.col(tier).alias("tier"),
                          F.col(league).alias("league"), F.col(enc).alias("enc")),
                 F.col(enc)).alias("a"))


def detect_moves(app: DataFrame, entity="player", season="season", team="team", date="date",
                 tier="tier", league="league", enc="enc") -> DataFrame:
    """Classify the movement within each (entity, season).

    Appearances are de-duplicated by team (first encounter kept) and ordered
    by date, ties by encounter order.  One team -> ''; first and last league
    differ and both known -> Transfer; at most one known tier -> Roster;
    else Promotion / Relegation / Roster by first vs last tier rank ('?' = 99).
    """
    firsts = first_appearance_per_team(app, entity, season, team, date, tier, league, enc)
    key = F.struct(F.col("a.date"), F.col("a.enc"))
    per = firsts.groupBy(entity, season).agg(
        F.count(F.lit(1)).alias("n_teams"),
        F.min_by(F.struct(F.col("a.tier").alias("tier"), F.col("a.league").alias("league")), key).alias("first"),
        F.max_by(F.struct(F.col("a.tier").alias("tier"), F.col("a.league").alias("league")), key).alias("last"),
        # at most six tier letters exist, so this set is bounded
        F.collect_set(F.when(F.col("a.tier") != "?", F.col("a.tier"))).alias("real_tiers"),
    )
    fl, ll = F.col("first.league"), F.col("last.league")
    fi, li = _rank99(F.col("first.tier")), _rank99(F.col("last.tier"))
    move = (F.when(F.col("n_teams") <= 1, F.lit(""))
            .when((fl != ll) & (fl != "?") & (ll != "?"), F.lit("Transfer"))
            .when(F.size("real_tiers") <= 1, F.lit("Roster"))
            .when(li < fi, F.lit("Promotion"))
            .when(li > fi, F.lit("Relegation"))
            .otherwise(F.lit("Roster")))
    return per.select(entity, season, move.alias("MidSeasonMove"))


def best_tier_record(app: DataFrame, entity="player", season="season", team="team",
                     league="league", role="role", tier="tier", enc="enc") -> DataFrame:
    """F32: per (entity, season) the record of the best tier (rank S..D,'?');
    a later appearance replaces the current one only when strictly better,
    so ties go to the earliest encounter.  ``AllTeams``: distinct teams in
    encounter order joined with ' → '."""
    rank = clean.tier_rank(F.col(tier))
    key = F.struct(rank.alias("rank"), F.col(enc).alias("enc"))
    record = F.struct(F.col(team).alias("Team"), F.col(league).alias("League"), F.col(role).alias("Role"), F.col(tier).alias("Tier"))
    # one chain: best record and first encounter per team, then over the teams
    per_team = app.groupBy(entity, season, team).agg(
        F.min(enc).alias("first_enc"), F.min(key).alias("key"), F.min_by(record, key).alias("r"))
    return per_team.groupBy(entity, season).agg(
        F.min_by("r", "key").alias("b"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first_enc", team))), lambda x: x[team]), " → ").alias("AllTeams"),
    ).select(entity, season, "b.Team", "b.League", "b.Role", "b.Tier", "AllTeams")


def team_history_summary(app: DataFrame, entity="player", season="season", year="year",
                         team="team", league="league", region="region", role="role",
                         date="date", order: str = "date") -> DataFrame:
    """per (entity, season, year) distinct teams joined ' → ' (in order
    of first date, or alphabetically with ``order='name'``), sorted distinct
    leagues joined ', ', first region and role (first non-null)."""
    # one chain: everything per team first, then over the teams of the season
    def first_known(c):
        return [F.expr(f"min_by({c}, {date}) FILTER (WHERE {c} IS NOT NULL)").alias(f"_{c}"),
                F.expr(f"min({date}) FILTER (WHERE {c} IS NOT NULL)").alias(f"_{c}_date")]
    per_team = app.groupBy(entity, season, year, team).agg(
        F.min(date).alias("first_date"), F.collect_set(league).alias("_leagues"), *first_known(region), *first_known(role))
    key = (F.struct("first_date", team) if order == "date" else F.struct(team))
    over = lambda c: F.expr(f"min_by(_{c}, struct(_{c}_date, {team})) FILTER (WHERE _{c} IS NOT NULL)")
    return per_team.groupBy(entity, season, year).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key.alias("k"), F.col(team).alias("t")))), lambda x: x["t"]), " → ").alias("Teams"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("_leagues")))), ", ").alias("Leagues"),
        over(region).alias("Region"), over(role).alias("Role"))


def dedupe_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """keep the first row per key under an explicit total order.
    When the key covers every column this is ``dropDuplicates``."""
    if set(keys) == set(df.columns):
        return df.dropDuplicates(keys)
    others = [c for c in df.columns if c not in keys]
    ordk = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return (df.groupBy(*keys).agg(F.min_by(F.struct(*others), ordk).alias("r"))
            .select(*keys, *[F.col(f"r.{c}").alias(c) for c in others]))


def tier_changes(rows: DataFrame, entity="player", season="season", tier="tier",
                 order="row_no") -> DataFrame:
    """G3 + E9: SeasonTierChange per row.  A season's tier is that of its last
    row with a tier in S,A,B,C,D,?; each row with such a tier is compared
    with the most recent earlier season that has one -> Promoted (rank went
    down), Relegated, Stable, or '' (no tier / no earlier season)."""
    valid = F.col(tier).isin(maps.TIER_ORDER)
    per_season = (rows.where(valid).groupBy(entity, season)
                  .agg(F.max_by(F.col(tier), F.col(order)).alias("season_tier")))
    w = Window.partitionBy(entity).orderBy(season)
    prev = per_season.select(entity, season,
                             F.lag(clean.tier_rank(F.col("season_tier"))).over(w).alias("prev_rank"))
    j = rows.join(prev, [entity, season], "left")
    cur = clean.tier_rank(F.col(tier))
    change = (F.when(~valid | F.col(tier).isNull() | F.col("prev_rank").isNull(), F.lit(""))
              .when(cur < F.col("prev_rank"), F.lit("Promoted"))
              .when(cur > F.col("prev_rank"), F.lit("Relegated"))
              .otherwise(F.lit("Stable")))
    return j.withColumn("SeasonTierChange", change).drop("prev_rank")


def attach_team_record(stats: DataFrame, records: DataFrame, keys=("season", "player")) -> DataFrame:
    """Season stats ⟕ one team record per key (records de-duplicated
    first so the join stays 1:1; the first in the order of their columns)."""
    others = [c for c in records.columns if c not in keys]
    rec = records.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_r")).select(*keys, "_r.*") if others else records.distinct()
    dup = [c for c in rec.columns if c in stats.columns and c not in keys]
    return stats.drop(*dup).join(rec, list(keys), "left")


def append_teams(list_text: Column, new_items: Column) -> Column:
    """Split ' → ' text back into a list and append unseen teams."""
    return clean.append_unseen(list_text, new_items)

"""Career tables: one row per entity from a (entity × season) stats panel.

Input columns (names are parameters): entity, season, team, league, role,
tier (letter), country, games, win rate, KDA and a row-order column that
stands for file order inside a season.

Plan shape (F1): the panel is exploded to ``(entity, attr, value)`` pairs and
aggregated twice — once on ``(entity, attr, value)`` (counts, first-seen
position, per-season sums) and once on ``entity`` (modes by ``min_by``,
distinct counts by ``count``).  Both levels are partial aggregates, so a hot
entity is pre-combined on the map side; no list of an entity's rows is
ever built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean, maps


def _scalar_or(value, df: DataFrame, col: str) -> Column:
    """A given season (int or scalar-subquery Column), else the newest season
    of ``df`` as a scalar subquery."""
    if value is None:
        return df.agg(F.max(F.col(col).cast("int"))).scalar()
    return value if isinstance(value, Column) else F.lit(int(value))


def _mode_expr(attr: str) -> Column:
    """most frequent value; ties go to the value seen first."""
    return F.expr(f"min_by(v, struct(-n, first_seen)) FILTER (WHERE attr = '{attr}')")


def career_records(stats: DataFrame, *, entity: str = "player", season: str = "season",
                   team: str = "team", league: str = "league", role: str = "role",
                   tier: str = "tier", country: str = "country", games: str = "games",
                   win_rate: str = "win_rate", kda: str = "kda", row_order: str = "row_no",
                   latest_season=None, year_base: int = maps.SEASON_YEAR_BASE) -> DataFrame:
    """F1 wide result: everything both output tables need, one row per entity.

    ``latest_season`` None -> the newest season in the data (scalar subquery).
    Status: seen in the newest season -> Active; in the one before -> Inactive;
    else Retired.
    """
    ent = F.trim(F.col(entity).cast("string"))
    base = stats.where(F.col(entity).isNotNull()).select(
        ent.alias("entity"),
        F.col(season).cast("int").alias("season"),
        F.col(row_order).alias("row_no"),
        F.col(team).cast("string").alias("team"),
        F.col(league).cast("string").alias("league"),
        F.col(role).cast("string").alias("role"),
        F.col(tier).cast("string").alias("tier"),
        F.col(country).cast("string").alias("country"),
        clean.parse_games(games).alias("games"),
        clean.parse_percent(win_rate, "fraction").alias("wr"),
        clean.coerce_number(kda).alias("kda"),
    )
    latest = _scalar_or(latest_season, stats, season)
    # flags are projected before the aggregate (a subquery may not sit inside one)
    base = base.withColumns({"is_latest": F.col("season") == latest,
                             "is_prev": F.col("season") == latest - 1})
    # first seen by (season, row): one fixed-width value where the row order is a
    # number, so that the counts by value are hash aggregates
    integral = dict(stats.dtypes).get(row_order) in ("tinyint", "smallint", "int", "bigint")
    pos = (F.expr("coalesce(cast(season as decimal(12, 0)), cast(-2147483649 as decimal(12, 0))) * cast(100000000000000000000 as decimal(21, 0)) + coalesce(cast(row_no as decimal(20, 0)), cast(-9223372036854775809 as decimal(20, 0))) + 10000000000000000000")
           .cast("decimal(38,0)") if integral else F.struct("season", "row_no"))
    base = base.withColumn("pos", pos)
    nonblank = lambda c: F.when(F.col(c) != "", F.col(c))
    pairs = F.array(
        F.struct(F.lit("season").alias("attr"), F.col("season").cast("string").alias("v")),
        F.struct(F.lit("team").alias("attr"), F.col("team").alias("v")),
        F.struct(F.lit("league").alias("attr"), nonblank("league").alias("v")),
        F.struct(F.lit("role").alias("attr"), nonblank("role").alias("v")),
        F.struct(F.lit("tier").alias("attr"), nonblank("tier").alias("v")),
        F.struct(F.lit("country").alias("attr"), nonblank("country").alias("v")),
        F.struct(F.lit("region").alias("attr"),
                 F.when(F.col("league") != "", clean.league_region("league")).alias("v")),
    )
    long = base.select("entity", "pos", "games", "wr", "kda", "is_latest", "is_prev", F.inline(pairs))
    # modal values ignore null/blank; the team list keeps '' (it is a real str)
    long = long.where(F.col("v").isNotNull())
    is_season = F.col("attr") == "season"
    lvl1 = long.groupBy("entity", "attr", "v").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("pos").alias("first_seen"),
        F.sum(F.when(is_season, F.col("games"))).alias("games"),
        F.sum(F.when(is_season, F.col("wr"))).alias("wr_sum"),
        F.count(F.when(is_season, F.col("wr"))).alias("wr_n"),
        F.sum(F.when(is_season, F.col("kda"))).alias("kda_sum"),
        F.count(F.when(is_season, F.col("kda"))).alias("kda_n"),
        F.max("is_latest").alias("is_latest"),
        F.max("is_prev").alias("is_prev"),
    )
    s_int = F.col("v").cast("int")
    t1 = F.max((F.col("attr") == "tier") & (clean.tier_from_letter("v") == 1))
    lvl2 = lvl1.groupBy("entity").agg(
        F.min(F.when(is_season, s_int)).alias("first_season"),
        F.max(F.when(is_season, s_int)).alias("last_season"),
        F.count(F.when(is_season, 1)).alias("num_seasons"),
        F.count(F.when(F.col("attr") == "team", 1)).alias("n_teams"),
        F.count(F.when(F.col("attr") == "region", 1)).alias("n_regions"),
        F.coalesce(F.sum("games"), F.lit(0)).cast("long").alias("total_games"),
        (F.sum("wr_sum") / F.sum("wr_n")).alias("avg_winrate"),
        (F.sum("kda_sum") / F.sum("kda_n")).alias("avg_kda"),
        F.coalesce(t1, F.lit(False)).alias("ever_tier1"),
        F.max("is_latest").alias("seen_latest"),
        F.max("is_prev").alias("seen_previous"),
        _mode_expr("role").alias("mode_role"),
        _mode_expr("league").alias("mode_league"),
        _mode_expr("country").alias("mode_country"),
        _mode_expr("tier").alias("mode_tier"),
    )
    span = F.col("last_season") - F.col("first_season") + 1
    starting = F.when(F.col("mode_tier").isNull(), F.lit(2)).otherwise(clean.tier_from_letter("mode_tier"))
    return lvl2.select(
        F.col("entity").alias("player_id"),
        clean.standardize_role("mode_role").alias("primary_role"),
        clean.standardize_country("mode_country").alias("nationality"),
        clean.career_status("seen_latest", "seen_previous").alias("current_status"),
        F.when(F.col("ever_tier1"), 1).otherwise(2).alias("peak_tier"),
        F.when(F.col("mode_league").isNull(), F.lit("Unknown"))
         .otherwise(clean.league_region("mode_league")).alias("primary_region"),
        F.coalesce(F.col("mode_league"), F.lit("Unknown")).alias("primary_league"),
        (span * 12).cast("int").alias("career_length_months"),
        span.cast("double").alias("career_length_years"),
        F.col("num_seasons").cast("int").alias("num_seasons_active"),
        F.when((starting != 1) & F.col("ever_tier1"), F.lit(12.0))
         .otherwise(F.lit(None).cast("double")).alias("time_to_tier1_months"),
        F.when(F.col("n_teams") == 0, 1).otherwise(F.col("n_teams")).cast("int").alias("num_teams"),
        F.when(F.col("n_regions") == 0, 1).otherwise(F.col("n_regions")).cast("int").alias("num_regions"),
        ((starting == 2) & F.col("ever_tier1")).alias("promoted_tier2_to_tier1"),
        starting.cast("int").alias("starting_tier"),
        (F.col("first_season") + year_base).cast("int").alias("career_start_year"),
        (F.col("last_season") + year_base).cast("int").alias("career_end_year"),
        F.col("total_games"),
        F.col("avg_winrate"),
        F.col("avg_kda"),
    )


PLAYERS_COLUMNS = ["player_id", "primary_role", "nationality", "current_status", "peak_tier"]
CAREER_COLUMNS = ["player_id", "primary_region", "primary_league", "career_length_months",
                  "career_length_years", "num_seasons_active", "time_to_tier1_months",
                  "num_teams", "num_regions", "promoted_tier2_to_tier1", "starting_tier",
                  "career_start_year", "career_end_year", "total_games", "avg_winrate", "avg_kda"]


def players_processed(records: DataFrame) -> DataFrame:
    return records.select(*PLAYERS_COLUMNS)


def career_metrics(records: DataFrame) -> DataFrame:
    return records.select(*CAREER_COLUMNS)


def career_records_workbook(stats: DataFrame, enriched: DataFrame, *, entity: str = "player",
                            season: str = "season", country: str = "country", games: str = "games",
                            win_rate: str = "win_rate", kda: str = "kda", row_order: str = "row_no",
                            e_team: str = "team", e_league: str = "league", e_role: str = "role",
                            e_tier: str = "tier", e_country: str = "country",
                            e_order: str = "row_no", latest_season=None,
                            year_base: int = maps.SEASON_YEAR_BASE) -> DataFrame:
    """F2 + E8: workbook variant.  Enrichment: the last enriched row per
    entity wins (``max_by`` on row order); nationality falls back to the
    first observed country.  Estimates: peak tier 1 if >= 3 seasons,
    teams = min(seasons, 5), regions = 1, promoted = tier 2 and >= 3 seasons,
    time-to-tier-1 = 12 if >= 2 seasons; win rate / KDA default 0.5 / 2.0."""
    base = stats.where(F.col(entity).isNotNull()).select(
        F.col(entity).cast("string").alias("entity"),
        F.col(season).cast("int").alias("season"),
        F.col(row_order).alias("row_no"),
        F.col(country).cast("string").alias("country"),
        clean.parse_games(games).alias("games"),
        clean.parse_percent(win_rate, "plain").alias("wr"),
        clean.coerce_number(kda).alias("kda"),
    )
    latest = _scalar_or(latest_season, stats, season)
    base = base.withColumns({"is_latest": F.col("season") == latest,
                             "is_prev": F.col("season") == latest - 1})
    main = base.groupBy("entity").agg(
        F.min("season").alias("first_season"),
        F.max("season").alias("last_season"),
        F.count_distinct("season").alias("num_seasons"),
        F.coalesce(F.sum("games"), F.lit(0)).cast("long").alias("total_games"),
        F.coalesce(F.avg("wr"), F.lit(0.5)).alias("avg_winrate"),
        F.coalesce(F.avg("kda"), F.lit(2.0)).alias("avg_kda"),
        F.expr("min_by(country, struct(season, row_no)) FILTER (WHERE country IS NOT NULL)").alias("first_country"),
        F.max("is_latest").alias("seen_latest"),
        F.max("is_prev").alias("seen_previous"),
    )
    enr = (enriched.where(F.col(entity).isNotNull())
           .groupBy(F.col(entity).cast("string").alias("entity"))
           .agg(F.max_by(F.struct(F.col(e_team).cast("string").alias("team"),
                                  F.col(e_league).cast("string").alias("league"),
                                  F.col(e_role).cast("string").alias("role"),
                                  F.col(e_tier).cast("string").alias("tier"),
                                  F.col(e_country).cast("string").alias("country")),
                         F.col(e_order)).alias("e")))
    j = main.join(enr, "entity", "left")
    tier_map = clean.map_literal({"S": 1, "A": 2, "B": 2})
    starting = F.coalesce(F.element_at(tier_map, F.col("e.tier")), F.lit(2))
    seasons = F.col("num_seasons")
    span = F.col("last_season") - F.col("first_season") + 1
    return j.select(
        F.col("entity").alias("player_id"),
        clean.standardize_role(F.coalesce(F.col("e.role"), F.lit("Unknown")), workbook=True).alias("primary_role"),
        clean.standardize_country(F.coalesce(F.col("e.country"), F.col("first_country"))).alias("nationality"),
        clean.career_status("seen_latest", "seen_previous").alias("current_status"),
        F.when((starting == 1) | (seasons >= 3), 1).otherwise(2).alias("peak_tier"),
        clean.league_region(F.col("e.league"), workbook=True).alias("primary_region"),
        (span * 12).cast("int").alias("career_length_months"),
        span.cast("double").alias("career_length_years"),
        F.when((starting != 1) & (seasons >= 2), F.lit(12.0)).otherwise(F.lit(None).cast("double"))
         .alias("time_to_tier1_months"),
        F.least(seasons, F.lit(5)).cast("int").alias("num_teams"),
        F.lit(1).alias("num_regions"),
        ((starting == 2) & (seasons >= 3)).alias("promoted_tier2_to_tier1"),
        starting.cast("int").alias("starting_tier"),
        (F.col("first_season") + year_base).cast("int").alias("career_start_year"),
        F.col("total_games"),
        F.col("avg_winrate"),
        F.col("avg_kda"),
    )


def model_frame(stats: DataFrame, *, entity: str = "player", season: str = "season",
                league: str = "league", role: str = "role", row_order: str = "row_no",
                metrics: dict[str, str] | None = None, games: str = "games",
                valid_leagues=maps.VALID_LEAGUES, valid_roles=maps.VALID_ROLES,
                max_season=None, era_cutoff: int = 9) -> DataFrame:
    """F3 + F5 + C16 + C20 + D2: per entity distinct seasons, ``Observed``
    (last season is not the newest), first known league and role (role cut
    at the first comma), debut, era flag, 3-dp means of metric columns, total
    games; only entities whose league and role are in the valid sets.

    ``metrics`` maps output name -> (column, parse) with parse 'number' or
    'percent' (strip '%', keep the 0-100 scale)."""
    metrics = metrics or {}
    sel = [F.col(entity).alias("entity"), F.col(season).cast("int").alias("season"),
           F.col(row_order).alias("row_no"),
           F.trim(F.col(league).cast("string")).alias("league"),
           F.trim(F.col(role).cast("string")).alias("role"),
           clean.coerce_number(games).alias("games")]
    for out, (c, parse) in metrics.items():
        v = clean.parse_percent(c, "points") if parse == "percent" else clean.coerce_number(c)
        sel.append(v.alias(out))
    base = stats.select(*sel)
    mx = _scalar_or(max_season, stats, season)
    first_known = lambda c: F.expr(  # noqa: E731  F5
        f"min_by({c}, struct(season, row_no)) FILTER (WHERE {c} IS NOT NULL AND {c} != '')")
    agg = base.groupBy("entity").agg(
        F.count_distinct("season").alias("Career_Seasons"),
        F.max("season").alias("last_season"),
        F.min("season").alias("Debut"),
        first_known("league").alias("League"),
        first_known("role").alias("role_raw"),
        *[F.round(F.avg(m), 3).alias(m) for m in metrics],
        F.coalesce(F.sum("games"), F.lit(0.0)).cast("long").alias("Total_Games"),
    )
    out = agg.select(
        F.col("entity").alias("Player"),
        F.col("Career_Seasons").cast("int").alias("Career_Seasons"),
        (F.col("last_season") != mx).cast("int").alias("Observed"),
        F.col("League"),
        clean.first_list_item(F.coalesce(F.col("role_raw"), F.lit(""))).alias("Role"),
        F.col("Debut").cast("int").alias("Debut"),
        clean.early_era("Debut", era_cutoff).alias("Early_Era"),
        *[F.col(m) for m in metrics],
        F.col("Total_Games"),
    )
    return out.where(F.col("League").isin(list(valid_leagues)) & F.col("Role").isin(list(valid_roles)))


def careers_from_stints(stints: DataFrame, *, entity: str = "player_title",
                        start: str = "start", end: str = "end") -> DataFrame:
    """min start, max end, day span, stint count per entity."""
    return stints.groupBy(F.col(entity).alias("player_title")).agg(
        F.min(F.to_date(start)).alias("career_start"),
        F.max(F.to_date(end)).alias("career_end"),
        F.count(F.lit(1)).cast("int").alias("stints_count"),
    ).withColumn("career_days", F.datediff("career_end", "career_start").cast("double"))

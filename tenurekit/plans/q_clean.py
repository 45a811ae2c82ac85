"""Step 2: the scalar cleaning kit over text derived from the driver tables.

Each order row yields raw text in the shapes season files carry (role
aliases, country names, percent strings with and without '%', games as
'-', '38.5' or digits, wiki league names, blank dates), picked from fixed
sample lists by the row's key; every cleaning function is then applied to
them in one projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import clean, maps
from .driver import PANEL_SQL, driver_panel, with_sql
from .registry import register
from .sqlkit import case_map, q

ROLE_SAMPLES = ["Top", "jg", " MID ", "bottom", "Supp", "marksman", "ad carry", "Coach", "Jungle, Top"]
COUNTRY_SAMPLES = ["South Korea", "Korea", "Denmark", "Atlantis", "X", "", "People's Republic of China", "USA"]
LEAGUE_SAMPLES = ["LoL Champions Korea 2019", "LCS Summer", "Some Cup", "Vietnam Championship Series",
                  "", "NA LCS Spring", "LCK CL", "EU LCS"]
REGION_SAMPLES = ["Korea", "Europe", "NA", "", "Mars"]
LEVEL_SAMPLES = ["Primary", "Secondary", "Tertiary", "Qualifier", "Showmatch", "S", "Z", ""]


def _pick(samples: list[str], key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in samples]), (F.pmod(key, F.lit(len(samples))) + 1).cast("int"))


def _pick_sql(samples: list[str], key: str) -> str:
    return "[" + ", ".join(q(s) for s in samples) + f"][({key} % {len(samples)}) + 1]"


def clean_kit(spark, sf_dir):
    p = driver_panel(spark, sf_dir, need=("status",))
    k = F.col("row_id")
    raw = p.select(
        "row_id", "period", "value", "status",
        _pick(ROLE_SAMPLES, k).alias("role_txt"),
        _pick(COUNTRY_SAMPLES, F.col("entity")).alias("country_txt"),
        _pick(LEAGUE_SAMPLES, k).alias("league_txt"),
        _pick(REGION_SAMPLES, F.col("entity")).alias("region_txt"),
        _pick(LEVEL_SAMPLES, k).alias("level_txt"),
        F.when(F.pmod(k, F.lit(2)) == 0,
               F.concat(F.floor(F.col("value") / 1000).cast("int").cast("string"), F.lit(".50%")))
         .otherwise(F.floor(F.col("value") / 10000).cast("int").cast("string")).alias("pct_txt"),
        F.when(F.pmod(k, F.lit(3)) == 0, F.lit("-"))
         .when(F.pmod(k, F.lit(3)) == 1, F.concat(F.floor(F.col("value") / 10000).cast("int").cast("string"), F.lit(".5")))
         .otherwise(F.floor(F.col("value") / 10000).cast("int").cast("string")).alias("games_txt"),
        F.when(F.pmod(k, F.lit(4)) == 0, F.lit(""))
         .otherwise(F.date_format("date", "yyyy-MM-dd")).alias("date_txt"),
    )
    return raw.select(
        "row_id",
        clean.standardize_role("role_txt").alias("role_std"),
        clean.standardize_role("role_txt", workbook=True).alias("role_std_wb"),
        clean.standardize_country("country_txt").alias("country_std"),
        clean.league_region(F.trim("league_txt")).alias("league_region"),
        clean.tier_from_letter("status").alias("tier_num"),
        clean.tier_from_level("level_txt").alias("tier_level"),
        clean.tier_rank(clean.tier_from_level("level_txt")).alias("tier_rank"),
        clean.season_label(clean.season_to_year(F.col("period") - 1985)).alias("season_label"),
        clean.parse_percent("pct_txt", "fraction").alias("pct_fraction"),
        clean.parse_percent("pct_txt", "plain").alias("pct_plain"),
        clean.parse_percent("pct_txt", "points").alias("pct_points"),
        clean.parse_games("games_txt").alias("games_int"),
        clean.parse_games("games_txt", truncate_text=True).alias("games_trunc"),
        clean.coerce_number("games_txt", 0.0).alias("games_num"),
        clean.clean_text("role_txt").alias("role_clean"),
        clean.league_from_keywords("league_txt", "region_txt", "full").alias("league_kw_full"),
        clean.league_from_keywords("league_txt", "region_txt", "fast").alias("league_kw_fast"),
        clean.year_from_date_text("date_txt", "period").alias("year_from_date"),
        clean.date_matches_year("date_txt", "period").alias("date_ok"),
        clean.date_matches_year("date_txt", "period", keep_blank=False).alias("date_ok_strict"),
        clean.first_nonblank("country_txt", "league_txt", "region_txt").alias("best_text"),
        clean.short_text("league_txt", 10).alias("league_short"),
        clean.first_list_item("role_txt").alias("first_role"),
        clean.early_era(F.col("period") - 1988).alias("early_era"),
        clean.career_bucket(F.col("period") - 1994).alias("career_bucket"),
        clean.indicator(F.col("status") == "F").alias("is_final"),
        clean.round_half_up(F.col("value") / 7, 2).alias("value_r2"),
    )


ROLE_KEY = "lower(trim(role_txt))"
_WB_ROLES = {k: v for k, v in maps.ROLE_ALIASES.items() if k not in maps.ROLE_ALIASES_WORKBOOK_MISSING}


def _kw_sql(kws):
    parts = " ".join(f"WHEN contains(coalesce(league_txt, ''), {q(k)}) THEN {q(v)}" for k, v in kws)
    reg = "trim(coalesce(region_txt, ''))"
    fb = (f"coalesce({case_map(reg, maps.REGION_LEAGUE)}, CASE WHEN {reg} <> '' THEN {reg} ELSE '?' END)")
    return f"CASE {parts} ELSE {fb} END"


_LEVEL = f"coalesce({case_map('trim(coalesce(level_txt, %s))' % q(''), maps.TOURNAMENT_LEVEL_TIER)}, '?')"
_INT_RE = "regexp_full_match(trim(games_txt), '[+-]?[0-9]+')"

CLEAN_SQL = with_sql(PANEL_SQL) + f""",
raw AS (
  SELECT row_id, period, value, status,
         {_pick_sql(ROLE_SAMPLES, 'row_id')} AS role_txt,
         {_pick_sql(COUNTRY_SAMPLES, 'entity')} AS country_txt,
         {_pick_sql(LEAGUE_SAMPLES, 'row_id')} AS league_txt,
         {_pick_sql(REGION_SAMPLES, 'entity')} AS region_txt,
         {_pick_sql(LEVEL_SAMPLES, 'row_id')} AS level_txt,
         CASE WHEN row_id % 2 = 0 THEN CAST(CAST(floor(value / 1000) AS INTEGER) AS VARCHAR) || '.50%'
              ELSE CAST(CAST(floor(value / 10000) AS INTEGER) AS VARCHAR) END AS pct_txt,
         CASE WHEN row_id % 3 = 0 THEN '-'
              WHEN row_id % 3 = 1 THEN CAST(CAST(floor(value / 10000) AS INTEGER) AS VARCHAR) || '.5'
              ELSE CAST(CAST(floor(value / 10000) AS INTEGER) AS VARCHAR) END AS games_txt,
         CASE WHEN row_id % 4 = 0 THEN '' ELSE strftime(date, '%Y-%m-%d') END AS date_txt
  FROM panel
)
SELECT row_id,
       coalesce({case_map(ROLE_KEY, maps.ROLE_ALIASES)}, 'Unknown') AS role_std,
       coalesce({case_map(ROLE_KEY, _WB_ROLES)}, 'Unknown') AS role_std_wb,
       CASE WHEN country_txt IS NULL OR length(country_txt) = 0 THEN 'Unknown'
            ELSE coalesce({case_map('trim(country_txt)', maps.COUNTRY_CODES)},
                          CASE WHEN length(trim(country_txt)) >= 2 THEN upper(substr(trim(country_txt), 1, 2)) ELSE 'XX' END) END AS country_std,
       coalesce({case_map('trim(league_txt)', maps.LEAGUE_REGION)}, 'Unknown') AS league_region,
       CAST(coalesce({case_map('status', maps.TIER_LETTER)}, 2) AS INTEGER) AS tier_num,
       {_LEVEL} AS tier_level,
       CAST(CASE {_LEVEL} WHEN 'S' THEN 1 WHEN 'A' THEN 2 WHEN 'B' THEN 3 WHEN 'C' THEN 4 WHEN 'D' THEN 5
            WHEN '?' THEN 6 ELSE 7 END AS INTEGER) AS tier_rank,
       CASE WHEN period - 1985 + 2010 BETWEEN 2016 AND 2025 THEN 'S' || CAST(period - 1985 AS VARCHAR) ELSE '' END AS season_label,
       TRY_CAST(replace(trim(pct_txt), '%', '') AS DOUBLE) / 100.0 AS pct_fraction,
       CASE WHEN contains(trim(pct_txt), '%') THEN NULL ELSE TRY_CAST(trim(pct_txt) AS DOUBLE) END AS pct_plain,
       TRY_CAST(replace(trim(pct_txt), '%', '') AS DOUBLE) AS pct_points,
       CASE WHEN {_INT_RE} THEN TRY_CAST(trim(games_txt) AS INTEGER) END AS games_int,
       CASE WHEN {_INT_RE} THEN TRY_CAST(trim(games_txt) AS INTEGER)
            ELSE CAST(trunc(TRY_CAST(trim(games_txt) AS DOUBLE)) AS INTEGER) END AS games_trunc,
       coalesce(TRY_CAST(games_txt AS DOUBLE), 0.0) AS games_num,
       trim(coalesce(role_txt, '')) AS role_clean,
       {_kw_sql(maps.LEAGUE_KEYWORDS_FULL)} AS league_kw_full,
       {_kw_sql(maps.LEAGUE_KEYWORDS_FAST)} AS league_kw_fast,
       coalesce(TRY_CAST(substr(date_txt, 1, 4) AS INTEGER), period) AS year_from_date,
       (TRY_CAST(substr(trim(coalesce(date_txt, '')), 1, 4) AS INTEGER) = period) OR trim(coalesce(date_txt, '')) = '' AS date_ok,
       coalesce(TRY_CAST(substr(trim(coalesce(date_txt, '')), 1, 4) AS INTEGER) = period, false) AS date_ok_strict,
       coalesce(CASE WHEN trim(country_txt) = '' OR lower(trim(country_txt)) = 'nan' THEN NULL ELSE trim(country_txt) END,
                CASE WHEN trim(league_txt) = '' OR lower(trim(league_txt)) = 'nan' THEN NULL ELSE trim(league_txt) END,
                CASE WHEN trim(region_txt) = '' OR lower(trim(region_txt)) = 'nan' THEN NULL ELSE trim(region_txt) END,
                '') AS best_text,
       CASE WHEN length(trim(coalesce(league_txt, ''))) > 10 THEN substr(trim(coalesce(league_txt, '')), 1, 9) || '…'
            ELSE trim(coalesce(league_txt, '')) END AS league_short,
       trim(split_part(role_txt, ',', 1)) AS first_role,
       CAST(period - 1988 <= 9 AS INTEGER) AS early_era,
       CASE WHEN period - 1994 <= 1 THEN '1' WHEN period - 1994 <= 2 THEN '2' WHEN period - 1994 <= 3 THEN '3'
            WHEN period - 1994 <= 5 THEN '4-5' ELSE '6+' END AS career_bucket,
       coalesce(CAST(status = 'F' AS INTEGER), 0) AS is_final,
       round(value / 7, 2) AS value_r2
FROM raw"""


@register("clean_kit", CLEAN_SQL, ("C1", "C2", "C3", "C4", "C5", "C6", "C7", "C8", "C9", "C10", "C13",
                                   "C14", "C15", "C16", "C20", "C21", "C23", "C26"))
def q_clean(spark, sf_dir):
    return clean_kit(spark, sf_dir)

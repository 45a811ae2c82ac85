"""Scalar cleaning, mapping and derivation as native Column expressions.

Every function takes and returns ``pyspark.sql.Column`` so it stays inside
whole-stage codegen: lookups are ``create_map`` literals or ordered ``when``
chains, parsing is ``try_cast``.  No Python UDFs.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import maps


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_literal(d: dict) -> Column:
    """``create_map`` literal from a small fixed dict."""
    kv = []
    for k, v in d.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


# C1 -------------------------------------------------------------------------
def standardize_role(c, workbook: bool = False) -> Column:
    """trim/lower, alias -> Top/Jungle/Mid/ADC/Support, else 'Unknown'."""
    aliases = dict(maps.ROLE_ALIASES)
    if workbook:
        for k in maps.ROLE_ALIASES_WORKBOOK_MISSING:
            aliases.pop(k, None)
    key = F.lower(F.trim(_c(c)))
    return F.coalesce(F.element_at(map_literal(aliases), key), F.lit("Unknown"))


# C2 -------------------------------------------------------------------------
def standardize_country(c) -> Column:
    """name -> ISO2; unknown name -> first two letters upper-cased; shorter
    than two characters -> 'XX'; null/blank -> 'Unknown'."""
    s = F.trim(_c(c))
    mapped = F.element_at(map_literal(maps.COUNTRY_CODES), s)
    fallback = F.when(F.length(s) >= 2, F.upper(F.substring(s, 1, 2))).otherwise(F.lit("XX"))
    return (F.when(_c(c).isNull() | (F.length(_c(c)) == 0), F.lit("Unknown"))
            .otherwise(F.coalesce(mapped, fallback)))


# C3 -------------------------------------------------------------------------
def league_region(c, workbook: bool = False, default: str = "Unknown") -> Column:
    d = maps.LEAGUE_REGION
    if workbook:
        d = {k: d[k] for k in maps.LEAGUE_REGION_WORKBOOK_KEYS}
    return F.coalesce(F.element_at(map_literal(d), _c(c)), F.lit(default))


# C4 -------------------------------------------------------------------------
def tier_from_letter(c) -> Column:
    """Roster tier letter -> 1/2; anything else (and null) -> 2."""
    return F.coalesce(F.element_at(map_literal(maps.TIER_LETTER), _c(c)), F.lit(2)).cast("int")


def tier_from_level(c, default: str | Column = "?") -> Column:
    """Tournament level -> S/A/B/C/D, else ``default`` ('?' or a league default)."""
    d = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.element_at(map_literal(maps.TOURNAMENT_LEVEL_TIER),
                                   F.trim(F.coalesce(_c(c), F.lit("")))), d)


def tier_rank(c) -> Column:
    """Position in S,A,B,C,D,? (1-based); unknown letters rank after '?'."""
    pos = F.array_position(F.array(*[F.lit(t) for t in maps.TIER_ORDER]), _c(c)).cast("int")
    return F.when(pos == 0, F.lit(len(maps.TIER_ORDER) + 1)).otherwise(pos)


# C5 -------------------------------------------------------------------------
def season_to_year(n) -> Column:
    return (_c(n) + F.lit(maps.SEASON_YEAR_BASE)).cast("int")


def year_to_season(y) -> Column:
    return (_c(y) - F.lit(maps.SEASON_YEAR_BASE)).cast("int")


def season_label(year, first_year: int | None = None, last_year: int | None = None,
                 base: int = maps.SEASON_YEAR_BASE) -> Column:
    """Calendar year -> 'S<n>' with n = year - base, '' outside [first, last]
    and for null years."""
    first_year = first_year if first_year is not None else base + maps.SEASON_FIRST_LABELLED
    last_year = last_year if last_year is not None else base + maps.SEASON_LAST_LABELLED
    y = _c(year)
    return (F.when(y.isNotNull() & y.between(first_year, last_year),
                   F.concat(F.lit("S"), (y - F.lit(base)).cast("string")))
            .otherwise(F.lit("")))


def season_number_from_name(c) -> Column:
    """'player_careers_S12.csv' -> 12 (null when no S<digits> token)."""
    return F.expr(f"try_cast(nullif(regexp_extract({_sql(c)}, '_S(\\\\d+)', 1), '') as int)")


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("expected a column name")


# C6 / C8 ---------------------------------------------------------------------
def _is_text(c: Column) -> Column:
    """Whether a column's type is text; settled when the plan is analysed."""
    return F.typeof(c).isin("string", "void")


def parse_percent(c, rule: str = "fraction") -> Column:
    """Three percent rules:
    'fraction' -> text column: strip '%' and divide by 100 (every value, as
                   the text branch of the season-file reader does); a numeric
                   column is a fraction already and stays;
    'plain'    -> plain number only; text carrying '%' gives null;
    'points'   -> strip '%' and keep the 0-100 scale."""
    s = F.trim(_c(c).cast("string"))
    num = _try_double(F.regexp_replace(s, "%", ""))
    if rule == "fraction":
        return F.when(_is_text(_c(c)), num / 100.0).otherwise(_try_double(s))
    if rule == "plain":
        return F.when(s.contains("%"), F.lit(None).cast("double")).otherwise(_try_double(s))
    if rule == "points":
        return num
    raise ValueError(f"unknown percent rule {rule!r}")


def _try_double(c: Column) -> Column:
    return c.try_cast("double")


def coerce_number(c, default: float | None = None) -> Column:
    """errors='coerce': unparseable text -> null (or ``default``)."""
    v = _c(c).try_cast("double")
    return F.coalesce(v, F.lit(default)) if default is not None else v


# C7 -------------------------------------------------------------------------
def parse_games(c, truncate_text: bool = False) -> Column:
    """Integer games.  Text column: bad text ('-', '38.5') -> null and is
    skipped by the sums; ``truncate_text=True`` truncates decimal text instead.
    Numeric column: truncated (38.0 and 38.5 -> 38)."""
    s = F.trim(_c(c).cast("string"))
    number = F.coalesce(s.try_cast("int"), s.try_cast("double").try_cast("int"))
    if truncate_text:
        return number
    return F.when(_is_text(_c(c)), s.try_cast("int")).otherwise(number)


# C9 -------------------------------------------------------------------------
def clean_text(c) -> Column:
    return F.trim(F.coalesce(_c(c).cast("string"), F.lit("")))


# C10 ------------------------------------------------------------------------
def league_from_keywords(league, region, variant: str = "full") -> Column:
    """First keyword contained in the league text (ordered, case-sensitive);
    else the region map; else the raw region; else '?'."""
    kws = maps.LEAGUE_KEYWORDS_FULL if variant == "full" else maps.LEAGUE_KEYWORDS_FAST
    lg = F.coalesce(_c(league).cast("string"), F.lit(""))
    reg = F.trim(F.coalesce(_c(region).cast("string"), F.lit("")))
    fallback = F.coalesce(F.element_at(map_literal(maps.REGION_LEAGUE), reg),
                          F.when(reg != "", reg).otherwise(F.lit("?")))
    out = None
    for kw, code in kws:
        cond = lg.contains(kw)
        out = F.when(cond, F.lit(code)) if out is None else out.when(cond, F.lit(code))
    return out.otherwise(fallback)


# C12 ------------------------------------------------------------------------
def split_rank(c) -> Column:
    """Ordered substring -> rank (case-insensitive); null 100; other 35."""
    s = F.lower(_c(c).cast("string"))
    out = F.when(_c(c).isNull(), F.lit(maps.SPLIT_RANK_NULL))
    for key, rank in maps.SPLIT_ORDER:
        out = out.when(s.contains(key.lower()), F.lit(rank))
    return out.otherwise(F.lit(maps.SPLIT_RANK_OTHER)).cast("int")


# C13 ------------------------------------------------------------------------
def year_from_date_text(c, fallback_year) -> Column:
    """Year from a 'YYYY-...' prefix, else the fallback year."""
    return F.coalesce(F.substring(_c(c).cast("string"), 1, 4).try_cast("int"),
                      _c(fallback_year) if not isinstance(fallback_year, int) else F.lit(fallback_year))


def date_matches_year(c, year, keep_blank: bool = True) -> Column:
    s = F.trim(F.coalesce(_c(c).cast("string"), F.lit("")))
    y = F.substring(s, 1, 4).try_cast("int")
    yr = F.lit(year) if isinstance(year, int) else _c(year)
    ok = y == yr
    return (ok | (s == "")) if keep_blank else F.coalesce(ok, F.lit(False))


# C14 ------------------------------------------------------------------------
def first_nonblank(*cols) -> Column:
    """First non-empty of the columns, else ''; NaN-like 'nan' counts as missing."""
    parts = []
    for c in cols:
        s = F.trim(_c(c).cast("string"))
        parts.append(F.when((s == "") | (F.lower(s) == "nan"), F.lit(None)).otherwise(s))
    return F.coalesce(*parts, F.lit(""))


# C15 ------------------------------------------------------------------------
def short_text(c, max_len: int = 28) -> Column:
    s = F.trim(F.coalesce(_c(c).cast("string"), F.lit("")))
    return F.when(F.length(s) > max_len,
                  F.concat(F.substring(s, 1, max_len - 1), F.lit("…"))).otherwise(s)


# C16 ------------------------------------------------------------------------
def first_list_item(c, sep: str = ",") -> Column:
    return F.trim(F.split(_c(c), sep).getItem(0))


# C17 ------------------------------------------------------------------------
def career_status(seen_latest, seen_previous) -> Column:
    return (F.when(_c(seen_latest), F.lit("Active"))
            .when(_c(seen_previous), F.lit("Inactive"))
            .otherwise(F.lit("Retired")))


# C18 / C19 ------------------------------------------------------------------
def team_changes(num_teams) -> Column:
    return F.greatest(F.lit(0.0), _c(num_teams).cast("double") - 1.0)


def volatility_bucket(num_teams) -> Column:
    ch = team_changes(num_teams)
    lab = maps.VOLATILITY_ORDER
    return (F.when(ch <= 1, F.lit(lab[0])).when(ch <= 2, F.lit(lab[1]))
            .otherwise(F.lit(lab[2])))


# C20 ------------------------------------------------------------------------
def early_era(debut_season, cutoff: int = 9) -> Column:
    return (_c(debut_season) <= cutoff).cast("int")


# C21 ------------------------------------------------------------------------
def career_bucket(seasons) -> Column:
    """Right-closed bins (0,1] (1,2] (2,3] (3,5] (5,inf) -> '1','2','3','4-5','6+'."""
    s = _c(seasons)
    return (F.when(s <= 1, F.lit("1")).when(s <= 2, F.lit("2")).when(s <= 3, F.lit("3"))
            .when(s <= 5, F.lit("4-5")).when(s.isNotNull(), F.lit("6+")))


# C22 ------------------------------------------------------------------------
def one_hot(c, levels: Sequence[str], prefix: str) -> list[Column]:
    """Fixed-vocabulary indicators (the reference level is left out by the caller)."""
    return [(_c(c) == F.lit(v)).cast("int").alias(f"{prefix}{v}") for v in levels]


# C23 ------------------------------------------------------------------------
def indicator(cond: Column) -> Column:
    return F.coalesce(cond.cast("int"), F.lit(0))


# C26 ------------------------------------------------------------------------
def round_half_up(c, digits: int) -> Column:
    return F.round(_c(c), digits)


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    return F.round(F.when(den > 0, 100.0 * num / den), digits)


# C27 ------------------------------------------------------------------------
def reorder_columns(columns: Iterable[str], front: Sequence[str]) -> list[str]:
    cols = list(columns)
    head = [c for c in front if c in cols]
    return head + [c for c in cols if c not in head]


# C28 ------------------------------------------------------------------------
def append_unseen(list_text, new_items: Column, sep: str = " → ") -> Column:
    """Split flattened text back to a list and append items not yet in it,
    keeping first-seen order."""
    base = F.when(F.coalesce(F.trim(_c(list_text)), F.lit("")) == "", F.array().cast("array<string>")) \
        .otherwise(F.split(_c(list_text), sep))
    return F.array_union(base, new_items)

"""League rule table (A3) and rule lookup (C11).

A rule row is ``(league_pattern, match_mode, tier, region)`` with
``match_mode`` in ``exact | contains | default``.  Lookup semantics:

* non-default rules are tried longest pattern first (ties: rule order);
  ``exact`` compares the trimmed league with the trimmed pattern,
  case-sensitively; ``contains`` tests whether the lower-cased pattern is a
  substring of the lower-cased league;
* otherwise the first ``default`` rule applies; with none, ``(2, 'Unknown')``;
* a null league is treated as ``''``; a rule without a pattern (null) matches
  nothing, an empty ``contains`` pattern matches every league;
* "trimmed" removes any white space at either end.

Plan shape: the theta condition is evaluated only on the *distinct* league
values (a partial aggregate, so each map task ships its few distinct values),
against the broadcast rule table (size-checked).  The resulting one-row-per-
league map is broadcast back into the rows after a row-count check, so the
large side is never shuffled on a skewed league key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import MAX_BROADCAST_ROWS, broadcast_if_small

RULE_SCHEMA = T.StructType([
    T.StructField("league_pattern", T.StringType()),
    T.StructField("match_mode", T.StringType()),
    T.StructField("tier", T.StringType()),
    T.StructField("region", T.StringType()),
])

# Rule tables up to this size are applied as one ordered CASE expression
# inside the scan stage (no join, no extra job); larger ones go through the
# distinct-league theta join below.  Both read the patterns and leagues as
# normalised by ``normalize_rules`` and ``_league``, so they agree on every row.
MAX_INLINE_RULES = 64


def rules_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rule table from literal rows ``(pattern, mode, tier, region)``; the
    position in the list is the rule order."""
    data = [(p, m, None if t is None else str(t), r) for p, m, t, r in rows]
    return normalize_rules(spark.createDataFrame(data, RULE_SCHEMA), ordered=True)


def load_league_rules(spark: SparkSession, path: str) -> DataFrame:
    """A3: all-string CSV read; tier -> int (bad -> 2); mode null -> 'contains',
    trimmed and lower-cased.  File order is kept as ``rule_no``."""
    df = (spark.read.schema(RULE_SCHEMA).option("header", True).csv(path)
          .withColumn("rule_no", F.monotonically_increasing_id()))
    return normalize_rules(df, ordered=False)


def normalize_rules(df: DataFrame, ordered: bool) -> DataFrame:
    if ordered or "rule_no" not in df.columns:
        df = df.withColumn("rule_no", F.monotonically_increasing_id())
    return df.select(
        F.col("league_pattern"),
        _strip(F.col("league_pattern")).alias("pattern"),
        F.lower(_strip(F.coalesce(F.col("match_mode"), F.lit("contains")))).alias("match_mode"),
        F.coalesce(F.trim(F.col("tier")).try_cast("int"),
                   F.trim(F.col("tier")).try_cast("double").try_cast("int"),
                   F.lit(2)).alias("tier"),
        F.col("region"),
        F.col("rule_no"),
    )


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _league(c: Column) -> Column:
    return _strip(F.coalesce(c, F.lit("")))


def _hits(league: Column, mode, pattern: Column) -> Column:
    """Whether a non-default rule matches a normalised league."""
    return F.coalesce(((mode == "exact") & (league == pattern))
                      | ((mode == "contains") & F.lower(league).contains(F.lower(pattern))), F.lit(False))


def _neg_len():
    """Longest pattern first among matching rules; default rules keep their
    file order (the first default row applies)."""
    return F.when(F.col("match_mode") == "default", F.lit(0)).otherwise(-F.coalesce(F.length(F.col("league_pattern")), F.lit(0)))


def league_map(values: DataFrame, league_col: str, rules: DataFrame) -> DataFrame:
    """One row per distinct league value: ``(league_key, tier, region)``.

    ``league_key`` is the raw value (nulls kept as their own key).
    """
    rules = broadcast_if_small(rules, MAX_BROADCAST_ROWS)
    leagues = values.select(F.col(league_col).alias("league_key")).distinct()
    cond = (F.col("match_mode") == "default") | _hits(_league(F.col("league_key")), F.col("match_mode"), F.col("pattern"))
    # priority: non-default before default; longer pattern first; rule order
    prio = F.struct((F.col("match_mode") == "default").alias("is_default"),
                    _neg_len().alias("neg_len"), F.col("rule_no"))
    hit = F.min_by(F.struct("tier", "region"), prio)
    # The null key must survive the join, so join on a null-safe surrogate.
    m = (leagues.join(rules, cond, "left")
         .groupBy("league_key")
         .agg(hit.alias("hit")))
    return m.select(
        "league_key",
        F.coalesce(F.col("hit.tier"), F.lit(2)).cast("int").alias("tier"),
        F.coalesce(F.col("hit.region"), F.lit("Unknown")).alias("region"),
    )


def _ordered_rules(rules: DataFrame) -> list | None:
    """The rule rows in lookup priority, or None when there are too many to
    inline.  Rules are configuration: at most MAX_INLINE_RULES + 1 rows are
    brought to the driver."""
    rows = (rules.orderBy((F.col("match_mode") == "default"), _neg_len(), "rule_no")
            .limit(MAX_INLINE_RULES + 1).collect())
    return rows if len(rows) <= MAX_INLINE_RULES else None


def rule_expr(league: Column, rows: list) -> Column:
    """C11 as a Column: struct(tier int, region string)."""
    l = _league(league)
    out = None
    default = None
    for r in rows:
        val = F.struct(F.lit(int(r["tier"])).alias("tier"), F.lit(r["region"]).cast("string").alias("region"))
        if r["match_mode"] == "default":
            if default is None:
                default = val
            continue
        if r["pattern"] is None or r["match_mode"] not in ("exact", "contains"):
            continue
        cond = _hits(l, F.lit(r["match_mode"]), F.lit(r["pattern"]))
        out = F.when(cond, val) if out is None else out.when(cond, val)
    if default is None:
        default = F.struct(F.lit(2).alias("tier"), F.lit("Unknown").alias("region"))
    return default if out is None else out.otherwise(default)


def assign_tier_region(df: DataFrame, league_col: str, rules: DataFrame,
                       tier_col: str = "tier", region_col: str = "region_m") -> DataFrame:
    """C11 applied to every row: adds ``tier`` and ``region_m``."""
    rows = _ordered_rules(rules)
    if rows is not None:
        hit = rule_expr(F.col(league_col), rows)
        return df.withColumns({tier_col: hit["tier"], region_col: hit["region"]})
    m = league_map(df, league_col, rules)
    m = broadcast_if_small(m, MAX_BROADCAST_ROWS)
    out = df.join(m, df[league_col].eqNullSafe(m["league_key"]), "left")
    return out.drop("league_key").withColumnsRenamed({"tier": tier_col, "region": region_col}) \
        if tier_col != "tier" or region_col != "region" else out.drop("league_key")

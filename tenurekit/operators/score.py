"""Batch scoring (I14) with request validation (C24) and labels.

The reference serves one request (or a batch capped at 50) per call; here a
whole DataFrame of requests is scored in one job: validate -> encode ->
predict (negative binomial length, Cox survival curve and median) -> label.
Invalid rows are kept with their list of errors and null predictions.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean, maps
from ..session import broadcast_if_small
from . import models as M


def validate(req: DataFrame, valid_leagues: Sequence[str] = maps.VALID_LEAGUES,
             valid_roles: Sequence[str] = maps.VALID_ROLES, debut_range=(6, 15),
             role_case: str = "capitalize") -> DataFrame:
    """League upper-cased, role capitalised (or upper-cased), debut an
    integer in range; ``errors`` lists every failed rule.  As in the
    request schema, only an integer-typed debut counts as an integer: a text
    or floating-point debut column fails the integer rule."""
    league = F.upper(F.coalesce(F.col("league").cast("string"), F.lit("")))
    r = F.coalesce(F.col("role").cast("string"), F.lit(""))
    role = F.upper(r) if role_case == "upper" else F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.expr("substring(coalesce(cast(role as string), ''), 2)")))
    integral = dict(req.dtypes).get("debut") in ("tinyint", "smallint", "int", "bigint")
    debut = F.col("debut").cast("int") if integral else F.lit(None).cast("int")
    lo, hi = debut_range
    is_int = F.lit(integral) & debut.isNotNull()
    errs = F.array_compact(F.array(
        F.when(~league.isin(list(valid_leagues)), F.lit(f"'league' must be one of {list(valid_leagues)}")),
        F.when(~role.isin(list(valid_roles)), F.lit(f"'role' must be one of {list(valid_roles)}")),
        F.when(F.col("debut").isNull(), F.lit(f"'debut' (season number {lo}-{hi}) is required"))
         .when(~is_int | (debut < lo) | (debut > hi), F.lit(f"'debut' must be an integer between {lo} and {hi}")),
    ))
    return req.withColumns({"league_v": league, "role_v": role, "debut_v": debut, "errors": errs})


def confidence_labels(train: DataFrame, league_col: str = "League") -> DataFrame:
    """Group size per league from the training data -> high (>=150),
    medium (>=80), low."""
    n = F.count(F.lit(1))
    return train.groupBy(F.col(league_col).alias("league_v")).agg(
        F.when(n >= 150, "high").when(n >= 80, "medium").otherwise("low").alias("confidence"))


def interpretation(pred: Column, league: Column, debut: Column, long_league: str, era_cutoff: int = 9) -> Column:
    """Three sentences on expected length, league and era."""
    first = (F.when(pred >= 4.0, F.lit("This player profile has above-average career longevity expectations."))
             .when(pred >= 2.5, F.lit("This player profile has an average career length expectation."))
             .otherwise(F.lit("This player profile has a below-average career length expectation.")))
    second = F.concat(F.lit("Players in "), league, F.lit(" average "),
                      F.when(league == long_league, "longer").otherwise("shorter"),
                      F.lit(" careers than most leagues."))
    early = debut <= era_cutoff
    third = F.concat(F.lit("Debuting in "), F.when(early, "early era").otherwise("recent era"), F.lit(" "),
                     F.when(early, "increases").otherwise("slightly reduces"),
                     F.lit(" expected career length due to more seasons available."))
    return F.concat_ws(" ", first, second, third)


def score(req: DataFrame, *, nb_coefs: DataFrame, cox_coefs: DataFrame, baseline: DataFrame,
          cox_means: dict[str, float], labels: DataFrame, leagues: Sequence[str], roles: Sequence[str],
          ref_league: str, ref_role: str, debut_range=(6, 15), role_case: str = "capitalize",
          long_league: str = "LCK", era_cutoff: int = 9) -> DataFrame:
    """Full batch scoring."""
    v = validate(req, [*leagues], [*roles], debut_range, role_case)
    ok = F.size("errors") == 0
    enc = v.withColumns({**{f"League_{clean_name(l)}": (F.col("league_v") == l).cast("int")
                            for l in leagues if l != ref_league},
                         **{f"Role_{clean_name(r)}": (F.col("role_v") == r).cast("int")
                            for r in roles if r != ref_role},
                         "Early_Era": clean.early_era("debut_v", era_cutoff)})
    nb_feats = [c for c in enc.columns if c.startswith("League_") or c.startswith("Role_")] + ["Early_Era"]
    enc = M.predict_linear_exp(enc, nb_coefs, nb_feats, "predicted_seasons")
    enc = M.partial_hazard(enc, cox_coefs, cox_means, "risk")
    # the curve is computed row by row, so requests may repeat an id
    enc = M.survival_curve(enc, baseline, "risk", "_curve")
    enc = enc.withColumns({
        "survival_probs": F.map_from_arrays(F.array(*[F.lit(t) for t in range(1, 11)]), F.transform("_curve", lambda s: F.round(s, 4))),
        "survival_50pct": M.median_time(F.col("_curve"))})
    out = enc.join(broadcast_if_small(labels), "league_v", "left")
    return out.select(
        "request_id", F.col("name"), F.col("league_v").alias("league"), F.col("role_v").alias("role"),
        F.col("debut_v").alias("debut"),
        F.when(ok, F.col("predicted_seasons")).alias("predicted_seasons"),
        F.when(ok, F.col("survival_50pct")).alias("survival_50pct"),
        F.when(ok, F.col("survival_probs")).alias("survival_probs"),
        F.when(ok, F.coalesce(F.col("confidence"), F.lit("low"))).alias("confidence"),
        F.when(ok, interpretation(F.col("predicted_seasons"), F.col("league_v"), F.col("debut_v"),
                                  long_league, era_cutoff)).alias("interpretation"),
        "errors")


def clean_name(v: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in v)

"""Answers must not change with the size of an input: rule tables, tie sums,
quantiles, concordance, splits, rank tests on constant data, repeated ids."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenurekit.operators import models as M
from tenurekit.operators import ranktests as R
from tenurekit.operators import score as S
from tenurekit.operators.prefix import exact_quantiles, running_before
from tenurekit.operators.rules import assign_tier_region, rules_frame
from tenurekit.operators.wiki import name_probe
from tenurekit.sources import landing as L


def test_rules_agree_for_64_and_65_rules(spark):
    head = [(None, "contains", "1", "NULLPAT"), ("\tLCK ", " Exact", "1", "KR"), ("lPl", None, "1", "CN"), (" academy\n", "CONTAINS", "x", "AC")]
    fill = [(f"never {i}", "exact", "2", "N") for i in range(59)]
    default = [("__DEFAULT__", "default", "2", "Def")]
    leagues = spark.createDataFrame([("LCK",), (" LCK\t",), ("lck",), ("xx LPL yy",), ("EU Academy",), (None,), ("",)], "league string")
    got = []
    for rules in (head + fill + default, head + fill + [("never x", "exact", "2", "N")] + default):
        out = assign_tier_region(leagues, "league", rules_frame(spark, rules))
        got.append(sorted((r.league or "-", r.tier, r.region_m if "region_m" in out.columns else r.region) for r in out.collect()))
    assert got[0] == got[1]
    assert ("LCK", 1, "KR") in got[0] and ("lck", 2, "Def") in got[0] and ("xx LPL yy", 1, "CN") in got[0] and ("EU Academy", 2, "AC") in got[0]


@pytest.mark.parametrize("s0,d0,d", [(50.0, 20.0, 10), (500.0, 499.0, 300), (3000.0, 3000.0, 1000), (1e5, 300.0, 200), (1e7, 4e6, 5000), (1e6, 5e4, 70)])
def test_tie_sums_equal_the_direct_sums(s0, d0, d):
    f = np.arange(d) / d
    a = s0 - f * d0
    want = [np.log(a).sum(), (1 / a).sum(), (f / a).sum(), (1 / a**2).sum(), (f / a**2).sum(), (f * f / a**2).sum()]
    assert M.tie_sums(s0, d0, d) == pytest.approx(want, rel=1e-8)


def test_tie_sums_take_constant_time():
    out = M.tie_sums(3.0e8, 1.2e8, 10**8)
    assert all(math.isfinite(x) for x in out)


def test_exact_quantiles(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, rnd.random(), 1.0])) for _ in range(500)] + [("c", None), ("d", 3.0)]
    got = exact_quantiles(spark.createDataFrame(rows, "g string, v double"), "v", {"q": 0.37, "m": 0.5}, ["g"]).collect()
    by = {r.g: (r.q, r.m) for r in got}
    for g in {r[0] for r in rows} - {"c"}:
        v = [x for k, x in rows if k == g and x is not None]
        assert by[g] == pytest.approx((np.quantile(v, 0.37), np.quantile(v, 0.5)))
    assert "c" not in by


def test_running_before_over_two_columns(spark):
    rows = [(i % 3, i, i * 2 + 1) for i in range(40)]
    got = {(r.a, r.b): r.before for r in running_before(spark.createDataFrame(rows, "a int, b int, c long"), ["a", "b"], "c", partitions=5).collect()}
    total = 0
    for a, b, c in sorted(rows):
        assert got[a, b] == total
        total += c


def test_concordance_equals_all_pairs(spark):
    rnd = random.Random(3)
    rows = [(float(rnd.randint(1, 9)), rnd.randint(0, 1), round(rnd.random(), 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "t double, e int, s double")
    out = M.concordance(df, "t", "e", "s")
    r = out.first()
    pairs = [(a, b) for a in rows for b in rows if a[1] == 1 and b[0] > a[0]]
    assert (r.concordant, r.tied, r.comparable) == (sum(a[2] < b[2] for a, b in pairs), sum(a[2] == b[2] for a, b in pairs), len(pairs))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_split_leaves_no_stratum_without_test_rows(spark):
    df = spark.createDataFrame([(f"p{i}", "big" if i < 200 else f"s{i % 20}") for i in range(240)] + [("alone", "one")], "id string, g string")
    got = M.split_train_test(df, "id", stratum=F.col("g")).groupBy("stratum", "split").count().collect()
    n = {(r["stratum"], r["split"]): r["count"] for r in got}
    strata = {k for k, _ in n}
    assert all(n.get((s, "test"), 0) >= 1 for s in strata) and all(n.get((s, "train"), 0) >= 1 for s in strata - {"one"})
    assert 20 <= n["big", "test"] <= 60


def test_rank_tests_on_constant_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "g string, v double")
    r = R.kruskal_wallis_p(R.kruskal_wallis(df, "g", "v")).first()
    assert r.h is None and r.p_value is None
    m = R.mann_whitney_p(R.mann_whitney_pairs(df, "g", "v")).first()
    assert m.u_a == 0.5 and m.p_value is None


def test_pairs_of_many_groups(spark):
    df = spark.createDataFrame([(f"g{i}", float(i % 7)) for i in range(150)], "g string, v double")
    assert R.mann_whitney_pairs(df, "g", "v").count() == 150 * 149 // 2


def test_many_probes(spark):
    names = spark.createDataFrame([("Faker",), ("Caps",)], "Player string")
    probes = spark.range(10_001).selectExpr("concat('p', id) AS probe").union(spark.createDataFrame([("Caps",), ("fak",)], "probe string"))
    got = name_probe(names, probes).collect()
    assert len(got) == 10_003 and {(r.probe, r.suggestion) for r in got if r.found or r.suggestion} == {("Caps", None), ("fak", "Faker")}


def test_missing_season_files_are_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        L.season_files(spark, str(tmp_path))
    (tmp_path / "player_careers_S16.csv").write_text("x")
    assert L.season_files(spark, f"file://{tmp_path}") == [f"file://{tmp_path}/player_careers_S16.csv"]


def test_requests_may_repeat_an_id(spark):
    req = spark.createDataFrame([("r1", "n", "lck", "mid", 7), ("r1", "n", "lec", "top", 12)], "request_id string, name string, league string, role string, debut int")
    terms = ["League_LCK", "Role_Mid", "Early_Era"]
    nb = spark.createDataFrame([("const", 0.5)] + [(t, 0.1) for t in terms], "term string, coef double")
    cox = spark.createDataFrame([(t, 0.2) for t in terms], "term string, coef double")
    base = spark.createDataFrame([(float(t), 0.1 * t) for t in range(2, 9)], "time double, cum_hazard double")
    out = S.score(req, nb_coefs=nb, cox_coefs=cox, baseline=base, cox_means={t: 0.0 for t in terms},
                  labels=spark.createDataFrame([("LCK", "high")], "league_v string, confidence string"),
                  leagues=["LCK", "LEC"], roles=["Mid", "Top"], ref_league="LEC", ref_role="Top").collect()
    by = {r.league: r for r in out}
    assert len(out) == 2 and by["LCK"].confidence == "high" and by["LEC"].confidence == "low"
    assert by["LEC"].survival_probs[1] == 1.0 and by["LEC"].survival_probs[10] == pytest.approx(round(math.exp(-0.8), 4))
    assert by["LEC"].survival_50pct == 7 and by["LCK"].survival_probs[3] == pytest.approx(round(math.exp(-0.3 * math.exp(0.6)), 4))

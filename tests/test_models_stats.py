"""Models and rank tests against small numpy references (scipy is not
available, so the references are written out here)."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tenurekit.operators import describe as D
from tenurekit.operators import models as M
from tenurekit.operators import ranktests as R


def test_chi2_sf_known_values():
    # textbook 5% critical values
    for x, k in [(3.841459, 1), (5.991465, 2), (7.814728, 3), (11.0705, 5), (16.918978, 9)]:
        assert abs(R._chi2_sf(x, k) - 0.05) < 1e-5
    assert R._chi2_sf(74.27, 9) < 1e-4


def _cox_reference(X, t, e, pen):
    """Row-level penalised Efron Cox fit by Newton's method on standardised X."""
    n, p = X.shape
    mu, sd = X.mean(0), X.std(0)
    sd[sd == 0] = 1
    Z = (X - mu) / sd
    b = np.zeros(p)
    for _ in range(100):
        w = np.exp(Z @ b)
        g = -n * pen * b
        H = -n * pen * np.eye(p)
        for tt in np.unique(t[e == 1]):
            risk = t >= tt
            dead = (t == tt) & (e == 1)
            d = dead.sum()
            s0, s1 = w[risk].sum(), (w[risk, None] * Z[risk]).sum(0)
            s2 = (w[risk, None, None] * Z[risk, :, None] * Z[risk, None, :]).sum(0)
            d0, d1 = w[dead].sum(), (w[dead, None] * Z[dead]).sum(0)
            d2 = (w[dead, None, None] * Z[dead, :, None] * Z[dead, None, :]).sum(0)
            g += Z[dead].sum(0)
            for l in range(d):
                f = l / d
                a0, a1, a2 = s0 - f * d0, s1 - f * d1, s2 - f * d2
                g -= a1 / a0
                H -= a2 / a0 - np.outer(a1, a1) / a0 ** 2
        step = np.linalg.solve(H, g)
        b = b - step
        if np.abs(step).max() < 1e-10:
            break
    return b / sd


def test_cox_matches_row_level_reference(spark):
    rng = np.random.default_rng(7)
    n = 300
    X = np.column_stack([rng.integers(0, 2, n), rng.integers(0, 2, n), rng.normal(size=n)]).astype(float)
    t = rng.integers(1, 8, n).astype(float)          # heavy ties
    e = (rng.random(n) < 0.7).astype(int)
    pdf = pd.DataFrame({"x1": X[:, 0], "x2": X[:, 1], "x3": X[:, 2], "t": t, "e": e})
    df = spark.createDataFrame(pdf)
    coefs, baseline, info = M.fit_cox(df, "t", "e", ["x1", "x2", "x3"], penalizer=0.1)
    got = np.array([r.coef for r in coefs.orderBy("term").collect()])
    ref = _cox_reference(X, t, e, 0.1)
    assert np.allclose(got, ref, atol=1e-6), (got, ref)
    bl = [r.cum_hazard for r in baseline.orderBy("time").collect()]
    assert all(b2 >= b1 for b1, b2 in zip(bl, bl[1:]))


def test_concordance_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    n = 120
    t = rng.integers(1, 6, n)
    e = rng.integers(0, 2, n)
    s = rng.integers(0, 4, n).astype(float)
    num = den = 0.0
    for i in range(n):
        if not e[i]:
            continue
        for j in range(n):
            if t[j] > t[i]:
                den += 1
                num += 1.0 if s[i] < s[j] else (0.5 if s[i] == s[j] else 0.0)
    df = spark.createDataFrame(pd.DataFrame({"t": t, "e": e, "s": s}))
    r = M.concordance(df, "t", "e", "s").collect()[0]
    assert r.comparable == den and abs(r.c_index - num / den) < 1e-12


def _midranks(v):
    order = np.argsort(v, kind="mergesort")
    ranks = np.empty(len(v))
    sv = v[order]
    i = 0
    while i < len(v):
        j = i
        while j + 1 < len(v) and sv[j + 1] == sv[i]:
            j += 1
        ranks[order[i:j + 1]] = (i + j) / 2 + 1
        i = j + 1
    return ranks


def test_kruskal_and_mann_whitney(spark):
    rng = np.random.default_rng(11)
    g = rng.choice(["a", "b", "c"], 200)
    v = rng.integers(1, 9, 200).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"g": g, "v": v}))
    N = len(v)
    rk = _midranks(v)
    H = 12 / (N * (N + 1)) * sum(rk[g == k].sum() ** 2 / (g == k).sum() for k in "abc") - 3 * (N + 1)
    _, cnt = np.unique(v, return_counts=True)
    H /= 1 - (cnt ** 3 - cnt).sum() / (N ** 3 - N)
    kw = R.kruskal_wallis(df, "g", "v").collect()[0]
    assert abs(kw.h - H) < 1e-9 and kw.df == 2
    mw = {(r.a, r.b): r for r in R.mann_whitney_pairs(df, "g", "v").collect()}
    m = (g == "a") | (g == "b")
    rr = _midranks(v[m])
    na = (g[m] == "a").sum()
    u = rr[g[m] == "a"].sum() - na * (na + 1) / 2
    assert abs(mw[("a", "b")].u_a - u) < 1e-9
    p = R.mann_whitney_p(R.mann_whitney_pairs(df, "g", "v")).collect()
    assert all(0 <= r.p_value <= 1 for r in p)


def test_sample_skew_and_corr(spark):
    x = np.array([1.0, 2.0, 2.0, 3.0, 10.0])
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": x * 2, "c": np.ones(5)}))
    n = len(x)
    m2 = ((x - x.mean()) ** 2).mean()
    m3 = ((x - x.mean()) ** 3).mean()
    ref = m3 / m2 ** 1.5 * math.sqrt(n * (n - 1)) / (n - 2)
    got = df.agg(D.sample_skew("x")).collect()[0][0]
    assert abs(got - ref) < 1e-12
    cor = {(r.a, r.b): r.corr for r in D.correlations(df, ["x", "y", "c"]).collect()}
    assert abs(cor[("x", "y")] - 1.0) < 1e-12 and cor[("x", "c")] is None


def test_negbin_recovers_poisson_like_data(spark):
    rng = np.random.default_rng(5)
    n = 800
    x = rng.integers(0, 2, n).astype(float)
    y = rng.poisson(np.exp(0.5 + 0.7 * x))
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y.astype(float)}))
    co = {r.term: r.coef for r in M.fit_negbin(df, "y", ["x"]).collect()}
    assert abs(co["const"] - 0.5) < 0.15 and abs(co["x"] - 0.7) < 0.15


def test_survival_and_median(spark):
    prof = spark.createDataFrame([("p", 1.0), ("q", 3.0)], "profile string, risk double")
    base = spark.createDataFrame([(1.0, 0.1), (3.0, 0.4), (5.0, 0.9)], "time double, cum_hazard double")
    s = M.survival_at(prof, base, times=[1, 2, 3, 4, 5, 6])
    got = {(r.profile, r.t): r.surv for r in s.collect()}
    assert abs(got[("p", 2)] - math.exp(-0.1)) < 1e-12 and abs(got[("q", 6)] - math.exp(-2.7)) < 1e-12
    med = {r.profile: r.median_survival for r in M.median_survival(s, "profile").collect()}
    assert med == {"p": 5, "q": 3}


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_running_before_matches_cumsum(spark, parts):
    from tenurekit.operators.prefix import running_before
    rng = np.random.default_rng(parts)
    v = rng.choice(np.arange(1000), 300, replace=False).astype(float)
    c = rng.integers(1, 5, 300)
    df = spark.createDataFrame(pd.DataFrame({"v": v, "c": c}))
    got = {r.v: r.before for r in running_before(df, "v", "c", partitions=parts).collect()}
    order = np.argsort(v)
    before = np.concatenate([[0], np.cumsum(c[order])[:-1]])
    assert all(got[v[i]] == before[k] for k, i in enumerate(order))


def test_histogram_constant_and_approx(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 5.0)], "g int, x double")
    h = D.histogram_equal_width(df, "x", 4).collect()
    assert [(r.bin, r["count"]) for r in h] == [(0, 3)]
    fixed = {r.bin: r["count"] for r in D.histogram_fixed(df, "x", [0.0, 5.0, 10.0]).collect()}
    assert fixed == {1: 3}
    a = D.group_stats(df, "g", "x", approx=True).collect()
    assert all(r.median == 5.0 for r in a)

"""Range-split scans (Cox, Mann-Whitney, Kaplan-Meier, grouped running sums)
against plain numpy, with values shared by very many rows."""

import os
import subprocess
import sys
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenurekit.operators import cox as C
from tenurekit.operators import extras as X
from tenurekit.operators import ranktests as R
from tenurekit.operators.prefix import running_sums


def plain_cox(t, e, x, penalizer, steps=60):
    """Efron's partial likelihood by Newton over the sorted distinct times."""
    n, p = x.shape
    mean, sd = x.mean(axis=0), x.std(axis=0)
    z = (x - mean) / np.where(sd == 0, 1, sd)
    b = np.zeros(p)
    for _ in range(steps):
        g, h = -n * penalizer * b, -n * penalizer * np.eye(p)
        w = np.exp(z @ b)
        for time in np.unique(t[e == 1]):
            risk, dead = t >= time, (t == time) & (e == 1)
            d = int(dead.sum())
            wr, zr, wd, zd = w[risk], z[risk], w[dead], z[dead]
            s0, s1, s2 = wr.sum(), wr @ zr, (zr * wr[:, None]).T @ zr
            d0, d1, d2 = wd.sum(), wd @ zd, (zd * wd[:, None]).T @ zd
            g = g + zd.sum(axis=0)
            for k in range(d):
                f = k / d
                a = s0 - f * d0
                m = (s1 - f * d1) / a
                g = g - m
                h = h - ((s2 - f * d2) / a - np.outer(m, m))
        step = np.linalg.solve(h, g)
        b = b - step
        if np.abs(step).max() < 1e-10:
            break
    w = np.exp(z @ b)
    times = np.unique(t)
    cum = np.cumsum([((t == u) & (e == 1)).sum() / w[t >= u].sum() for u in times])
    return b / np.where(sd == 0, 1, sd), np.sqrt(np.diag(np.linalg.inv(-h))) / np.where(sd == 0, 1, sd), dict(zip(times, cum))


@pytest.mark.parametrize("hot", [0.0, 0.34, 1.0])
def test_cox_on_continuous_durations(spark, hot):
    rng = np.random.default_rng(int(hot * 100))
    n = 700
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 2, n), np.ones(n)])
    t = rng.exponential(np.exp(-0.5 * x[:, 0] + 0.4 * x[:, 1]))
    t = np.where(rng.random(n) < hot, 0.5, t)  # a time shared by a third of the rows, or by all
    e = (rng.random(n) < 0.7).astype(int)
    df = spark.createDataFrame([(float(a), int(b), *map(float, r)) for a, b, r in zip(t, e, x)], "t double, e int, a double, b double, c double").repartition(5)
    df = df.unionByName(spark.createDataFrame([(None, 1, 0.0, 0.0, 0.0), (1.0, 1, None, 0.0, 0.0)], df.schema))  # incomplete rows
    coefs, baseline, info = C.fit_cox(df, "t", "e", ["a", "b", "c"], penalizer=0.05)
    want, se, cum = plain_cox(t, e, x, 0.05)
    got = {r.term: r for r in coefs.collect()}
    assert [got[c].coef for c in "abc"] == pytest.approx(want.tolist(), abs=1e-6)
    assert [got[c].se for c in "ab"] == pytest.approx(se[:2].tolist(), abs=1e-6)
    rows = {r.time: r.cum_hazard for r in baseline.collect()}
    assert info["n"] == n and len(rows) == len(cum)
    for k in cum:
        assert rows[k] == pytest.approx(cum[k], abs=1e-6)


def test_cox_step_returns_three_rows_a_range_at_most(spark):
    df = spark.range(4000).select((F.col("id") * 1.0).alias("t"), F.lit(1).alias("e"), (F.col("id") % 7).alias("x"))
    seen = []
    original = C._range_scan

    def watch(beta, before):
        seen.append(len(before))
        return original(beta, before)
    C._range_scan = watch
    try:
        C.fit_cox(df, "t", "e", ["x"])
    finally:
        C._range_scan = original
    assert seen and max(seen) <= 8  # ranges, whatever the number of durations


def test_cox_without_rows(spark):
    with pytest.raises(ValueError):
        C.fit_cox(spark.createDataFrame([], "t double, e int, x double"), "t", "e", ["x"])


def test_mann_whitney_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(R, "PAIR_CELLS", 64)  # small blocks: values and pairs are cut
    rng = np.random.default_rng(4)
    rows = [(f"g{i}", float(v)) for i in range(6) for v in np.round(rng.normal(i / 5, 1, 200), 1 if i % 2 else 3)]
    rows += [("g0", 0.5)] * 900 + [("g1", 0.5)] * 500 + [("g2", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    by = {k: np.array([v for g, v in rows if g == k and v is not None]) for k in {g for g, _ in rows if g}}
    got = {(r.a, r.b): r for r in R.mann_whitney_pairs(df, "g", "v").collect()}
    assert len(got) == 15
    for (a, b), r in got.items():
        x, y = by[a], by[b]
        u = (x[:, None] > y[None]).sum() + 0.5 * (x[:, None] == y[None]).sum()
        _, c = np.unique(np.concatenate([x, y]), return_counts=True)
        assert (r.n_a, r.n_b, r.u_a, r.u_b) == (len(x), len(y), u, len(x) * len(y) - u)
        assert r.tie == pytest.approx(float((c.astype(float) ** 3 - c).sum()))
    some = R.mann_whitney_pairs(df, "g", "v", spark.createDataFrame([("g0", "g3"), ("g0", "nowhere")], "a string, b string")).collect()
    assert [(r.a, r.b, r.u_a) for r in some] == [("g0", "g3", got["g0", "g3"].u_a)]
    assert R.mann_whitney_pairs(df.limit(0), "g", "v").count() == 0


def test_mann_whitney_plan_has_no_window_by_pair(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "g string, v double")
    plan = R.mann_whitney_pairs(df, "g", "v")._jdf.queryExecution().toString()
    assert "windowspecdefinition(a" not in plan and "Cartesian" not in plan


def test_kaplan_meier_without_groups(spark):
    rng = np.random.default_rng(8)
    t, e = np.round(rng.exponential(3, 800), 2), rng.integers(0, 2, 800)
    t[:300], e[np.argmax(t)] = 1.0, 1
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(t, e)] + [(None, 1)], "t double, e int").repartition(3)
    got = {r.t: r for r in X.kaplan_meier(df, "t", "e").collect()}
    s = 1.0
    for u in np.unique(t):
        n, d = int((t >= u).sum()), int(((t == u) & (e == 1)).sum())
        s *= 1 - d / n
        assert (got[u].n_at_risk, got[u].d) == (n, d) and got[u].survival == pytest.approx(s, abs=1e-9)
    plan = X.kaplan_meier(df, "t", "e")._jdf.queryExecution().executedPlan().toString()
    assert got[max(got)].survival == 0.0 and len(got) == len(np.unique(t)) and "_later" in plan


def test_running_sums_by_group(spark):
    rng = np.random.default_rng(3)
    rows = [(None if k == 0 else f"g{k}", i, float(rng.integers(1, 9))) for k in range(5) for i in range(80)]
    df = spark.createDataFrame(rows, "g string, i int, v double").repartition(6)
    got = {(r.g, r.i): (r.up, r.n) for r in running_sums(df.withColumn("one", F.lit(1)), ["g"], [F.desc("i")], {"up": "v", "n": "one"}).collect()}
    for g, i, _ in rows:
        later = [v for a, b, v in rows if a == g and b > i]
        assert got[g, i] == (sum(later), len(later))


def test_workers_import_the_package_from_any_folder():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("test data not present")
    code = (f"import sys; sys.path.insert(0, {root!r})\nimport __spark_entry__ as E\nfrom tenurekit.session import build_session\n"
            "s = build_session('local[2]', 4)\nprint('ROWS', E.queries()['rank_mann_whitney_p'](s, '/root/testdata/sf0.001').count())")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(), env=env, capture_output=True, text=True, timeout=600)
    assert "ROWS" in done.stdout, done.stderr[-2000:]

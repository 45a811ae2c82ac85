"""Fits that sum over distinct rows and their numbers give what the rows give;
work that is needed again is stored once."""

import numpy as np
import pytest
from pyspark.ml.regression import GeneralizedLinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from tenurekit.operators import cox as C
from tenurekit.operators import models as M
from tenurekit.session import MOST_BYTES, apply_scale_conf


def rows(spark, n=3000, seed=3):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 4, n), rng.integers(1, 3, n)
    y = (rng.random(n) < 1 / (1 + np.exp(0.5 - 0.4 * a + 0.3 * b))).astype(int)
    t = 1 + rng.integers(0, 6, n)
    return spark.createDataFrame([tuple(map(int, r)) for r in zip(a, b, y, t)], "a int, b int, y int, t int")


def test_logit_steps_over_distinct_rows(spark, monkeypatch):
    df = rows(spark)
    glr = GeneralizedLinearRegression(family="binomial", link="logit", labelCol="y", featuresCol="features", maxIter=100)
    plain = glr.fit(M.assemble(df, ["a", "b"]))
    seen = []
    original = M.assemble
    monkeypatch.setattr(M, "assemble", lambda d, *k: seen.append((d.count(), d.rdd.getNumPartitions())) or original(d, *k))
    got = {r.term: r for r in M.fit_logit(df, "y", ["a", "b"]).collect()}
    assert seen == [(16, 1)]
    assert [got[c].coef for c in ("a", "b", "const")] == pytest.approx([*plain.coefficients, plain.intercept], rel=1e-7)
    assert [got[c].p_value for c in ("a", "b", "const")] == pytest.approx(list(plain.summary.pValues), rel=1e-5, abs=1e-12)
    assert got["a"].n_obs == 3000 and got["a"].aic == pytest.approx(plain.summary.aic, rel=1e-9)
    assert got["a"].pseudo_r2 == pytest.approx(1 - plain.summary.deviance / plain.summary.nullDeviance, rel=1e-9)


def test_cox_and_negbin_read_distinct_rows(spark, monkeypatch):
    df = rows(spark)
    seen = []
    original = C.step_sums
    monkeypatch.setattr(C, "step_sums", lambda d, beta: seen.append(d.count()) or original(d, beta))
    coefs, baseline, info = C.fit_cox(df, "t", "y", ["a", "b"])
    assert info["n"] == 3000 and set(seen) == {6 * 2 * 4 * 2}
    assert baseline.count() == 6
    # equal rows told apart by a covariate without weight: the same sums, no row shared
    apart = df.withColumn("z", F.monotonically_increasing_id() * 1e-15)
    other = {r.term: r for r in C.fit_cox(apart, "t", "y", ["a", "b", "z"], penalizer=1e3)[0].collect()}
    ridge = {r.term: r for r in C.fit_cox(df, "t", "y", ["a", "b"], penalizer=1e3)[0].collect()}
    assert max(seen) == 3000
    assert [ridge[c].coef for c in "ab"] == pytest.approx([other[c].coef for c in "ab"], rel=1e-3)
    monkeypatch.setattr(M, "cut_lineage", lambda d, keep=M.cut_lineage: seen.append(("negbin", keep(d).count())) or keep(d))
    M.fit_negbin(df, "t", ["a", "b"])
    assert seen[-1] == ("negbin", 6 * 4 * 2)


def test_forest_runs_on_no_more_partitions_than_cores(spark, monkeypatch):
    seen = []
    original = RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, d, *k: seen.append((d.count(), d.rdd.getNumPartitions())) or original(self, d, *k))
    M.fit_random_forest(rows(spark).repartition(40), ["a", "b"], "t", num_trees=3)
    assert seen == [(3000, spark.sparkContext.defaultParallelism)]


def test_forest_grows_few_trees_at_once_into_the_same_trees(spark, monkeypatch):
    seen = []
    original = RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, d, *k: seen.append((self, d)) or original(self, d, *k))
    df = rows(spark).withColumn("c", F.rand(5)).cache()
    model = M.fit_random_forest(df, ["a", "b", "c"], "t", num_trees=40)
    (rf, data), trees = seen[0], lambda m: m.toDebugString.split("\n", 1)[1]
    assert rf.getMaxMemoryInMB() == M.PASS_MB
    assert trees(model) == trees(original(rf.copy({rf.maxMemoryInMB: 256}), data))
    assert M.pass_mb(12) == 2 and M.pass_mb(100) >= 200 * 100 * 32 * 24 / 2**20 and M.pass_mb(10**6) == 256


def test_task_bytes_are_bounded_and_smaller_settings_stay(spark):
    keys = list(MOST_BYTES)
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "128MB")
        spark.conf.set(keys[1], "8m")
        apply_scale_conf(spark)
        assert spark.conf.get(keys[0]) == str(16 << 20) and spark.conf.get(keys[1]) == "8m"
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_bundle_reads_the_panel_once(spark, monkeypatch):
    from tenurekit.plans import q_models, q_reports
    calls = []
    original = q_models.model_frame
    monkeypatch.setattr(q_models, "model_frame", lambda *a: calls.append("panel") or original(*a))
    monkeypatch.setitem(q_reports.PARAMS, "forest", {"num_trees": 5, "max_depth": 3, "min_leaf": 5})
    out = {r.league: r for r in q_reports.q_bundle_score(spark, "/root/testdata/sf0.001").collect()}
    assert calls == ["panel"] and out and all(r.n_different == 0 and r.n_valid == r.n_requests for r in out.values())
    calls.clear()
    q_models.q_survival(spark, "/root/testdata/sf0.001").count()
    assert calls == ["panel"]

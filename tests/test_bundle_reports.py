"""Model bundle versions and nested report assembly."""

import json

import pytest
from pyspark.sql import functions as F

from tenurekit.operators import bundle as B
from tenurekit.operators import models as M
from tenurekit.sources.landing import report_json


@pytest.fixture(scope="module")
def small(spark):
    rows = [(f"p{i}", i % 7 + 1, float(i % 5), float(i % 3), "A" if i % 2 else "B") for i in range(60)]
    df = spark.createDataFrame(rows, "Player string, y int, f1 double, f2 double, League string")
    feats = ["f1", "f2"]
    forest = M.fit_random_forest(df, feats, "y", num_trees=3, max_depth=3)
    terms = "term string, coef double, se double, z double, p_value double, hazard_ratio double, significant boolean"
    cox = spark.createDataFrame([("League_A", 0.1, 0.2, 0.5, 0.6, 1.1, False)], terms)
    nb = spark.createDataFrame([("const", 1.0, 0.1, 0.0, 0.2), ("League_A", 0.2, 0.1, 0.1, 0.2)], "term string, coef double, se double, p_value double, alpha double")
    return df, B.assemble(
        spark, forest=forest, features=feats, medians=M.median_values(df, feats), cox_coefs=cox,
        baseline=spark.createDataFrame([(1.0, 0.1), (2.0, 0.3)], "time double, cum_hazard double"), cox_means={"League_A": 0.5},
        nb_coefs=nb, labels=spark.createDataFrame([("A", "low")], "league_v string, confidence string"),
        vocabulary={"league": (["A", "B"], "B"), "role": (["X"], "X")},
        metrics=spark.createDataFrame([("forest", "test", "mae", 0.5)], "model string, split string, metric string, value double"))


def test_versions_are_committed_in_order(spark, small, tmp_path):
    _, made = small
    root = str(tmp_path / "b")
    with pytest.raises(FileNotFoundError):
        B.load(spark, root)
    assert [B.save(made, root), B.save(made, root)] == [1, 2]
    assert B.versions(spark, root) == [1, 2]
    assert B.load(spark, root).version == 2 and B.load(spark, root, 1).version == 1
    with pytest.raises(FileNotFoundError):
        B.load(spark, root, 9)


def test_uncommitted_folder_is_invisible_and_claims_are_exclusive(spark, small, tmp_path):
    _, made = small
    root = str(tmp_path / "b")
    made.tables["terms"].write.parquet(f"{root}/data-dead/terms")  # a writer that died
    assert B.versions(spark, root) == []
    assert B._claim(spark, root, 1, "data-other") is True
    assert B._claim(spark, root, 1, "data-late") is False
    assert B.save(made, root) == 2


def test_reloaded_bundle_scores_alike(spark, small, tmp_path):
    df, made = small
    root = str(tmp_path / "b")
    B.save(made, root)
    back = B.load(spark, root)
    assert back.levels("league") == (["A", "B"], "B") and back.feature_list() == ["f1", "f2"] and back.cox_means() == {"League_A": 0.5}
    a = {r["Player"]: r["predicted_length"] for r in B.predict_length(made, df).collect()}
    b = {r["Player"]: r["predicted_length"] for r in B.predict_length(back, df).collect()}
    assert a == b and len(a) == 60
    # a missing column takes the median of the bundle
    gone = {r["Player"]: r["predicted_length"] for r in B.predict_length(back, df.drop("f2")).collect()}
    filled = {r["Player"]: r["predicted_length"] for r in B.predict_length(back, df.withColumn("f2", F.lit(1.0))).collect()}
    assert gone == filled
    req = spark.createDataFrame([(1, "n", "a", "x", 7), (1, "n", "zz", "x", 7)], "request_id int, name string, league string, role string, debut int")
    x = [B.score_requests(b_, req, role_case="upper").collect() for b_ in (made, back)]
    assert sorted(map(str, x[0])) == sorted(map(str, x[1]))


def test_nested_report(spark):
    empty = spark.createDataFrame([], "a int, b int")
    one = spark.createDataFrame([(1, None)], "a int, b int")
    many = spark.createDataFrame([(2, "y"), (1, "x\"q")], "n int, k string")
    got = report_json({"one": one, "n": one.select(F.col("a").alias("n")), "list": many.select(F.col("n").alias("_ord"), "k"),
                       "by": {"key": many.select(F.col("k").alias("_key"), "n"), "fixed": [1, "a"]},
                       "none": empty, "no_rows": empty.withColumnRenamed("a", "_ord"), "no_keys": empty.withColumnRenamed("a", "_key")}, nulls=True).first()[0]
    assert json.loads(got) == {"one": {"a": 1, "b": None}, "n": 1, "list": [{"k": "x\"q"}, {"k": "y"}],
                               "by": {"key": {"x\"q": {"n": 1}, "y": {"n": 2}}, "fixed": [1, "a"]}, "none": None, "no_rows": [], "no_keys": {}}
    assert list(json.loads(got)) == ["one", "n", "list", "by", "none", "no_rows", "no_keys"]
    with pytest.raises(ValueError):
        report_json({"a": 1})

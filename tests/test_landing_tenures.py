"""Per-file column kinds, idempotent append, unions of tenures."""

import datetime as dt

from pyspark.sql import functions as F

from tenurekit.functions import clean
from tenurekit.operators import tenures as T
from tenurekit.sources import landing as L
from tenurekit.streaming.incremental import scratch_dir


def test_values_follow_the_kind_of_their_file(spark):
    rows = [("a", "38.0", "0.62"), ("a", "12", ""), ("a", None, "1"),      # numeric file
            ("b", "38.0", "62%"), ("b", "-", "0.62"), ("b", " 7 ", "NaN"),  # text file
            ("c", "NA", None)]                                              # nothing at all
    df = spark.createDataFrame(rows, "file string, Games string, `Win rate` string")
    got = L.reconcile_columns(df, "file").select("file", "Games", F.round("Win rate", 6)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        ("a", 38, 0.62), ("a", 12, None), ("a", None, 1.0), ("b", None, 0.62), ("b", None, 0.0062), ("b", 7, None), ("c", None, None)], key=str)
    # more files than the bound: the same through a shuffle join
    many = L.reconcile_columns(df, "file", max_files=1).select("file", "Games", F.round("Win rate", 6)).collect()
    assert sorted(map(str, many)) == sorted(map(str, got))


def test_numeric_columns_keep_their_scale(spark):
    df = spark.createDataFrame([(0.62, 38.0, "0.62", "38.0")], "wr double, g double, wt string, gt string")
    r = df.select(clean.parse_percent("wr"), clean.parse_games("g"), clean.parse_percent("wt"), clean.parse_games("gt")).first()
    assert tuple(r) == (0.62, 38, 0.0062, None)


def test_append_is_idempotent(spark):
    target = scratch_dir(spark, "t-append")
    a = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "k int, v string")
    assert L.append_new_rows(spark, a, target).count() == 2
    assert L.append_new_rows(spark, a, target).count() == 0
    more = spark.createDataFrame([(2, "x"), (2, None), (3, "z")], "k int, v string")
    assert sorted(map(str, L.append_new_rows(spark, more, target).collect())) == sorted(["Row(k=2, v=None)", "Row(k=3, v='z')"])
    assert L.append_new_rows(spark, more.limit(0), target).count() == 0
    assert spark.read.parquet(target).count() == 4


D = dt.date
SCHEMA = "p string, region string, s date, e date, out boolean"


def test_union_of_tenures(spark):
    rows = [("x", "A", D(2020, 1, 1), D(2020, 3, 1), False), ("x", "A", D(2020, 2, 1), D(2020, 2, 10), False),   # inside the first
            ("x", "A", D(2020, 3, 1), D(2020, 3, 11), False),                                                     # touches
            ("x", "B", D(2020, 1, 1), None, False), ("x", " ", D(2010, 1, 1), D(2020, 1, 1), False),
            ("y", "A", D(2020, 5, 1), D(2020, 4, 1), False), ("y", "A", None, D(2020, 4, 1), False),              # not valid
            ("z", "B", D(2020, 1, 1), D(2020, 1, 11), True), ("z", "A", D(2020, 1, 1), D(2020, 1, 11), None),
            ("f", "A", D(2021, 1, 1), None, False)]                                                               # after as_of
    df = spark.createDataFrame(rows, SCHEMA)
    as_of = F.lit(D(2020, 3, 11))
    got = {r.p: tuple(r)[1:] for r in T.modal_by_time(df, "p", "region", "s", "e", as_of).collect()}
    assert got == {"x": ("A", 70, 1, 140, 2), "z": ("A", 10, 1, 20, 2)}
    st = {r.p: (r.last_active, r.open, r.status) for r in T.recency_status(df, "p", "s", "e", F.lit(D(2020, 9, 12)), "out").collect()}
    assert st["x"] == (D(2020, 9, 12), True, "Active") and st["z"] == (D(2020, 1, 11), False, "Retired") and set(st) == {"x", "z"}
    edge = lambda d: T.recency_status(df.where("p = 'z' AND region = 'A'"), "p", "s", "e", F.lit(d), "out").first().status
    assert [edge(D(2020, 7, 11)), edge(D(2020, 7, 12)), edge(D(2021, 7, 11)), edge(D(2021, 7, 12))] == ["Active", "Inactive", "Inactive", "Retired"]
    assert T.modal_by_time(df.limit(0), "p", "region", "s", "e", as_of).count() == 0

"""Sinks, persistence and lookup-replacement queries."""

from __future__ import annotations

import os

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ..functions import clean
from ..session import broadcast_by_estimate
from ..sources import landing as L
from ..sources.tables import read_table
from ..streaming.incremental import scratch_dir
from .driver import PANEL_SQL, STATS_SQL, RULES_SQL, dims, driver_panel, driver_stats, with_sql
from .registry import register


@register("sink_roundtrip", with_sql(PANEL_SQL) + """
SELECT entity, period, split, league, row_id FROM panel""", ("A6", "A8"))
def q_sinks(spark, sf_dir):
    """Write the panel partitioned by period as Parquet (A8) and as JSON Lines
    (A6), read both back with declared schemas and keep the JSON copy."""
    base = scratch_dir(spark, "sinks")
    rows = driver_panel(spark, sf_dir, need=()).select("entity", "period", "split", "league", "row_id")
    L.write_table(rows, os.path.join(base, "parquet"), partition_by=["period"])
    back = spark.read.parquet(os.path.join(base, "parquet"))
    L.export_jsonl(back.select(*rows.columns), os.path.join(base, "jsonl"))
    return L.read_jsonl(spark, os.path.join(base, "jsonl"), rows.schema)


@register("model_persistence", None, ())
def q_persist(spark, sf_dir):
    """Fit a pipeline, save it under the shared folder, load it back and
    score with the loaded copy (A11)."""
    o = read_table(spark, sf_dir, "orders", "o_totalprice", "o_orderdate")
    d = o.select(F.col("o_totalprice").alias("y"), F.year("o_orderdate").cast("double").alias("year"),
                 F.month("o_orderdate").cast("double").alias("month"))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["year", "month"], outputCol="features"),
                            LinearRegression(featuresCol="features", labelCol="y", solver="normal")])
    path = os.path.join(scratch_dir(spark, "model"), "pipeline")
    pipe.fit(d).write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    lr = loaded.stages[-1]
    return spark.createDataFrame([("intercept", float(lr.intercept))] +
                                 [(n, float(c)) for n, c in zip(["year", "month"], lr.coefficients.toArray())],
                                 "term string, coef double")


FRONT = ["player", "season", "country", "team"]


@register("country_lookup_replace", with_sql(PANEL_SQL, RULES_SQL, STATS_SQL) + """
SELECT s.player, s.season, upper(substr(n.n_name, 1, 2)) || '-' || CAST(c.c_nationkey AS VARCHAR) AS country, s.team,
       s.row_no, s.league, s.role, s.tier, s.games, s.win_rate, s.kda
FROM stats s LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = s.player
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""", ("E7", "C27", "C14"))
def q_country(spark, sf_dir):
    """Replace the stats' country column with a per-player lookup
    (old column dropped, lookup broadcast by size estimate); C27: named
    columns first, the rest after."""
    stats = driver_stats(spark, sf_dir)
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = dims(spark, sf_dir)
    lookup = c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").cast("string").alias("player"),
        F.concat(F.upper(F.substring("n_name", 1, 2)), F.lit("-"), F.col("c_nationkey").cast("string")).alias("country"))
    out = stats.drop("country").join(broadcast_by_estimate(lookup), "player", "left")
    return out.select(*clean.reorder_columns(out.columns, FRONT))

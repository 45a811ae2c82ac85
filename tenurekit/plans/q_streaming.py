"""Step 9: incremental ingest and incremental panel refresh, replaying the
driver panel as three landed batches (the middle one holds the *earliest*
seasons, arriving late)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..streaming import incremental as I
from .driver import PANEL_SQL, driver_panel, driver_rules, with_sql
from .q_panel import LABEL_KW, LONGITUDINAL_SQL
from .registry import register

def chunks():
    return [F.col("period").between(1997, 1998), F.col("period") <= 1996, F.col("period") >= 1999]


def _replay(spark, sf_dir, refresh: bool):
    base = I.scratch_dir(spark, "replay")
    landing, history, panel = (os.path.join(base, x) for x in ("landing", "history", "panel"))
    rows = driver_panel(spark, sf_dir, need=()).select("entity", "period", "split", "league", "row_id")
    I.land_in_chunks(rows, landing, chunks())
    cb = None
    if refresh:
        cb = I.panel_refresher(spark, history, panel, driver_rules(spark), entity="entity", period="period",
                               league="league", split="split", tiebreak="row_id", **LABEL_KW)
    I.run_ingest(spark, landing, rows.schema, history, os.path.join(base, "ckpt"), on_batch=cb,
                 max_files_per_trigger=4, bucket_by=("entity", 64))
    return history, panel


@register("stream_ingest", with_sql(PANEL_SQL) + """
SELECT entity, period, split, league, row_id FROM panel""", ("S1", "A10"))
def q_ingest(spark, sf_dir):
    history, _ = _replay(spark, sf_dir, refresh=False)
    return I.read_history(spark, history)


@register("stream_panel_refresh", LONGITUDINAL_SQL, ("S2",))
def q_refresh(spark, sf_dir):
    _, panel = _replay(spark, sf_dir, refresh=True)
    return I.read_panel(spark, panel)


@register("stream_jsonl_ingest", with_sql(PANEL_SQL) + """
SELECT CASE WHEN row_id % 101 = 0 OR row_id % 103 = 0 THEN 'not readable under the schema' WHEN row_id % 107 = 0 THEN 'no entity' ELSE 'ok' END AS status,
       CASE WHEN row_id % 101 = 0 OR row_id % 103 = 0 OR row_id % 107 = 0 THEN NULL ELSE entity END AS entity,
       CASE WHEN row_id % 101 = 0 OR row_id % 103 = 0 OR row_id % 107 = 0 THEN NULL ELSE period END AS period,
       CASE WHEN row_id % 101 = 0 OR row_id % 103 = 0 OR row_id % 107 = 0 THEN NULL ELSE league END AS league, row_id
FROM panel""", ("S1",))
def q_jsonl(spark, sf_dir):
    """The panel landed as JSON Lines in three batches; some lines are cut
    short, some hold text for a number, some have no entity.  What the stream
    let in, and its quarantine."""
    base = I.scratch_dir(spark, "jsonl")
    landing, history, bad = (os.path.join(base, x) for x in ("landing", "history", "quarantine"))
    rows = driver_panel(spark, sf_dir, need=()).select("entity", "period", "split", "league", "row_id")
    line = (F.when(F.col("row_id") % 101 == 0, F.expr("substring(line, 1, length(line) - 3)"))
            .when(F.col("row_id") % 103 == 0, F.regexp_replace("line", r'"period":(\d+)', '"period":"in $1"')).otherwise(F.col("line")))
    made = rows.withColumn("line", F.to_json(F.struct("row_id", F.when(F.col("row_id") % 107 != 0, F.col("entity")).alias("entity"), "period", "split", "league")))
    made = made.withColumn("line", line)
    for i, cond in enumerate(chunks()):
        made.where(cond).select("line").write.text(os.path.join(landing, f"batch={i:04d}"))
    I.run_ingest_jsonl(spark, landing, rows.schema, history, bad, os.path.join(base, "ckpt"), required=("entity",), max_files_per_trigger=4,
                       bucket_by=("entity", 16))
    good = I.read_history(spark, history).select(F.lit("ok").alias("status"), "entity", "period", "league", "row_id")
    none = spark.read.parquet(bad).select(
        F.col("reason").alias("status"), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("entity", "period", "league")],
        F.regexp_extract("raw", r'"row_id":(\d+)', 1).cast("long").alias("row_id"))
    return good.unionByName(none)

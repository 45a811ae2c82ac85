"""Incremental loads on Structured Streaming.

S1 — ingest: a file stream over a landing directory with a checkpoint, so
every landed file is processed exactly once across restarts; each
micro-batch is written to its own ``_epoch=<id>`` folder of the history table
(overwrite, so a replayed batch is idempotent), partitioned by entity bucket.
Files are Parquet, or JSON Lines with a declared schema; JSON records that do
not parse, or lack a required field, go to a quarantine table with their text,
file and reason.

S2 — panel refresh: in the same ``foreachBatch`` the longitudinal panel takes
in the batch.  A batch is collapsed to one row per entity with the order of its
debut row; such rows merge to what all rows together give, so an earlier season
arriving late moves the debut although no old row is read again.  The panel is
stored partitioned by an entity bucket.  A batch's rows wait beside it
(``_delta``, merged on read) until those of a bucket outweigh the bucket, and are
then folded into it (dynamic partition overwrite of the touched buckets): the
work of a batch follows its size, not that of the history.  Small buckets are
folded at once.  The panel knows which epochs, rules and settings it holds; when
they do not go on from there (a first run, a replayed batch, epochs it has not
seen, other rules, a fold that was cut off) it is built anew from the history.
Censoring depends on the newest period of all, so it is not stored but derived
on read from the newest last season of the panel: a new period reaches the
buckets it touches and no other, also after a restart.  The number of buckets
is kept with the tables; a run with another one is an error.  What is read
equals a batch run over the same rows.

All paths live under the shared checkpoint folder (``spark.checkpoint.dir``),
never on machine-local disk.
"""

from __future__ import annotations

import json
import os
import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.panel import CENSORING, LONGITUDINAL_COLUMNS, ORDER, build_longitudinal, merge_longitudinal
from ..session import ensure_checkpoint_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def land_in_chunks(df: DataFrame, landing: str, chunks: list[Column]) -> None:
    """Write ``df`` to the landing folder as one sub-folder per chunk, in the
    given order (used to replay a table as arriving batches)."""
    for i, cond in enumerate(chunks):
        df.where(cond).write.mode("overwrite").parquet(os.path.join(landing, f"chunk={i:04d}"))


def _bucket(entity: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.col(entity)), F.lit(n)).cast("int")


def _folder(spark: SparkSession, folder: str, *name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(folder, *name))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def agree_on_buckets(spark: SparkSession, folder: str, n: int) -> None:
    """Keep the number of buckets with a table; another number is an error."""
    fs, path = _folder(spark, folder, "_layout")  # hidden from table readers
    if fs.exists(path):
        stream = fs.open(path)
        known = int(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        if known != n:
            raise ValueError(f"{folder} has {known} buckets, not {n}")
        return
    out = fs.create(path, False)
    out.write(bytearray(str(n).encode()))
    out.close()


def _write_epoch(batch: DataFrame, target: str, bucket_by: tuple[str, int] | None) -> None:
    """One folder per epoch, overwritten: a batch replayed after a failure
    replaces its own output instead of appending it twice."""
    if bucket_by is not None:
        batch.withColumn("_bucket", _bucket(*bucket_by)).write.mode("overwrite").partitionBy("_bucket").parquet(target)
    else:
        batch.write.mode("overwrite").parquet(target)


def run_ingest(spark: SparkSession, landing: str, schema: StructType, history: str,
               checkpoint: str, on_batch=None, max_files_per_trigger: int | None = None,
               bucket_by: tuple[str, int] | None = None) -> None:
    """Process every file under ``landing`` once; append to ``history``
    (partitioned by entity bucket when ``bucket_by=(entity, n)``, so later
    per-bucket reads prune partitions); optionally call
    ``on_batch(batch_df, epoch_id)`` after the append."""
    if bucket_by is not None:
        agree_on_buckets(spark, history, bucket_by[1])
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        _write_epoch(batch, os.path.join(history, f"_epoch={epoch_id}"), bucket_by)
        if on_batch is not None:
            on_batch(batch, epoch_id)

    q = (reader.parquet(landing).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def judge_records(rows: DataFrame, corrupt: str, required: Sequence[str]) -> DataFrame:
    """Adds ``_reason``: null for a good record, else why it is quarantined."""
    reason = F.when(F.col(corrupt).isNotNull(), F.lit("not readable under the schema"))
    for c in required:
        reason = reason.when(F.col(c).isNull(), F.lit(f"no {c}"))
    return rows.withColumn("_reason", reason)


def run_ingest_jsonl(spark: SparkSession, landing: str, schema: StructType, history: str, quarantine: str, checkpoint: str,
                     required: Sequence[str] = (), on_batch=None, max_files_per_trigger: int | None = None,
                     bucket_by: tuple[str, int] | None = None) -> None:
    """S1 over JSON Lines.  Every line is read as text and parsed under the
    declared ``schema``: good records go to ``history``, lines that are no JSON
    object, hold a value of another type or lack a ``required`` field go to
    ``quarantine`` (``raw``, ``file``, ``reason``), both by epoch.  Blank lines
    are no records."""
    if bucket_by is not None:
        agree_on_buckets(spark, history, bucket_by[1])
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.text(landing).select(F.col("value").alias("_raw"), F.col("_metadata.file_path").alias("_file"))
    names = [f.name for f in schema.fields]

    def handle(batch: DataFrame, epoch_id: int) -> None:
        rows = parse_lines(batch, schema, required).persist()
        try:
            good = rows.where(F.col("_reason").isNull()).select(*[f"`{c}`" for c in names])
            _write_epoch(good, os.path.join(history, f"_epoch={epoch_id}"), bucket_by)
            bad = rows.where(F.col("_reason").isNotNull()).select(F.col("_raw").alias("raw"), F.col("_file").alias("file"), F.col("_reason").alias("reason"))
            _write_epoch(bad, os.path.join(quarantine, f"_epoch={epoch_id}"), None)
            if on_batch is not None:
                on_batch(good, epoch_id)
        finally:
            rows.unpersist()

    q = lines.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def parse_lines(lines: DataFrame, schema: StructType, required: Sequence[str]) -> DataFrame:
    """Lines (``_raw``, ...) with the fields of ``schema`` and ``_reason``."""
    wide = StructType([*schema.fields, StructField("_corrupt", StringType())])
    parsed = F.from_json("_raw", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = lines.where(F.trim("_raw") != "").withColumn("_p", parsed)
    rows = rows.select(*lines.columns, *[F.col(f"_p.`{f.name}`").alias(f.name) for f in wide.fields])
    # a line that is JSON but no object parses to nothing at all
    rows = rows.withColumn("_corrupt", F.coalesce("_corrupt", F.when(~F.ltrim("_raw").startswith("{"), F.col("_raw"))))
    return judge_records(rows, "_corrupt", required).drop("_corrupt")


# Buckets of so many bytes in all may be rewritten for any batch; larger ones wait
# until their waiting rows outweigh them or lie in so many files.
FOLD_BYTES, FOLD_FILES = 16 << 20, 100


def _delta(panel: str) -> str:
    return os.path.join(panel, "_delta")  # hidden from table readers


def _bucket_files(spark: SparkSession, pattern: str) -> dict[int, list[int]]:
    """Sizes of the Parquet files that match, by the bucket of their folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found: dict[int, list[int]] = {}
    for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []:
        found.setdefault(int(f.getPath().getParent().getName().split("=")[1]), []).append(f.getLen())
    return found


def _waiting(spark: SparkSession, panel: str, epoch: str = "*") -> dict[int, list[int]]:
    return _bucket_files(spark, os.path.join(_delta(panel), f"_epoch={epoch}", "_bucket=*", "*.parquet"))


def _stored(spark: SparkSession, panel: str) -> dict[int, list[int]]:
    return _bucket_files(spark, os.path.join(panel, "_bucket=*", "*.parquet"))


def _panel_parts(spark: SparkSession, panel: str) -> tuple[DataFrame, bool]:
    """The stored rows, and whether some wait to be merged."""
    if not _waiting(spark, panel):
        return spark.read.parquet(panel), False
    new = spark.read.option("basePath", _delta(panel)).parquet(os.path.join(_delta(panel), "*")).drop("_epoch")
    return (spark.read.parquet(panel).unionByName(new) if _stored(spark, panel) else new), True


def _write_buckets(rows: DataFrame, n_buckets: int, target: str, dynamic: bool) -> None:
    out = rows.withColumn("_bucket", _bucket("player", n_buckets)).repartition("_bucket")  # one file per bucket
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .partitionBy("_bucket").parquet(target))


def panel_refresher(spark: SparkSession, history: str, panel: str, rules: DataFrame, *,
                    entity: str, period: str, n_buckets: int = 64, **build_kw):
    """Returns the ``on_batch`` callback that refreshes the stored panel."""
    for folder in (history, panel):
        agree_on_buckets(spark, folder, n_buckets)
    made_with: list[str] = []

    def settings() -> str:
        if not made_with:
            h = F.xxhash64(*[F.col(f"`{c}`") for c in rules.columns])
            r = rules.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.cast("decimal(20,0)"))).first()
            made_with.append(repr((entity, period, sorted(build_kw.items()), tuple(map(str, r)))))
        return made_with[0]

    def collapsed(rows: DataFrame) -> DataFrame:
        lon = build_longitudinal(rows, rules, F.lit(None).cast("int"), entity=entity, period=period, keep_order=True, **build_kw)
        return lon.drop(*CENSORING)

    def drop_delta(buckets: list[int] | None = None) -> None:
        fs, root = _folder(spark, _delta(panel))
        if buckets is None:
            fs.delete(root, True)
            return
        for e in fs.listStatus(root):
            for b in buckets:
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(e.getPath(), f"_bucket={b}"), True)

    def rebuild() -> None:
        _keep_state(spark, panel, None)
        _write_buckets(collapsed(spark.read.parquet(history).drop("_bucket", "_epoch")), n_buckets, panel, True)
        drop_delta()

    def take_in(batch: DataFrame, epoch_id: int) -> None:
        _write_buckets(collapsed(batch), n_buckets, os.path.join(_delta(panel), f"_epoch={epoch_id}"), False)
        touched = list(_waiting(spark, panel, str(epoch_id)))
        stored, new = _stored(spark, panel), _waiting(spark, panel)
        held = {b: sum(stored.get(b, [])) for b in touched}
        fold = touched if sum(held.values()) <= FOLD_BYTES else [b for b in touched if sum(new[b]) >= held[b] or len(new[b]) >= FOLD_FILES]
        if fold:
            _keep_state(spark, panel, None)
            parts, _ = _panel_parts(spark, panel)
            _write_buckets(merge_longitudinal(parts.where(F.col("_bucket").isin(fold)).drop("_bucket")), n_buckets, panel, True)
            drop_delta(fold)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        if _kept_state(spark, panel) == [epoch_id - 1, settings()]:
            take_in(batch, epoch_id)
        else:
            rebuild()
        _keep_state(spark, panel, [epoch_id, settings()])

    return on_batch


def _kept_state(spark: SparkSession, panel: str):
    """The newest epoch in the panel and what it was made with, or None."""
    fs, path = _folder(spark, panel, "_state")
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    try:
        return json.loads(text)
    except ValueError:  # cut off while it was written
        return None


def _keep_state(spark: SparkSession, panel: str, state) -> None:
    """None while the stored buckets change."""
    fs, path = _folder(spark, panel, "_state")
    if state is None:
        fs.delete(path, False)
        return
    out = fs.create(path, True)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()


def read_panel(spark: SparkSession, panel: str) -> DataFrame:
    """The stored panel with its censoring, as of its newest period."""
    parts, waiting = _panel_parts(spark, panel)
    newest = parts.agg(F.max("last_season")).scalar()
    parts = parts.drop("_bucket")
    df = merge_longitudinal(parts) if waiting else parts
    df = df.drop(*[c for c in df.columns if c.startswith(ORDER)])
    censored = ~F.col("ever_reached_tier1") & (F.col("last_season") >= newest - 1)
    df = df.withColumns({"censored": censored, "right_censored_no_tier1": censored.cast("int")})
    return df.select(*LONGITUDINAL_COLUMNS, *[c for c in df.columns if c not in LONGITUDINAL_COLUMNS])


def read_history(spark: SparkSession, history: str) -> DataFrame:
    return spark.read.parquet(history).drop("_bucket", "_epoch")

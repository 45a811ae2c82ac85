"""Sources and sinks for landed files.

Reads declare their schema (no inference pass over the data), keep file
order as a ``_line`` column taken at the scan (partition index, then row
index: increasing through each file), and read many files as one scan.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROSTER_SCHEMA = T.StructType([
    T.StructField("player", T.StringType()),
    T.StructField("team", T.StringType()),
    T.StructField("role", T.StringType()),
    T.StructField("league", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("split", T.StringType()),
    T.StructField("is_starter", T.StringType()),
])

# Season statistics land as text; parsing happens in the operators.
SEASON_STAT_COLUMNS = [
    "Player", "Country", "Games", "Win rate", "KDA", "Avg kills", "Avg deaths", "Avg assists",
    "CSM", "GPM", "KP%", "DMG%", "Gold%", "VS%", "DPM", "VSPM", "Avg WPM", "Avg WCPM", "Avg VWPM",
    "GD@15", "CSD@15", "XPD@15", "FB %", "FB Victim", "Penta Kills", "Solo Kills",
]
ENRICHED_EXTRA = ["Team", "League", "Role", "Tier", "SeasonTierChange", "MidSeasonMove", "AllTeams"]


def with_file_order(df: DataFrame) -> DataFrame:
    return df.withColumn("_line", F.monotonically_increasing_id())


def read_roster(spark: SparkSession, path: str) -> DataFrame:
    """A4 + D1: schema'd roster read; blank player rows dropped."""
    df = (spark.read.schema(ROSTER_SCHEMA).option("header", True).option("mode", "PERMISSIVE")
          .csv(path))
    df = with_file_order(df)
    return df.where(F.col("player").isNotNull() & (F.trim(F.col("player")) != ""))


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any file system that Spark reads; a missing folder
    is an error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(path))


def season_files(spark: SparkSession, csv_dir: str, seasons=None, pattern: str = "player_careers_S{n}.csv") -> list[str]:
    """The season files of a folder, in season order: all there are, or those
    of ``seasons`` that exist.  No match at all is an error."""
    shape = re.compile(re.escape(pattern).replace(re.escape("{n}"), r"(\d+)"))
    found = {int(m[1]): n for n in list_names(spark, csv_dir) if (m := shape.fullmatch(n))}
    out = [f"{csv_dir.rstrip('/')}/{found[n]}" for n in sorted(found) if seasons is None or n in seasons]
    if not out:
        raise FileNotFoundError(f"no file like {pattern} in {csv_dir}")
    return out


def load_season_csvs(spark: SparkSession, paths: list[str], enriched: bool = True) -> DataFrame:
    """A1 + H1: all season files in one scan, every column as text, season
    number from the file name (``_S<n>``), file order kept."""
    cols = SEASON_STAT_COLUMNS + (ENRICHED_EXTRA if enriched else [])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    if not paths:
        return spark.createDataFrame([], schema.add("season", T.IntegerType()).add("_line", T.LongType()))
    df = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
          .option("enforceSchema", False).csv(paths))
    df = with_file_order(df)
    # the file's own name, or that of the folder a distributed writer made of it
    return df.withColumn("season", F.regexp_extract(F.col("_metadata.file_path"), r"_S(\d+)[^/]*(?:/part-[^/]*)?$", 1).try_cast("int"))


# FIXED VALUES: texts that a CSV reader takes as missing.
MISSING_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
                 "NULL", "NaN", "None", "n/a", "nan", "null"]


def numeric_columns(df: DataFrame, file: str, cols: list[str]) -> DataFrame:
    """Per file, whether each column is numeric there: every value that is not
    missing reads as a number.  A column without values is numeric."""
    def fine(c):
        return F.coalesce(F.col(f"`{c}`"), F.lit("")).isin(MISSING_TEXTS) | F.col(f"`{c}`").try_cast("double").isNotNull()
    return df.groupBy(F.col(file).alias("_file")).agg(*[F.every(fine(c)).alias(f"_num_{i}") for i, c in enumerate(cols)])


def reconcile_columns(df: DataFrame, file: str, games: str = "Games", win_rate: str = "Win rate", max_files: int = 100_000) -> DataFrame:
    """C6/C7 across files that were landed apart: a column may be numeric in
    one file and text in another, and its values follow its own file.  Games of
    a numeric file are truncated (38.0 -> 38), those of a text file count only
    as integers; a win rate of a numeric file is a fraction (0.62), one of a
    text file a percentage.  Both columns come back numeric.  The kinds are one
    row per file: broadcast up to ``max_files`` files, joined beyond."""
    kinds = numeric_columns(df, file, [games, win_rate])
    if df.select(file).distinct().limit(max_files + 1).count() <= max_files:
        kinds = F.broadcast(kinds)
    out = df.join(kinds, F.col(file).eqNullSafe(F.col("_file")))
    text = lambda c: F.when(~F.col(f"`{c}`").isin(MISSING_TEXTS), F.col(f"`{c}`"))
    return out.withColumns({
        games: F.when(F.col("_num_0"), text(games).try_cast("double").try_cast("long")).otherwise(F.trim(text(games)).try_cast("long")),
        win_rate: F.when(F.col("_num_1"), text(win_rate).try_cast("double"))
                   .otherwise(F.regexp_replace(F.trim(text(win_rate)), "%", "").try_cast("double") / 100.0),
    }).drop("_file", "_num_0", "_num_1")


def read_season_folder(spark: SparkSession, folder: str, seasons=None, enriched: bool = True) -> DataFrame:
    """A1 + H1 + D1: every season file of a folder in one scan, rows without a
    player left out, games and win rate by the kind of their own file."""
    df = load_season_csvs(spark, season_files(spark, folder, seasons), enriched)
    df = df.where(F.trim(F.coalesce(F.col("Player"), F.lit(""))) != "")
    return reconcile_columns(df, "season")


def load_sheet_dirs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame | None]:
    """A2: workbook sheets landed as one directory each.  Directories named
    ``S<digits>`` are season sheets (one frame, season from the name); the
    first directory whose name contains 'career' is the enrichment sheet."""
    names = list_names(spark, root)
    season_dirs = [n for n in names if re.fullmatch(r"S\d+", n)]
    career = next((n for n in names if "career" in n.lower()), None)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in SEASON_STAT_COLUMNS])
    paths = [f"{root.rstrip('/')}/{n}" for n in season_dirs]
    seasons = (spark.read.schema(schema).option("header", True).csv(paths)
               .withColumn("season", F.regexp_extract(F.col("_metadata.file_path"), r"/S(\d+)/", 1).try_cast("int"))
               if paths else None)
    enr = (with_file_order(spark.read.option("header", True).csv(f"{root.rstrip('/')}/{career}"))
           if career else None)
    return with_file_order(seasons) if seasons is not None else None, enr


def export_jsonl(df: DataFrame, out: str, max_rows: int | None = None, order_by=None) -> None:
    """Write JSON Lines, optionally the first ``max_rows`` rows in
    ``order_by`` order (the cap is the feature: a bounded export)."""
    if max_rows is not None:
        df = df.orderBy(*(order_by or df.columns)).limit(max_rows)
    df.write.mode("overwrite").json(out)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def normalize_json_payload(raw: DataFrame, text_col: str, item_schema: T.StructType,
                           wrappers=("rows", "data", "records")) -> tuple[DataFrame, DataFrame]:
    """Each input row holds one JSON payload: a root array of objects, an
    object wrapping such an array under one of ``wrappers``, or a wiki-style
    ``cargoquery`` array of ``{title: {...}}``.  Non-object items are dropped;
    payloads of no known shape are kept apart with ``_bad_shape = true``."""
    arr = T.ArrayType(T.StringType())
    s = F.col(text_col)
    root = F.from_json(s, arr)
    wrapped = [F.get_json_object(s, f"$.{w}") for w in wrappers]
    cargo = F.from_json(F.get_json_object(s, "$.cargoquery"), arr)
    items = F.coalesce(
        F.when(F.trim(s).startswith("["), root),
        *[F.from_json(w, arr) for w in wrapped],
        F.transform(cargo, lambda x: F.get_json_object(x, "$.title")),
    )
    staged = raw.select("*", items.alias("_items"))
    good = (staged.where(F.col("_items").isNotNull())
            .select(F.explode("_items").alias("_item"))
            .where(F.trim(F.col("_item")).startswith("{"))
            .select(F.from_json("_item", item_schema).alias("r")).select("r.*"))
    bad = staged.where(F.col("_items").isNull()).drop("_items").withColumn("_bad_shape", F.lit(True))
    return good, bad


def write_table(df: DataFrame, out: str, partition_by: list[str] | None = None,
                fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Table sink (Parquet by default, partitioned for pruning)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(out)


def _json_key(key: Column) -> Column:
    """A string as a JSON string (quotes included)."""
    j = F.to_json(F.array(key))
    return F.substring(j, F.lit(2), F.length(j) - 2)


def _fragment(key: str, df: DataFrame, nulls: bool) -> DataFrame:
    """One part as one JSON text."""
    opts = {"ignoreNullFields": "false"} if nulls else {}
    body = [c for c in df.columns if c not in ("_ord", "_key")]
    if "_key" in df.columns:
        ord_col = F.col("_ord") if "_ord" in df.columns else F.col("_key")
        entries = F.array_sort(F.collect_list(F.struct(ord_col.alias("o"), F.concat(
            _json_key(F.col("_key")), F.lit(":"), F.to_json(F.struct(*body), opts)).alias("e"))))
        j = F.concat(F.lit("{"), F.array_join(F.transform(entries, lambda x: x["e"]), ","), F.lit("}"))
    elif "_ord" in df.columns:
        j = F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(F.col("_ord"), F.struct(*body).alias("v")))), lambda x: x["v"]), opts)
    elif body == [key]:  # a single column named like the key: its value itself
        j = F.to_json(F.first(F.struct(F.col(key))), {"ignoreNullFields": "false"})
        j = F.substring(j, F.lit(len(f'{{"{key}":') + 1), F.length(j) - len(f'{{"{key}":') - 1)
    else:
        j = F.to_json(F.first(F.struct(*body)), opts)
    return df.agg(F.coalesce(j, F.lit("null")).alias("j"))


def report_json(parts: dict, nulls: bool = False) -> DataFrame:
    """One-row JSON report with keys in the given order, assembled in one
    plan.  A part is

    * a one-row frame: an object (or, with one column named like the key, its value);
    * a frame with ``_ord``: an array of objects in that order;
    * a frame with ``_key``: an object of objects by key, in the order of ``_ord`` if there is one, else of the key;
    * a dict of parts: an object;
    * anything else: itself, as JSON.

    Every frame is reduced to one JSON fragment by Spark; the fragments are put
    together in key order, and the result is written with ``write.text``.
    ``nulls`` keeps fields without a value."""
    leaves: list[DataFrame] = []

    def shape(d: dict) -> list:
        pieces: list = ["{"]
        for k, (key, part) in enumerate(d.items()):
            pieces.append(("," if k else "") + json.dumps(key) + ":")
            if isinstance(part, dict):
                pieces += shape(part)
            elif isinstance(part, DataFrame):
                pieces.append(len(leaves))
                leaves.append(_fragment(key, part, nulls).select(F.lit(len(leaves)).alias("i"), "j"))
            else:
                pieces.append(json.dumps(part, separators=(",", ":"), ensure_ascii=False))
        return [*pieces, "}"]

    pieces = shape(parts)
    if not leaves:
        raise ValueError("a report needs at least one frame")
    frags = leaves[0]
    for f in leaves[1:]:
        frags = frags.unionByName(f)
    by = F.map_from_entries(F.collect_list(F.struct("i", "j")))
    return frags.agg(by.alias("m")).select(
        F.concat(*[F.lit(x) if isinstance(x, str) else F.element_at("m", F.lit(x)) for x in pieces]).alias("value"))


def resumable_append(spark: SparkSession, new_batches: DataFrame, done: DataFrame | None,
                     keys: list[str], target: str, fmt: str = "parquet") -> DataFrame:
    """A10: append only the (season[, league]) keys not already loaded.
    ``done`` holds the completed keys (read from the target table); the
    pending rows are ``new_batches ▷ done`` (anti-join), appended."""
    pending = new_batches if done is None else new_batches.join(done.select(*keys).distinct(), keys, "left_anti")
    pending.write.mode("append").format(fmt).save(target)
    return pending


def append_new_rows(spark: SparkSession, rows: DataFrame, target: str, columns: list[str] | None = None) -> DataFrame:
    """A10: idempotent append keyed by content.  A row is known by the sha-256
    of its ``columns`` (all by default); only rows whose key the target does not
    hold are appended, equal rows of one call once.  Returns the rows appended
    by this call, from the target.  A call that died half-way is simply
    repeated: what it wrote is found, the rest is added."""
    cols = columns or rows.columns
    keyed = rows.withColumn("_content", F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)).dropDuplicates(["_content"])
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    exists = fs.exists(path) and any(n.startswith("_call=") for n in list_names(spark, target))
    if exists:
        keyed = keyed.join(spark.read.parquet(target).select("_content"), "_content", "left_anti")
    call = uuid.uuid4().hex
    keyed.write.mode("error").parquet(f"{target}/_call={call}")
    return spark.read.schema(keyed.schema).parquet(f"{target}/_call={call}").drop("_content")

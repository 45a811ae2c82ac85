"""Versioned model bundle (A11): everything scoring needs, as one unit.

A bundle is a folder of small Parquet tables (coefficients with the covariate
means, baseline hazard, feature list, medians, vocabulary, confidence labels,
metrics) beside the forest in Spark ML's own format.  It is written under a
fresh name and becomes visible in one step: an exclusive create of the version
file ``versions/<number>`` that holds the folder's name.  A writer that dies
before leaves nothing that a reader could see, and of two writers that want the
same number one gets it and the other takes the next.  Scoring binds to a
version: ``load`` reads the tables lazily, so scoring stays one Spark job per
batch of requests.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import models as M
from . import score as S

TABLES = {
    "terms": "model string, position int, term string, coef double, se double, p_value double, hazard_ratio double, mean double",
    "baseline": "time double, cum_hazard double",
    "features": "position int, feature string, importance double",
    "medians": "feature string, median double",
    "vocabulary": "kind string, position int, value string, is_reference boolean",
    "labels": "league_v string, confidence string",
    "metrics": "model string, split string, metric string, value double",
}


@dataclass
class Bundle:
    """A bundle in memory or read from a version: one frame per table."""

    tables: dict[str, DataFrame]
    forest: RandomForestRegressionModel
    version: int | None = None

    def levels(self, kind: str) -> tuple[list[str], str]:
        """Values of a vocabulary in order, and the reference level (a
        configuration table: a handful of rows)."""
        rows = self.tables["vocabulary"].where(F.col("kind") == kind).orderBy("position").collect()
        return [r["value"] for r in rows], next(r["value"] for r in rows if r["is_reference"])

    def feature_list(self) -> list[str]:
        return [r["feature"] for r in self.tables["features"].orderBy("position").collect()]

    def coefficients(self, model: str) -> DataFrame:
        return self.tables["terms"].where(F.col("model") == model)

    def cox_means(self) -> dict[str, float]:
        return {r["term"]: r["mean"] for r in self.coefficients("cox").orderBy("position").collect()}


def assemble(spark: SparkSession, *, forest, features: Sequence[str], medians: DataFrame, cox_coefs: DataFrame,
             baseline: DataFrame, cox_means: dict[str, float], nb_coefs: DataFrame, labels: DataFrame,
             vocabulary: dict[str, tuple[Sequence[str], str]], metrics: DataFrame) -> Bundle:
    """Bring fitted parts into the tables of a bundle.  ``medians`` is the
    one-row frame of ``median_values``; ``vocabulary`` maps a kind to its levels
    and its reference level."""
    def make(name, rows):
        return spark.createDataFrame(rows, TABLES[name])

    null = lambda t: F.lit(None).cast(t)
    order = {t: i for i, t in enumerate(["const", *cox_means])}
    position = F.create_map(*[F.lit(x) for kv in order.items() for x in kv])
    means = F.create_map(*[F.lit(x) for kv in cox_means.items() for x in kv])
    cox = cox_coefs.select(F.lit("cox").alias("model"), F.element_at(position, F.col("term")).alias("position"),
                           "term", "coef", "se", "p_value", "hazard_ratio", F.element_at(means, F.col("term")).alias("mean"))
    nb = nb_coefs.select(F.lit("negbin").alias("model"), F.element_at(position, F.col("term")).alias("position"), "term", "coef", "se", "p_value",
                         null("double").alias("hazard_ratio"), null("double").alias("mean"))
    importance = forest.featureImportances.toArray().tolist()
    return Bundle({
        "terms": cox.unionByName(nb),
        "baseline": baseline.select("time", "cum_hazard"),
        "features": make("features", [(i, f, float(v)) for i, (f, v) in enumerate(zip(features, importance))]),
        "medians": medians.unpivot([], medians.columns, "feature", "median"),
        "vocabulary": make("vocabulary", [(k, i, v, v == ref) for k, (levels, ref) in vocabulary.items() for i, v in enumerate(levels)]),
        "labels": labels.select("league_v", "confidence"),
        "metrics": metrics.select("model", "split", "metric", F.col("value").cast("double").alias("value")),
    }, forest)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, oldest first."""
    fs, p = _fs(spark, f"{root}/versions")
    if not fs.exists(p):
        return []
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit())


def _claim(spark: SparkSession, root: str, number: int, folder: str) -> bool:
    """Create the version file if nobody has; the create is the commit."""
    fs, p = _fs(spark, f"{root}/versions/{number:06d}")
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if fs.exists(p):
            return False
        raise e
    out.write(bytearray(folder.encode()))
    out.close()
    return True


def save(bundle: Bundle, root: str) -> int:
    """Write the bundle as the next version of ``root`` and return its number."""
    spark = bundle.tables["terms"].sparkSession
    folder = f"data-{uuid.uuid4().hex}"
    for name, schema in TABLES.items():
        df = bundle.tables[name]
        df.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")]).coalesce(1).write.parquet(f"{root}/{folder}/{name}")
    bundle.forest.write().save(f"{root}/{folder}/forest")
    number = (versions(spark, root) or [0])[-1] + 1
    while not _claim(spark, root, number, folder):
        number += 1
    return number


def load(spark: SparkSession, root: str, version: int | None = None) -> Bundle:
    """A committed version (the newest by default)."""
    known = versions(spark, root)
    number = version if version is not None else (known or [None])[-1]
    if number not in known:
        raise FileNotFoundError(f"no bundle version {number} in {root}; there are {known}")
    folder = spark.read.text(f"{root}/versions/{number:06d}").first()[0]
    tables = {name: spark.read.schema(schema).parquet(f"{root}/{folder}/{name}") for name, schema in TABLES.items()}
    return Bundle(tables, RandomForestRegressionModel.load(f"{root}/{folder}/forest"), number)


def score_requests(bundle: Bundle, requests: DataFrame, **kw) -> DataFrame:
    """I14 from a bundle: vocabulary, coefficients, baseline, means and labels
    all come from its tables."""
    leagues, ref_league = bundle.levels("league")
    roles, ref_role = bundle.levels("role")
    return S.score(requests, nb_coefs=bundle.coefficients("negbin"), cox_coefs=bundle.coefficients("cox"),
                   baseline=bundle.tables["baseline"], cox_means=bundle.cox_means(), labels=bundle.tables["labels"],
                   leagues=leagues, roles=roles, ref_league=ref_league, ref_role=ref_role, **kw)


def predict_length(bundle: Bundle, rows: DataFrame, out: str = "predicted_length") -> DataFrame:
    """Forest prediction for feature rows; a missing feature value takes the
    bundle's median, a missing feature column counts as all missing."""
    wanted = bundle.feature_list()
    med = bundle.tables["medians"].agg(F.map_from_entries(F.collect_list(F.struct("feature", "median")))).scalar()
    filled = rows.withColumn("_med", med)
    filled = filled.withColumns({c: F.coalesce(F.col(c).cast("double") if c in rows.columns else F.lit(None).cast("double"),
                                               F.element_at("_med", F.lit(c)), F.lit(0.0)) for c in wanted})
    scored = bundle.forest.transform(M.assemble(filled, wanted, "_features").withColumnRenamed("_features", "features"))
    return scored.withColumnRenamed("prediction", out).drop("_med", "features")

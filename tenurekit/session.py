"""Session settings and small plan helpers shared by every operator.

Nothing here starts a server: the Spark UI stays off, and the checkpoint
folder is read from ``spark.checkpoint.dir`` (set by the cluster).  Only
callers that run without a cluster (tests, bench) set it themselves.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that matter at scale: AQE re-plans joins and coalesces partitions
# from runtime sizes, the skew-join rule splits hot keys, and timestamps are
# interpreted in UTC so results do not depend on the machine.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# At most so many bytes of a file or of a shuffle go to one task: hash aggregates
# that combine little (lines by order, the career pairs of orders dealt by order)
# take 10 to 30 times that in memory.  Smaller settings of the session stay.
MOST_BYTES = {"spark.sql.files.maxPartitionBytes": 16 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20}

# Upper bound on the rows of any side we broadcast explicitly.  Rule tables
# and per-value lookup maps are checked against it before the hint is given;
# larger sides fall back to a shuffle join (with AQE skew splitting).
MAX_BROADCAST_ROWS = 200_000


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tenurekit", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench.  On a cluster, use the
    cluster's session and only apply ``apply_scale_conf``."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_scale_conf(spark: SparkSession) -> None:
    for k, v in SCALE_CONF.items():
        if not k.startswith("spark.ui."):
            spark.conf.set(k, v)
    for k, most in MOST_BYTES.items():
        if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(k)) > most:
            spark.conf.set(k, str(most))


_shipped: dict[str, bool] = {}


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their
    Python workers import the driver's copy wherever they run."""
    sc = spark.sparkContext
    if _shipped.get(sc.applicationId):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tenurekit-py-"), "tenurekit_package.zip")  # read by the driver alone
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    _shipped[sc.applicationId] = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    When it is unset in a local run, a fresh scratch folder is created and
    registered; on a cluster that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir is not set; a cluster needs a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tenurekit-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only after proving it holds at most ``max_rows`` rows.

    The side is cached, counted once, and hinted for broadcast when small;
    otherwise it is returned unhinted so the planner shuffles both sides and
    AQE can split skewed partitions.
    """
    df = df.cache()
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of a plan (file sizes for scans), without
    running a job — the same statistic Spark's own broadcast rule reads."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - not available (e.g. remote sessions)
        return None


def broadcast_by_estimate(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES,
                          max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast a scanned dimension when its estimated size is under
    ``max_bytes``; without an estimate, fall back to a row count."""
    est = estimated_bytes(df)
    if est is not None:
        return F.broadcast(df) if est <= max_bytes else df
    return broadcast_if_small(df, max_rows)


def require_small(df: DataFrame, max_rows: int, what: str) -> DataFrame:
    """Broadcast a configuration table (rules, vocabularies) after a size check;
    a table above the bound is an input error, not something to shuffle."""
    n = df.count()
    if n > max_rows:
        raise ValueError(f"{what} has {n} rows; the limit is {max_rows}")
    return F.broadcast(df)

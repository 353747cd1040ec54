"""Spark session defaults and the shared checkpoint location.

The engine never depends on a machine-local folder at cluster scale: lineage is cut
with ``checkpoint()`` into the directory the cluster names in ``spark.checkpoint.dir``.
Only when that setting is absent (unit tests, local runs) do we pick a scratch folder.
"""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every query relies on: NTZ timestamps compared in UTC, ANSI on (coercing parses
# use try_*), adaptive execution for partition coalescing and skew-join splitting.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # Broadcast only what is small by construction; AQE may still convert a join when the
    # runtime size of one side is below this bound.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # source feeds include cp1251 CSVs: allow every Java charset in CSV/JSON readers and writers
    "spark.sql.legacy.javaCharsets": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "panelcast",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable defaults to an existing session (e.g. the driver's)."""
    for k, v in DEFAULT_CONF.items():
        if k in ("spark.ui.enabled",):
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a running session
            pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; only set a scratch one when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="panelcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return configured


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; any other problem (no access, no such store) is raised."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A location for intermediate tables under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def release_shuffles(spark: SparkSession) -> None:
    """Ask for the removal of shuffle files that no table refers to any more.

    Spark removes them when the driver's garbage collection finds their tables unreachable, which on a driver with free memory comes
    late: the files of one stage then lie beside those of the next.
    """
    gc.collect()  # the handles that Python holds
    spark.sparkContext._jvm.System.gc()


def materialize(df, name: str):
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint folder and reading it back.

    Columnar and compressed (much cheaper than an RDD checkpoint of rows), durable across executor loss,
    and each call writes a fresh folder, so concurrent or repeated runs never overwrite each other.
    """
    import uuid

    path = scratch_path(df.sparkSession, f"materialized/{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)

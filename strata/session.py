"""Session construction and cluster-safe scratch locations.

Every operator in the package takes DataFrames and returns DataFrames; the
session is only needed by sources and by the few operators that must cut
lineage.  Lineage is cut with ``DataFrame.checkpoint()`` into the shared
folder named by ``spark.checkpoint.dir`` (never ``localCheckpoint``): on a
cluster that folder is set by the platform, locally (tests) we set one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this package runs with (see SURVEY §4).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files of RDDs no longer referenced are deleted from the shared folder
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "strata", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster the platform's session is used as is."""
    master = master or os.environ.get("STRATA_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; only a local session gets a scratch one when it is unset."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_table_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written intermediate table under the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def scale_conf(shuffle_bytes: int, cores: int, partition_bytes: int = 200 << 20,
               split_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a run whose largest shuffle moves about ``shuffle_bytes`` on
    ``cores`` executor cores (all runtime SQL settings, applied with ``apply_conf``).

    Shuffle partitions start at about ``partition_bytes`` each (at least three tasks per
    core); AQE then coalesces
    small partitions towards the same advisory size and splits partitions of hot keys
    that exceed five times the median and the skew threshold.  Parquet scans are split
    at ``split_bytes``.  Example: a 100 TB scan whose widest shuffle moves 20 TB on 8,000
    cores gives 95,368 shuffle partitions of about 200 MB each.
    """
    n = max(3 * cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set runtime SQL settings on an existing (e.g. the platform's) session."""
    for k, v in conf.items():
        spark.conf.set(k, v)

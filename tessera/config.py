"""Session and mart configuration."""

from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass
from datetime import date

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class MartConfig:
    """Knobs of the mart build.

    ``max_date`` and ``reference_date`` default to values derived from the
    data (latest order date, and 31 Dec of its year + 16); they stay lazy one-row aggregates unless overridden here.
    ``as_of`` replaces GETDATE() in the "current period" flags; ``None`` means
    the reference date, so reruns are reproducible.
    """

    max_date: date | None = None
    reference_date: date | None = None
    as_of: date | None = None


# Settings for a large cluster (100 TB class inputs). Applied by
# ``get_session(cluster=True)`` only where the cluster config has not set them.
CLUSTER_DEFAULTS = {
    # AQE: start with many shuffle partitions and let AQE coalesce to ~256 MB
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    # skewed join partitions (a hot customer/order/store) are split at runtime
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    # size-checked broadcast: dimensions under this size become broadcast joins
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    # scan splits sized for executor memory
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.session.timeZone": "UTC",
}


def get_session(
    master: str | None = None,
    app_name: str = "tessera",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    cluster: bool = False,
) -> SparkSession:
    """Build (or reuse) a session with the settings the mart relies on.

    AQE is on so that joins against customer/product-sized dimensions are
    converted to broadcasts only when the runtime size is under the
    threshold, and skewed join partitions are split.

    ``cluster=True`` leaves master, memory and partition counts to the
    cluster (spark-submit / spark-defaults) and only fills the keys of
    ``CLUSTER_DEFAULTS`` that it did not set.
    """
    b = SparkSession.builder.appName(app_name).config("spark.ui.showConsoleProgress", "false")
    # checkpoint files go when nothing refers to them any more
    b = b.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if not cluster:
        b = (
            b.master(master or os.environ.get("TESSERA_MASTER", "local[*]"))
            .config("spark.ui.enabled", "false")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
            .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
            .config("spark.sql.parquet.filterPushdown", "true")
        )
    elif master:
        b = b.master(master)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    if cluster:
        conf = spark.sparkContext.getConf()
        for k, v in CLUSTER_DEFAULTS.items():
            if not conf.contains(k) and k not in (extra or {}):
                spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must name a shared (HDFS/object-store) folder; it
    is left untouched, and an error is raised where it is missing, since other
    machines cannot read a local folder. Only on a ``local`` master (tests,
    one machine) is a fresh scratch folder made.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        master = spark.sparkContext.master
        if not is_local(master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all machines share (master {master})")
        cur = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    spark.sparkContext.setCheckpointDir(cur)
    return cur


def is_local(master: str) -> bool:
    """Driver and executors are one process."""
    return master == "local" or master.startswith("local[")

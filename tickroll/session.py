"""Session settings the library relies on.

Everything time-related assumes the session time zone is UTC: epoch
milliseconds are the stored time unit and zone-less text is read as UTC.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# SQL settings applied to any session handed to the library.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Merges rewrite only the date partitions they touch.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "tickroll",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to an existing session (idempotent)."""
    for k, v in SQL_DEFAULTS.items():
        spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names shared storage that every
    executor and a restarted driver can reach; streaming checkpoints, staged
    batches and test tables live there. Where it is unset, a ``local`` master
    (one machine, as in tests) gets a folder of its own; any other raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:        # remote session: only the SQL conf is visible
        sc = None
    base = None
    if sc is not None:
        base = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
        base = base or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:
            base = None
    if not base:
        master = sc.master if sc is not None else "remote"
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tickroll-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(base)
            base = sc.getCheckpointDir() or base
    base = base.rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, safe from lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that must touch local paths."""
    return path[5:] if path.startswith("file:") else path

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Spark's name for the id that a stream keeps in its checkpoint, among a job's local properties.
QUERY_ID = "sql.streaming.queryId"


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with this package's settings; keyword arguments use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Window names and date directories are UTC text; refuse another zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, found {zone}")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named in ``spark.checkpoint.dir``.

    Where that is unset a temporary folder is used under a local master; on a
    cluster, where executors would not see it, that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", None) or "local"
        if master.startswith("local-cluster") or not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return tempfile.mkdtemp(prefix=f"windrow-{label}-")
    return f"{base.rstrip('/')}/windrow-{label}-{uuid.uuid4().hex}"

"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Run-time settings every job relies on. Joins carry no broadcast hints: Spark broadcasts a side only
# when its measured size is under the threshold, and otherwise shuffles and splits skewed partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.variant.allowDuplicateKeys": "true",
}


_LOCAL_ROOTS: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "threatloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; a cluster without the setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="threatloom-")
    return _LOCAL_ROOTS[context.applicationId]


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared root, unique to this call."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"

"""Session defaults (S17) and the shared workspace location.

The builder never hard-codes a master: on a cluster the launcher supplies it.
Staging data lives under the folder the cluster names in
``spark.checkpoint.dir``; a private folder is created only when that setting
is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app_name: str = "ratingsmith", master: str | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only if unset."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a shared folder for the cluster")
        path = tempfile.mkdtemp(prefix="ratingsmith-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def read_parquet_or_none(spark: SparkSession, path: str, schema=None):
    """The Parquet table at ``path``, or None when nothing was written there yet."""
    from pyspark.errors import AnalysisException
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        df = reader.parquet(path)
        if schema is not None:
            df.limit(0).collect()          # a schema-only read is lazy; touch the path
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def workspace(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for staged tables."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "ratingsmith", *parts)

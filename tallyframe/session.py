"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tallyframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator here assumes.

    AQE coalesces small shuffles and splits skewed join partitions; UTC keeps
    instants stable; dynamic overwrite makes zone writes replace only the
    partitions they touch.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Folder shared by all executors: ``spark.checkpoint.dir`` of the session.

    Only a session on one machine that names none gets a temporary folder, once per
    application; a cluster without the setting is refused, since its machines would
    each write to a disk of their own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = context.applicationId
        if app not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        root = _LOCAL_ROOTS[app]
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    spark = df.sparkSession
    root = checkpoint_root(spark)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return df.checkpoint(eager=True)

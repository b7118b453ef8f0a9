"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "convoloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, AQE and Arrow; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # Checkpoints go once nothing refers to them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session; sets one only where the cluster names none.

    The session's ``spark.checkpoint.dir`` always wins. Without it a local master gets a temporary folder;
    any other master is an error, since executors could not see a folder on the driver's disk.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if named:
        sc.setCheckpointDir(named)
    elif sc.master.startswith("local[") or sc.master == "local":
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="convoloom-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` through the shared checkpoint folder; survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

"""Session and scratch-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("panelwise")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def on_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it.

    A cluster without that path gets the package with ``--py-files`` as usual.
    """
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[1])
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a folder of its own.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="panelwise-")
        spark.sparkContext.setCheckpointDir(_local_root)
    return _local_root


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/panelwise/{label}-{uuid.uuid4().hex}"


def landed(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back.

    For results that several jobs go over: the plan behind them runs once, survives the loss of
    executors, and later plans know the true size.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)

"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "trendmark", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution on.

    Nothing in the library depends on settings made here: writes carry their own overwrite mode and
    shuffle sizes are left to adaptive execution, so a session the cluster already made serves as well.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # Both are needed in one-process runs: results above 1 MB are fetched over this address.
            builder = (
                builder.config("spark.driver.host", "127.0.0.1")
                .config("spark.driver.bindAddress", "127.0.0.1")
                .config("spark.ui.enabled", "false")
                .config("spark.driver.memory", "12g")
            )
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ready(spark: SparkSession) -> None:
    """Let Python workers that start from now on find this package where it is not installed."""
    root = str(Path(__file__).resolve().parents[1])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{known}:{root}".strip(":")


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    A machine-local folder is made only for one-process runs that name none.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    created = tempfile.mkdtemp(prefix="trendmark-")
    spark.conf.set(CHECKPOINT_DIR, created)
    return created


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/trendmark-{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the checkpoint folder and read it from there ever after.

    Used where two branches of a plan must see the very same rows, also after an executor is lost.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)

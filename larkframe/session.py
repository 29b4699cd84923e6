"""Session helpers: a local builder for tests, and the shared folder for cut lineage and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "larkframe") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session without that setting gets its own."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        path = tempfile.mkdtemp(prefix="larkframe-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, for a written table."""
    return f"{shared_folder(spark).rstrip('/')}/larkframe/{name}-{uuid.uuid4().hex}"


def materialized(df: DataFrame) -> DataFrame:
    """The rows written once to the checkpoint folder, for inputs that several passes read."""
    shared_folder(df.sparkSession)
    return df.checkpoint()

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(app: str = "voxloom", cores: str = "*", shuffle_partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench. Clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the other
    executors could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="voxloom-")
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def checkpointed(df):
    """Cut lineage through a reliable checkpoint in the shared folder."""
    scratch_path(df.sparkSession, "probe")
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(
            df.sparkSession.conf.get("spark.checkpoint.dir"))
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="voxloom-py-"), "voxloom"), "zip",
        root_dir=package.parent, base_dir=package.name)
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)

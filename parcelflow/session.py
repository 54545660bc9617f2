"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "parcelflow") -> SparkSession:
    """A local session for tests and benchmarks; a cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Small tables in as many splits as there are cores, without a shuffle.
        .config("spark.sql.files.openCostInBytes", str(64 << 10))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # halves the time to build a plan
        .getOrCreate()
    )


_shipped: set[str] = set()


def ship(spark: SparkSession | None = None) -> None:
    """Send this package to the executors of the running session, once per application, as ``--py-files`` would.

    A local session has it already.
    """
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    context = spark.sparkContext
    if context.master.startswith("local") or context.applicationId in _shipped:
        return
    root, name = os.path.split(os.path.dirname(os.path.abspath(__file__)))
    into = os.path.join(tempfile.mkdtemp(prefix="package-"), name)
    context.addPyFile(shutil.make_archive(into, "zip", root, name))
    _shipped.add(context.applicationId)


def workdir(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names storage that every executor sees. Only a local
    session may do without it, and then uses a temporary folder of its own machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/parcelflow/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder; what follows reads it from there and agrees on it."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(workdir(df.sparkSession, "checkpoint"))
    return df.checkpoint(eager=True)

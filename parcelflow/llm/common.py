"""What the operators share: white space, tables, and cutting lineage in the shared folder."""

from __future__ import annotations

import contextlib
import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelflow.session import stored, workdir  # noqa: F401

#: The six characters that part words.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, as ``--py-files`` would.

    Rows of whole texts go to Python in batches of 1,000 where the session does not say otherwise: Spark's default of
    10,000 would hold some ten times the memory in the JVM and in the worker, for no gain.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        root, name = os.path.split(package)
        into = os.path.join(tempfile.mkdtemp(prefix="package-"), name)
        context.addPyFile(shutil.make_archive(into, "zip", root, name))
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What tasks of this worker keep for the next task of the same kind: kind -> how to drop it.
_kept: dict[str, Callable[[], None]] = {}


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], kind: str = "", drop: Callable[[], None] | None = None) -> Callable:
    """A task's function that gives memory back: what tasks of another kind have kept before it begins, and its own
    buffers when it ends. Workers are shared by all stages and wait for their next task beside others' work."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for other in [k for k in _kept if k != kind]:
            _kept.pop(other)()
        if drop is not None:
            _kept[kind] = drop
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
            ctypes.CDLL(None).malloc_trim(0)

    return whole


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def write_and_read(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder."""
    path = workdir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)

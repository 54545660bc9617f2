"""Sinks. A path that a plan reads is never written by it: tables are published as versions."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelflow.functions.text import file_slug
from parcelflow.operators.dedup import fresh_rows, union_by_name_distinct
from parcelflow.operators.documents import nest

VERSION = "version="
CLAIMS = "_claims"
RECORD_SEPARATOR = "\u001e\n"


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, none where there is no such folder (a listing, no data)."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def _versions(spark: SparkSession, base: str) -> list[int]:
    """Committed versions under ``base``, oldest first (a listing of folder names, no data)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        done = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith(VERSION) and fs.exists(done):
            found.append(int(name[len(VERSION):]))
    return sorted(found)


def _created(spark: SparkSession, path: str) -> bool:
    """Whether this call, and no other, has created an empty file. HDFS and local file systems decide that; an object store may not."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(place.getParent())
    if fs.getScheme() == "file":  # where Hadoop looks first and creates later
        return jvm.java.io.File(place.toUri().getPath()).createNewFile()
    try:
        return fs.createNewFile(place)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False


def _claimed(spark: SparkSession, base: str) -> str:
    """The folder of a version that no other writer has or gets. A claim whose writer failed leaves a gap in the numbers, which readers do not see."""
    taken = [name[len(VERSION):] for place in (base, f"{base}/{CLAIMS}") for name in names_in(spark, place) if name.startswith(VERSION)]
    number = max([int(n) for n in taken if n.isdigit()], default=0) + 1
    while not _created(spark, f"{base}/{CLAIMS}/{VERSION}{number}"):
        number += 1
    return f"{base}/{VERSION}{number}"


def publish(df: DataFrame, base: str, fmt: str = "parquet", **options: str) -> str:
    """Write ``df`` as the next version of the table ``base``; readers see it once it is complete.

    ``df`` may be derived from the current version, which stays as it is. Writers at the same time get numbers of their own, so none
    overwrites another's; the version with the larger number is the current one. Returns the folder of the version.
    """
    target = _claimed(df.sparkSession, base)
    df.write.mode("errorifexists").format(fmt).options(**options).save(target)
    return target


def current(spark: SparkSession, base: str) -> DataFrame:
    """The newest complete version of a published table."""
    versions = _versions(spark, base)
    if not versions:
        raise FileNotFoundError(f"no version of {base} has been published")
    return spark.read.parquet(f"{base}/{VERSION}{versions[-1]}")


def archive_old(spark: SparkSession, base: str, archive: str, keep: int = 3) -> list[str]:
    """Move all versions but the newest ``keep`` to the folder ``archive``; returns where they are now. Nothing is deleted."""
    return [move(spark, f"{base}/{VERSION}{v}", archive) for v in _versions(spark, base)[:-keep]]


def move(spark: SparkSession, path: str, folder: str) -> str:
    """Move a folder into another one, under its name."""
    jvm = spark._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(folder)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    goal = jvm.org.apache.hadoop.fs.Path(target, source.getName())
    if not fs.rename(source, goal):
        raise OSError(f"{path} could not be moved to {folder}")
    return goal.toString()


def consume_files(
    spark: SparkSession, folder: str, archive: str, read: Callable[[list[str]], DataFrame], merge: Callable[[DataFrame], object], suffix: str = ".csv"
) -> list[str]:
    """Read the files of ``folder``, merge their rows, then move the files that had rows to ``archive``; returns where these are now.

    Files move only after ``merge`` has returned: when it fails all stay and the error goes on. A file without a row stays, as
    does one that arrives meanwhile. Nothing is deleted.
    """
    paths = {name: f"{folder}/{name}" for name in names_in(spark, folder) if name.endswith(suffix)}
    if not paths:
        return []
    rows = read(list(paths.values()))
    # One name per file; a name as it stands in a URI.
    full = {unquote(r[0]) for r in rows.select(F.col("_metadata.file_name")).distinct().collect()}
    merge(rows)
    return [move(spark, path, archive) for name, path in paths.items() if name in full]


def retained(spark: SparkSession, base: str, keep: int = 3) -> list[str]:
    """The newest ``keep`` versions, newest first; anything older may be archived."""
    return [f"{base}/{VERSION}{v}" for v in reversed(_versions(spark, base)[-keep:])]


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    df.write.mode("append").partitionBy(*(partition_by or [])).parquet(path)


def append_fresh(batch: DataFrame, path: str, keys: list[str], order: list[str]) -> None:
    """Append only rows whose key is neither stored nor earlier in the batch; the first call starts the table."""
    spark = batch.sparkSession
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], batch.schema)
    append(fresh_rows(batch, stored, keys, order), path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV files in a new folder, or appended. A table that is replaced is published instead: ``publish(df, base, "csv", header="true")``."""
    df.write.mode(mode).options(header=True, escape='"').csv(path)


def export_urls(df: DataFrame, path: str, url: str = "url") -> None:
    """All distinct URLs as CSV with the header 'URL'."""
    write_csv(df.select(F.col(url).alias("URL")).distinct(), path)


def save_contact_rollup(new: DataFrame, base: str) -> str:
    """Old and new roll-up rows without whole-row duplicates, as the next version of ``base``."""
    spark = new.sparkSession
    if not _versions(spark, base):
        return publish(new.distinct(), base)
    return publish(union_by_name_distinct(current(spark, base), new), base)


def document_lines(df: DataFrame, agent: str, order: list[Column], columns: list[str], capped: bool = False) -> DataFrame:
    """One JSON object {agent: {'Address i': record}} per agent and 1,000 records, in column ``value``; ``capped`` as in ``nest``."""
    docs = nest(df, agent, order, columns, *([None] if capped else []))
    return docs.select(F.to_json(F.create_map(F.col(agent).cast("string"), F.col("listings"))).alias("value"))


def save_documents_json(df: DataFrame, base: str, agent: str, order: list[Column], columns: list[str]) -> str:
    """All rows of ``df`` as documents, as the next version of ``base``; returns its folder."""
    return publish(document_lines(df, agent, order, columns), base, "text")


def kv_record(columns: list[str]) -> Column:
    """A row as 'key: value' lines; a null value leaves its line out."""
    return F.concat_ws("\n", *[F.concat(F.lit(f"{c}: "), F.col(c).cast("string")) for c in columns])


def save_kv_records(df: DataFrame, base: str, columns: list[str], slug_of: str | None = None) -> str:
    """Key-value records in large files, parted by a separator; one file per record does not scale.

    They are the next version of ``base``; returns its folder. With ``slug_of`` each record starts with the file slug of that column.
    """
    body = kv_record(columns)
    if slug_of is not None:
        body = F.concat_ws("\n", F.concat(F.lit("slug: "), file_slug(slug_of)), body)
    return publish(df.select(body.alias("value")), base, "text", lineSep=RECORD_SEPARATOR)

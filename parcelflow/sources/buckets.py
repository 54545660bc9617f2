"""Tables in hash buckets of their key, of which a merge reads and rewrites only the touched ones.

Layout: ``<path>/of=<buckets>/bucket=<n>/*.parquet``. The bucket is a partition column, so the buckets that a batch touches are all that is read
of the stored rows (partition pruning), and dynamic partition overwrite replaces these folders alone. The merged rows are written to
the checkpoint folder first: no plan overwrites what it reads, and a merge that breaks off can be run again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelflow.session import stored
from parcelflow.sources.writers import names_in

OF, BUCKET = "of", "bucket"


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The bucket of a row; keys of equal values must be of equal types."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _placed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumns({OF: F.lit(buckets), BUCKET: bucket_of(keys, buckets)})


def _write(placed: DataFrame, path: str) -> None:
    """Few files to a bucket; adaptive execution splits a large one."""
    rebalanced = placed.hint("rebalance", BUCKET)
    rebalanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(OF, BUCKET).parquet(path)


def create(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """A new table of ``buckets`` buckets; one that is there already is an error."""
    if names_in(df.sparkSession, path):
        raise FileExistsError(f"{path} holds a table already")
    _write(_placed(df, keys, buckets), path)


def _buckets(spark: SparkSession, path: str) -> int:
    found = [n for n in names_in(spark, path) if n.startswith(f"{OF}=")]
    if len(found) != 1:
        raise FileNotFoundError(f"{path} holds no table in buckets")
    return int(found[0].removeprefix(f"{OF}="))


def read(spark: SparkSession, path: str, touched: list[int] | None = None) -> DataFrame:
    """The rows of the table, or of some of its buckets."""
    table = spark.read.parquet(path)
    if touched is not None:
        table = table.filter(F.col(BUCKET).isin(touched))
    return table.drop(OF, BUCKET)


def merge_into(path: str, batch: DataFrame, keys: list[str], merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
    """Replace the buckets that ``batch`` touches by ``merge(stored rows of these buckets, batch)``; returns their numbers.

    ``merge`` works key by key and keeps every stored key, as the upserts of ``operators`` do: so a merge of the touched buckets is the merge of the
    whole table. Keys of the batch take the stored types before they are hashed. An empty batch changes nothing.
    """
    spark = batch.sparkSession
    buckets = _buckets(spark, path)
    types = {f.name: f.dataType for f in read(spark, path, []).schema.fields}
    batch = stored(batch.withColumns({k: F.col(k).cast(types[k]) for k in keys}))
    touched = sorted(r[0] for r in batch.select(bucket_of(keys, buckets)).distinct().collect())  # at most one row per bucket
    if touched:
        merged = merge(read(spark, path, touched), batch).select(*types)
        _write(stored(_placed(merged, keys, buckets)), path)
    return touched

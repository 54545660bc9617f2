"""File intake as a stream: dedup, running counts and keyed upserts.

Each query keeps its progress in a checkpoint folder, so a restart goes on where the last
run stopped. Batch outputs are folders named by query and batch and written with overwrite, so a
repeated batch replaces itself and changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from parcelflow.operators.dedup import last_wins
from parcelflow.sources.writers import move, names_in

GENERATION = "generation="
#: Partition columns of deltas, the earliest first.
DELTA_ORDER = ["generation", "batch", "query"]


def watch_folder(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """New files of a folder as a stream. With ``archive``, read files move there; none is deleted."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def drain(writer: DataStreamWriter, checkpoint: str) -> None:
    """Work through everything that is there, then stop."""
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def poll(writer: DataStreamWriter, checkpoint: str, seconds: int = 300):
    """Keep running and look for new files every ``seconds``."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()


def append_files(stream: DataFrame, out: str) -> DataStreamWriter:
    """Exactly-once append to Parquet files."""
    return stream.writeStream.format("parquet").outputMode("append").option("path", out)


def drop_seen(
    stream: DataFrame, keys: list[str], ts: str | None = None, within: str | None = None, salts: int = 16
) -> DataFrame:
    """Rows whose key has not been seen before.

    With ``ts`` and ``within`` the state forgets keys older than the watermark and stays bounded.

    A streaming dedup does not combine before its shuffle. So it runs twice: first per key and
    salt, which parts the rows of a hot key over ``salts`` tasks, then per key on the few rows
    that are left. The salt is the number of the reading task, so equal copies part as well;
    whichever row comes through, the second step lets one pass. ``salts=1`` leaves out the first.
    """
    columns = stream.columns
    if ts is not None:
        # A watermark wants an instant, not a local time.
        stream = stream.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", within)

    def once(rows: DataFrame, by: list[str]) -> DataFrame:
        return rows.dropDuplicates(by) if ts is None else rows.dropDuplicatesWithinWatermark(by)

    if salts > 1:
        stream = once(stream.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts))), [*keys, "_salt"])
    return once(stream, keys).select(*columns)


def _store_delta(out: str, rows: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A batch as a folder of its own. The folder's name holds the id of the query, which lives in its checkpoint: a
    batch that is repeated replaces itself, and a query that has lost its checkpoint never writes over older batches.
    A query that begins is a generation later than those that have written before it."""

    def store(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        place = f"{out}/{_generation(batch.sparkSession, out, query)}/query={query}/batch={batch_id}"
        rows(batch).write.mode("overwrite").parquet(place)

    return store


def _generation(spark: SparkSession, out: str, query: str) -> str:
    """The folder of a query's generation: the one it has written to before, else the next. It orders queries without a clock."""
    known = [g for g in names_in(spark, out) if g.startswith(GENERATION)]
    own = [g for g in known if f"query={query}" in names_in(spark, f"{out}/{g}")]
    return own[0] if own else f"{GENERATION}{max([int(g[len(GENERATION):]) for g in known], default=0) + 1}"


def running_counts(stream: DataFrame, key: str, out: str) -> DataStreamWriter:
    """Counts per key; each batch stores only the keys whose count has changed. Read with ``latest_counts``."""
    counts = stream.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.writeStream.outputMode("update").foreachBatch(_store_delta(out, lambda batch: batch))


def latest_counts(spark: SparkSession, out: str, key: str) -> DataFrame:
    return latest_rows(spark, out, [key], [])


def upsert_deltas(stream: DataFrame, keys: list[str], order: list[str], out: str) -> DataStreamWriter:
    """The last row per key of each batch, appended as one small folder per batch.

    The table is the last row per key over all folders (``latest_rows``). No batch rewrites
    older data; ``compact`` folds the folders now and then.
    """
    return stream.writeStream.outputMode("update").foreachBatch(_store_delta(out, lambda batch: last_wins(batch, keys, order)))


def latest_rows(spark: SparkSession, out: str, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key over all deltas; between equal orders the later generation wins, then the later batch."""
    table = spark.read.parquet(out)
    return last_wins(table, keys, [*order, *DELTA_ORDER]).drop(*DELTA_ORDER)


def compact(spark: SparkSession, out: str, archive: str, keys: list[str], order: list[str]) -> None:
    """Fold all deltas into one folder of the table and move those that it holds to ``archive``.

    Readers and the stream go on as before: until the old folders are gone a key has the same row twice.
    """
    table = spark.read.parquet(out)
    places = table.select(*DELTA_ORDER).distinct().collect()
    folded = [f"{GENERATION}{r['generation']}/query={r['query']}/batch={r['batch']}" for r in places]
    last = last_wins(table, keys, [*order, *DELTA_ORDER]).drop(*DELTA_ORDER)
    # In the last generation, before its next batch.
    last.write.parquet(f"{out}/{GENERATION}{max(r['generation'] for r in places)}/query=folded-{uuid.uuid4().hex}/batch=-1")
    for name in folded:
        move(spark, f"{out}/{name}", f"{archive}/{name.rpartition('/')[0]}")

"""Streaming intake, worked off to the end; each result equals its batch twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelflow.functions.logs import parse_log_line
from parcelflow.plans.registry import query, table
from parcelflow.schemas import EVENTS
from parcelflow.session import workdir
from parcelflow.streaming import intake


def arrivals(spark, sf_dir, files_per_batch=None):
    """The events table as a stream of files, be it one file or a folder of them."""
    return intake.watch_folder(spark, f"{sf_dir}/events*.parquet", EVENTS, files_per_batch=files_per_batch)


@query("stream_intake_count", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_intake_count(spark, sf_dir):
    base = workdir(spark, "stream_intake")
    intake.drain(intake.append_files(arrivals(spark, sf_dir), f"{base}/out"), f"{base}/checkpoint")
    return spark.read.schema(EVENTS).parquet(f"{base}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    base = workdir(spark, "stream_dedup")
    fresh = intake.drop_seen(arrivals(spark, sf_dir).select("user_id", "event_type"), ["user_id", "event_type"])
    intake.drain(intake.append_files(fresh, f"{base}/out"), f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")


@query("stream_upsert_latest", """
    SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type,
           arg_max(value, (ts, event_id)) AS value
    FROM events GROUP BY user_id
""")
def stream_upsert_latest(spark, sf_dir):
    """The latest event per user, from files that arrive in several batches."""
    base = workdir(spark, "stream_upsert")
    staged = f"{base}/arrivals"
    table(spark, sf_dir, "events").repartitionByRange(4, "event_id").write.parquet(staged)
    stream = intake.watch_folder(spark, staged, EVENTS, files_per_batch=2)
    order = ["ts", "event_id"]
    columns = stream.select("user_id", "ts", "event_id", "event_type", "value")
    intake.drain(intake.upsert_deltas(columns, ["user_id"], order, f"{base}/out"), f"{base}/checkpoint")
    return intake.latest_rows(spark, f"{base}/out", ["user_id"], order).drop("ts")


@query("stream_state_counts", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def stream_state_counts(spark, sf_dir):
    base = workdir(spark, "stream_counts")
    intake.drain(intake.running_counts(arrivals(spark, sf_dir), "user_id", f"{base}/out"), f"{base}/checkpoint")
    return intake.latest_counts(spark, f"{base}/out", "user_id")


@query("stream_dedup_within", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup_within(spark, sf_dir):
    """Copies within a time: the state forgets what is older than the watermark. Here the time spans the table."""
    base = workdir(spark, "stream_dedup_within")
    fresh = intake.drop_seen(arrivals(spark, sf_dir), ["user_id", "event_type"], "ts", "3000 days")
    intake.drain(intake.append_files(fresh.select("user_id", "event_type"), f"{base}/out"), f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")


@query("stream_log_dedup", """
    SELECT DISTINCT upper(event_type) AS level, 'user ' || (user_id % 40) || ' at step ' || (event_id % 3) AS message FROM events
""")
def stream_log_dedup(spark, sf_dir):
    """Log files as a stream: a line whose level and message came before is dropped."""
    base = workdir(spark, "stream_log_dedup")
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" - "), F.upper("event_type"), F.lit(" - user "),
        (F.col("user_id") % 40).cast("string"), F.lit(" at step "), (F.col("event_id") % 3).cast("string"),
    )
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(f"{base}/logs")
    lines = spark.readStream.schema("value string").format("text").load(f"{base}/logs")
    parsed = lines.select(parse_log_line("value").alias("l")).filter("l IS NOT NULL").select("l.*")
    fresh = intake.drop_seen(parsed, ["level", "message"], "ts", "3000 days")
    intake.drain(intake.append_files(fresh.select("level", "message"), f"{base}/out"), f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")


@query("stream_resume", "SELECT event_id, user_id FROM events")
def stream_resume(spark, sf_dir):
    """Two runs on one checkpoint: the second takes up only what has arrived since the first."""
    base = workdir(spark, "stream_resume")
    events = table(spark, sf_dir, "events")
    for part in (events.filter("value < 10"), events.filter("value >= 10 OR value IS NULL")):
        part.write.mode("append").parquet(f"{base}/arrivals")
        stream = intake.watch_folder(spark, f"{base}/arrivals", EVENTS).select("event_id", "user_id")
        intake.drain(intake.append_files(stream, f"{base}/out"), f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")

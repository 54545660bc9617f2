"""Event time in streams: sessions between pauses, and runs of failures with retries, both in bounded state."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: ``transformWithState`` wants this store; set it on the session before the query starts.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def sessions(events: DataFrame, key: str, ts: str, gap: str, late: str | None = None) -> DataFrame:
    """Per key and session: when it began and ended, its rows, and the seconds between its first and last.

    A session ends with the last row that no other follows within ``gap``. On a stream ``late`` is how long rows may be behind the newest one:
    a session comes out once, when the watermark has passed its end, and is then forgotten; rows that come later still are dropped
    and counted in the query's progress (``dropped_rows``). On a table without ``late`` all sessions come out.
    """
    rows = events.select(key, F.col(ts).cast("timestamp").alias("_at"))
    if late is not None:
        rows = rows.withWatermark("_at", late)
    found = rows.groupBy(key, F.session_window("_at", gap).alias("_w")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("_at").alias("began"), F.max("_at").alias("ended")
    )
    elapsed = (F.unix_micros("ended") - F.unix_micros("began")) / 1e6
    return found.select(key, "began", "ended", "rows", elapsed.alias("seconds"))


def dropped_rows(query) -> int:
    """How many late rows the operators of a query have dropped so far."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])


class _Runs(StatefulProcessor):
    """Failures of one key: all, runs, the longest run, the present run. Forgotten when no row comes for ``expiry``."""

    def __init__(self, max_attempts: int, backoff: float, expiry: float):
        self.max_attempts, self.backoff, self.expiry = max_attempts, int(backoff * 1e6), int(expiry * 1e6)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("runs", "failures bigint, streaks bigint, longest bigint, run bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        failures, streaks, longest, run = self.state.get() if self.state.exists() else (0, 0, 0, 0)
        at = 0
        for row in sorted(rows, key=lambda r: (r["_us"], r["_order"])):  # one key's rows of one batch
            at = row["_us"]
            if row["_failed"]:
                failures, streaks, run = failures + 1, streaks + (run == 0), run + 1
                longest = max(longest, run)
            else:
                run = 0
        self.state.update((failures, streaks, longest, run))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((at + self.expiry) // 1000)
        retry = at + self.backoff * 2 ** (run - 1) if 0 < run < self.max_attempts else None
        yield Row(_key=key[0], failures=failures, streaks=streaks, longest=longest, run=run, given_up=run >= self.max_attempts, _retry=retry)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


RUNS_SCHEMA = "failures bigint, streaks bigint, longest bigint, run bigint, given_up boolean, _retry bigint"


def failure_runs(
    stream: DataFrame, key: str, ts: str, order: str, failed, late: str = "1 hour", max_attempts: int = 3, backoff: float = 2.0, expiry: float = 30 * 86_400
) -> DataFrame:
    """Per key whose rows a batch holds: failures, runs of failures, the longest and the present run, whether attempts are used up, and when to retry.

    A success ends a run. The retry after the n-th failure in a row waits ``backoff`` * 2**(n - 1) seconds; after ``max_attempts`` none is due. State is
    one row per key; a key without a row for ``expiry`` seconds of event time is forgotten and begins anew. Rows of a key are put in order
    (``ts``, ``order``, a whole number) within a batch, so batches should arrive about in time. Store the updates with ``intake.upsert_deltas``.
    """
    rows = stream.select(
        F.col(key), F.col(ts).cast("timestamp").alias("_at"), F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"), F.col(order).cast("bigint").alias("_order"), F.coalesce(failed, F.lit(False)).alias("_failed")
    ).withWatermark("_at", late)
    kind = rows.schema[key].dataType.simpleString()
    found = rows.groupBy(key).transformWithState(_Runs(max_attempts, backoff, expiry), f"_key {kind}, {RUNS_SCHEMA}", "Update", "EventTime")
    return found.select(F.col("_key").alias(key), "failures", "streaks", "longest", "run", "given_up", F.timestamp_micros("_retry").alias("retry_at"))

"""Ordered running totals that survive a hot key.

A window over ``partitionBy(key)`` sorts all rows of a key in one task. Where a key has more rows than
``MAX_TASK_ROWS``, and for an order over the whole table, the rows are first dealt by ranges of
(key, order): Spark samples values of the order itself, so ranges are about equal in size for every type
and cut a hot key where its rows lie. The ranges are written to the shared folder, each is totalled on its own, and the
totals before a range are added.

Both plans give the same result; the count of rows per key only chooses between them. The table of
totals that is broadcast has at most two rows per range.

What the driver receives grows with the number of ranges: some hundred sampled rows, a task's result and two totals for each.
So there are at most ``MAX_RANGES``, and beyond that they get longer; a range is sorted and totalled from disk where it does not fit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelflow.session import stored

MAX_TASK_ROWS = 10_000_000
MAX_RANGES = 1_000


def _in_ranges(work: DataFrame, keys: list[str], order: list[str], rows: int, max_task_rows: int) -> DataFrame:
    """The rows dealt by ranges of (key, order) of about ``max_task_rows``, stored, with the number of their range."""
    ranges = min(MAX_RANGES, max(1, -(-rows // max_task_rows)))
    return stored(work.repartitionByRange(ranges, *keys, *order).withColumn("__range", F.spark_partition_id()))


def _totals_before(ranged: DataFrame, keys: list[str]) -> DataFrame:
    """For each key that lies in several ranges: what the ranges before each one add up to."""
    per_range = ranged.groupBy(*keys, "__range").agg(F.sum("__v").alias("__s"))
    by_key = Window.partitionBy(*keys)
    before = by_key.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return (
        per_range.withColumn("__ranges", F.count(F.lit(1)).over(by_key)).withColumn("__before", F.sum("__s").over(before))
        .filter("__ranges > 1").select(*[F.col(f"`{k}`").alias(f"__o_{k}") for k in keys], F.col("__range").alias("__o_range"), "__before")
    )


def running_total(
    df: DataFrame, keys: list[str], order: list[str], out: str, value: Column | None = None, max_task_rows: int = MAX_TASK_ROWS
) -> DataFrame:
    """``df`` plus ``out``: the sum of ``value`` up to and with this row, per key in ``order``.

    ``value`` is a whole number and defaults to 1, which makes ``out`` a row number. ``order`` is ascending, nulls
    first, and should be total; rows that tie on all of it and on the key stay in one range. Without
    ``keys`` there is one order over the whole table. Columns named ``__v``, ``__range`` and ``__before`` are
    taken for the work.
    """
    work = df.withColumn("__v", (F.lit(1) if value is None else value).cast("bigint"))
    if keys:
        most, rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    else:
        rows = most = df.count()
    if keys and (most or 0) <= max_task_rows:
        whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return work.withColumn(out, F.sum("__v").over(whole)).select(*df.columns, out)
    ranged = _in_ranges(work, keys, order, rows or 0, max_task_rows)
    totals = _totals_before(ranged, keys)
    same = reduce(
        lambda a, b: a & b, [ranged[k].eqNullSafe(totals[f"__o_{k}"]) for k in keys], ranged["__range"] == totals["__o_range"]
    )
    inside = Window.partitionBy(*keys, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(F.broadcast(totals), same, "left")  # at most two rows per range, and MAX_RANGES ranges
        .withColumn(out, F.sum("__v").over(inside) + F.coalesce(F.col("__before"), F.lit(0)))
        .select(*df.columns, out)
    )


def row_number(df: DataFrame, keys: list[str], order: list[str], out: str = "rn", **limits: int) -> DataFrame:
    """``row_number()`` per key, from 1, that no single key can overload."""
    return running_total(df, keys, order, out, **limits)


def last_known(
    df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, max_task_rows: int = MAX_TASK_ROWS
) -> DataFrame:
    """``df`` plus ``out``: the last ``value`` that is not null up to and with this row, per key in ``order``.

    Hot keys are cut into ranges as in ``running_total``; what is sent on from range to range is one value. ``order`` is ascending, nulls
    first, and should be total. Columns named ``__v``, ``__range`` and ``__before`` are taken for the work.
    """
    work = df.withColumn("__v", value)
    most, rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    if (most or 0) <= max_task_rows:
        whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return work.withColumn(out, F.last("__v", ignorenulls=True).over(whole)).select(*df.columns, out)
    ranged = _in_ranges(work, keys, order, rows, max_task_rows)
    has = F.when(F.col("__v").isNotNull(), F.struct(*order))
    per_range = ranged.groupBy(*keys, "__range").agg(F.max_by("__v", has).alias("__s"))
    by_key = Window.partitionBy(*keys)
    before = by_key.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sent = (
        per_range.withColumn("__ranges", F.count(F.lit(1)).over(by_key)).withColumn("__before", F.last("__s", ignorenulls=True).over(before))
        .filter("__ranges > 1").select(*[F.col(f"`{k}`").alias(f"__o_{k}") for k in keys], F.col("__range").alias("__o_range"), "__before")
    )
    same = reduce(lambda a, b: a & b, [ranged[k].eqNullSafe(sent[f"__o_{k}"]) for k in keys], ranged["__range"] == sent["__o_range"])
    inside = Window.partitionBy(*keys, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(F.broadcast(sent), same, "left")  # at most two rows per range
        .withColumn(out, F.coalesce(F.last("__v", ignorenulls=True).over(inside), F.col("__before")))
        .select(*df.columns, out)
    )

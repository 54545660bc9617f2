"""Agent documents: fill-null merge, cap, labels and nesting.

The system of record is flat, one row per (agent, address). Maps are built for output only, of at most
``PART_ROWS`` entries; nesting drops nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from parcelflow.operators.dedup import top_per_group
from parcelflow.operators.skew import row_number

MAX_PER_AGENT = 15
PART_ROWS = 1000


def fill_null_upsert(
    stored: DataFrame, batch: DataFrame, keys: list[str], columns: list[str], ts: str, seq: str, as_of: Column
) -> DataFrame:
    """Merge a batch into the stored rows, one row per key, with an ``action`` column.

    A stored value that is not null stays; a null one takes the first value that the batch
    has for it, in ``seq`` order (whole numbers from 0). A new key is inserted with ``as_of``
    as its ``ts``; a filled row keeps its own. Rows with a null key are dropped.

    One union and one aggregation: unlike a full join it combines on the map side, so a key
    that the batch repeats very often costs no more than any other.
    """
    order = F.col("_ord")
    both = stored.select(*keys, *columns, ts, F.lit(-1).cast("bigint").alias("_ord")).unionByName(
        batch.select(*keys, *columns, as_of.alias(ts), F.col(seq).cast("bigint").alias("_ord"))
    )
    both = both.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    is_old = order < 0
    aggs = [F.max(is_old).alias("_known"), F.max(F.when(is_old, F.col(ts))).alias("_old_ts"), F.min(ts).alias("_ts")]
    for c in columns:
        has = F.col(c).isNotNull()
        aggs += [
            F.min_by(F.col(c), F.when(has, order)).alias(c),
            F.min(F.when(has, order)).alias(f"_from_{c}"),
        ]
    filled = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"_from_{c}") >= 0, F.lit(False)) for c in columns])
    action = F.when(~F.col("_known"), "inserted").when(filled, "filled").otherwise("unchanged")
    merged_ts = F.when(F.col("_known"), F.col("_old_ts")).otherwise(F.col("_ts"))
    return both.groupBy(*keys).agg(*aggs).select(*keys, *columns, merged_ts.alias(ts), action.alias("action"))


def cap_latest(df: DataFrame, agent: str, order: list[Column], n: int = MAX_PER_AGENT) -> DataFrame:
    """The newest ``n`` rows per agent; the order must be total."""
    return top_per_group(df, [agent], order, n)


def label_capped(df: DataFrame, agent: str, order: list[Column], out: str = "label") -> DataFrame:
    """'Address 1', 'Address 2', … for groups that a cap has bounded."""
    w = Window.partitionBy(agent).orderBy(*order)
    return df.withColumn(out, F.concat(F.lit("Address "), F.row_number().over(w).cast("string")))


def ordinal_labels(df: DataFrame, agent: str, order: list[str], out: str = "label") -> DataFrame:
    """The same labels for groups of any size."""
    ranked = row_number(df, [agent], order, "_rn")
    return ranked.withColumn(out, F.concat(F.lit("Address "), F.col("_rn").cast("string"))).drop("_rn")


def number_on(
    marks: DataFrame, batch: DataFrame, agent: str, order: list[str], out: str = "n", **limits: int
) -> tuple[DataFrame, DataFrame]:
    """The rows of a batch numbered on from each agent's mark, and the marks after it.

    ``marks`` has (agent, mark): the largest number that the agent has given out. A number is never given twice and never changes, whatever becomes of its
    row; an agent without a mark begins at 1. Null agents are one group. No older row is read.
    """
    ranked = row_number(batch, [agent], order, "_rn", **limits)
    side = marks.select(F.col(agent).alias("_agent"), F.col("mark").alias("_mark"))
    numbered = ranked.join(side, F.col(agent).eqNullSafe(F.col("_agent")), "left").select(
        *[F.col(f"`{c}`") for c in batch.columns], (F.coalesce("_mark", F.lit(0)) + F.col("_rn")).cast("bigint").alias(out)
    )
    now = batch.groupBy(agent).agg(F.count(F.lit(1)).alias("mark"))
    return numbered, marks.select(agent, "mark").unionByName(now).groupBy(agent).agg(F.sum("mark").alias("mark"))


def collect_per_group(
    df: DataFrame, group: str, order: list[str], record: Column, part_rows: int = PART_ROWS
) -> DataFrame:
    """Records per group as ordered arrays of at most ``part_rows``.

    A group that is larger goes on in part 1, 2, …, so no row of the result, and no task,
    holds an unbounded group. Null groups are dropped.
    """
    ranked = row_number(df.filter(F.col(group).isNotNull()), [group], order, "_rn")
    placed = ranked.select(group, F.col("_rn"), F.floor((F.col("_rn") - 1) / part_rows).cast("bigint").alias("part"),
                           record.alias("_rec"))
    return placed.groupBy(group, "part").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rn", "_rec"))), lambda x: x["_rec"]).alias("records")
    )


def nest(
    df: DataFrame, agent: str, order: list[Column | str], columns: list[str], part_rows: int | None = PART_ROWS
) -> DataFrame:
    """Rows per agent with a map 'Address i' -> record, ``part_rows`` entries at most, and the part's number.

    An agent with more rows goes on in part 1, 2, …, with labels that go on too, so neither a row nor a task holds an unbounded
    group and no row is dropped. ``part_rows=None`` is for rows that ``cap_latest`` has bounded: one map per agent, with no count before.
    """
    rows = df.filter(F.col(agent).isNotNull())
    if part_rows is None:
        ranked = rows.withColumn("_i", F.row_number().over(Window.partitionBy(agent).orderBy(*order))).withColumn("part", F.lit(0).cast("bigint"))
    else:
        ranked = row_number(rows, [agent], order, "_i").withColumn("part", F.floor((F.col("_i") - 1) / part_rows).cast("bigint"))
    entry = F.struct(
        F.col("_i"),
        F.concat(F.lit("Address "), F.col("_i").cast("string")).alias("k"),
        F.struct(*columns).alias("v"),
    )
    listed = F.array_sort(F.collect_list(entry))
    return ranked.groupBy(agent, "part").agg(F.map_from_entries(F.transform(listed, lambda e: F.struct(e["k"], e["v"]))).alias("listings"))


def flatten(nested: DataFrame, agent: str) -> DataFrame:
    """The inverse of ``nest``: one row per agent and label."""
    return nested.select(agent, F.explode("listings").alias("label", "_v")).select(agent, "label", "_v.*")


def observed_merge(merged: DataFrame, name: str = "merge") -> tuple[DataFrame, Observation]:
    """``merged`` as it is, and what its first action will have counted: rows, inserted, filled and unchanged ones.

    The counts come from the pass that writes the rows, so a report needs no second one. ``Observation.get`` waits for that action; a
    task that is run again counts once.
    """
    seen = Observation(name)
    action = F.col("action")
    counts = [F.count_if(action == a).alias(a) for a in ("inserted", "filled", "unchanged")]
    return merged.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def merge_summary(merged: DataFrame, agent: str) -> DataFrame:
    """Rows and distinct agents per merge action."""
    return merged.groupBy("action").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(agent).alias("agents")
    )


def agents_by_action(merged: DataFrame, agent: str) -> DataFrame:
    """The agents that a merge touched, once per action."""
    return merged.filter(F.col("action") != "unchanged").select("action", agent).distinct()

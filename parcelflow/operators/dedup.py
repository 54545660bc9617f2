"""Duplicates, caps and retention. All of them reduce before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order``, which must be total.

    ``max_by`` combines on the map side, so copies of a hot key shrink before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest])
    )


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the least ``order``, which must be total."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest])
    )


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows per key. Each task keeps ``n`` per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def fresh_rows(batch: DataFrame, stored: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of the batch whose key is neither stored nor earlier in the batch.

    Null key parts count as equal, as in a written-out key.
    """
    known = stored.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    first = first_wins(batch, keys, order).select(*batch.columns)
    match = [first[k].eqNullSafe(known[f"_k_{k}"]) for k in keys]
    return first.join(known, match, "left_anti")


def append_dedup(stored: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The stored rows as they are, plus the fresh rows of the batch."""
    return stored.unionByName(fresh_rows(batch, stored, keys, order))


def union_by_name_distinct(*frames: DataFrame) -> DataFrame:
    """Whole-row distinct over frames whose columns may differ; missing ones are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out.distinct()


def project_to_schema(df: DataFrame, schema) -> DataFrame:
    """Exactly the declared columns in their order; absent ones are null, others are dropped."""
    return df.select(*[
        (F.col(f"`{f.name}`").cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])

"""Counts, profiles and roll-ups. Every aggregation combines on the map side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from parcelflow.operators.skew import row_number, running_total


def state_counts(df: DataFrame, state: str) -> DataFrame:
    return df.groupBy(state).agg(F.count(F.lit(1)).alias("n"))


def count_by_geo(df: DataFrame, county: str, region: str) -> DataFrame:
    """Rows per 'county, state'; rows without both go to 'unidentified'."""
    name = F.when(
        F.col(county).isNotNull() & F.col(region).isNotNull(), F.concat(F.col(county), F.lit(", "), F.col(region))
    ).otherwise(F.lit("unidentified"))
    return df.groupBy(name.alias("geo")).agg(F.count(F.lit(1)).alias("n"))


def contact_rollup(
    df: DataFrame, keys: list[str], address: Column, order: list[str], width: int = 15
) -> DataFrame:
    """Per contact: the number of addresses, in all and in this row, and the addresses in columns ``address_1..width``.

    A contact with more than ``width`` addresses goes on in part 1, 2, …, each part being a
    row of its own; no address is left out. Null contacts form a group like any other.
    """
    ranked = row_number(df.withColumn("_addr", address), keys, order, "_rn")
    slot = F.pmod(F.col("_rn") - 1, F.lit(width))
    placed = ranked.withColumn("part", F.floor((F.col("_rn") - 1) / width).cast("bigint")).withColumn("_slot", slot)
    parts = placed.groupBy(*keys, "part").agg(
        F.count(F.lit(1)).alias("addresses"),
        *[F.max(F.when(F.col("_slot") == i, F.col("_addr"))).alias(f"address_{i + 1}") for i in range(width)],
    )
    # One row per part is left, so the total needs neither a second numbering nor a join.
    return parts.withColumn("total_addresses", F.sum("addresses").over(Window.partitionBy(*keys)))


def total_and_distinct(df: DataFrame, value: Column) -> DataFrame:
    return df.agg(F.count(value).alias("total"), F.countDistinct(value).alias("distinct_values"))


#: 2**12 registers: about 1.6% of standard error in at most 2.5 KB a sketch.
SKETCH_BITS = 12


def distinct_sketches(batch: DataFrame, group: list[str], value: str) -> DataFrame:
    """A sketch of the distinct values of each group of a batch, to be kept beside those of other batches; nulls do not count."""
    return batch.groupBy(*group).agg(F.hll_sketch_agg(value, F.lit(SKETCH_BITS)).alias("sketch"))


def distinct_estimates(sketches: DataFrame, group: list[str], out: str = "distinct_values") -> DataFrame:
    """Distinct values per group over all kept sketches: values that repeat from batch to batch count once, and no row is read again."""
    return sketches.groupBy(*group).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out))


def conditional_counts(df: DataFrame, key: str, failed: Column, min_failed: int) -> DataFrame:
    """Processed and failed rows per key, for keys with at least ``min_failed`` failures."""
    return (
        df.groupBy(key)
        .agg(F.count_if(~failed).alias("processed"), F.count_if(failed).alias("failed"))
        .filter(F.col("failed") >= min_failed)
    )


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: how many values each column lacks."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns]
    )


def observed_profile(df: DataFrame, columns: list[str], name: str = "profile") -> tuple[DataFrame, Observation]:
    """``df`` as it is, and the counts of ``null_profile`` from its first action."""
    seen = Observation(name)
    missing = [F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *missing), seen


def progress_ratio(df: DataFrame, done: Column) -> DataFrame:
    return df.agg(
        F.count_if(done).alias("done"),
        F.count(F.lit(1)).alias("total"),
        F.try_divide(F.count_if(done), F.count(F.lit(1))).alias("ratio"),
    )


def failure_streaks(df: DataFrame, key: str, order: list[str], failed: Column, **limits: int) -> DataFrame:
    """Per key: failures, number of unbroken runs of failures, and the longest run.

    All failures with the same number of successes before them form one run.
    """
    marked = df.select(key, *order, failed.cast("boolean").alias("_failed"))
    numbered = running_total(marked, [key], order, "_run", F.when(F.col("_failed"), 0).otherwise(1), **limits)
    runs = numbered.filter("_failed").groupBy(key, "_run").agg(F.count(F.lit(1)).alias("length"))
    return runs.groupBy(key).agg(
        F.sum("length").alias("failures"), F.count(F.lit(1)).alias("streaks"), F.max("length").alias("longest")
    )


def batch_ids(df: DataFrame, keys: list[str], order: list[str], size: int = 5, out: str = "batch") -> DataFrame:
    """Consecutive batches of ``size`` rows per key, from 0."""
    ranked = row_number(df, keys, order, "_rn")
    return ranked.withColumn(out, F.floor((F.col("_rn") - 1) / size).cast("bigint")).drop("_rn")


def round_robin(df: DataFrame, order: list[str], workers: int, out: str = "worker") -> DataFrame:
    """Row i of the whole order goes to worker i mod ``workers``."""
    ranked = row_number(df, [], order, "_rn")
    return ranked.withColumn(out, F.pmod(F.col("_rn") - 1, F.lit(workers))).drop("_rn")

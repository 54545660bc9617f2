"""Running totals with hot keys, against pandas."""

import datetime
import decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelflow.operators import documents, rollup, skew

SMALL = {"max_task_rows": 70}


def hot_rows(n=3000):
    """A third of the rows has one key, another part has a null key; times repeat."""
    rows = []
    for i in range(n):
        key = 1 if i % 3 == 0 else (None if i % 7 == 0 else i % 50)
        rows.append((key, None if i % 11 == 0 else (i * 7919) % 97, i, i % 4))
    return rows


def expected(rows, by_key=True):
    pdf = pd.DataFrame(rows, columns=["k", "t", "id", "v"]).astype({"k": "Int64", "t": "Int64"})
    pdf = pdf.sort_values(["t", "id"], na_position="first")
    groups = pdf.groupby("k", dropna=False) if by_key else None
    pdf["total"] = groups["v"].cumsum() if by_key else pdf["v"].cumsum()
    pdf["rn"] = groups.cumcount() + 1 if by_key else range(1, len(pdf) + 1)
    return {r.id: (r.total, r.rn) for r in pdf.itertuples()}


@pytest.mark.parametrize("keys,limits", [(["k"], SMALL), (["k"], {}), ([], SMALL)])
def test_running_total(spark, keys, limits):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k int, t int, id int, v int")
    out = skew.running_total(df, keys, ["t", "id"], "total", F.col("v"), **limits)
    out = out.join(skew.row_number(df, keys, ["t", "id"], "rn", **limits).select("id", "rn"), "id")
    assert {r.id: (r.total, r.rn) for r in out.collect()} == expected(rows, bool(keys))


def test_a_hot_key_is_cut(spark):
    """With the same data, no window group keeps the hot key in one piece."""
    df = spark.createDataFrame(hot_rows(), "k int, t int, id int, v int")
    plan = skew.row_number(df, ["k"], ["t", "id"], **SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(k#" in plan and "__range" in plan.split("windowspecdefinition(k#")[1][:60]


def test_timestamp_order(spark):
    rows = [(1, f"2024-03-{1 + i % 30:02d} {i % 24:02d}:{i % 60:02d}:00", i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, s string, id int").withColumn("t", F.col("s").cast("timestamp_ntz"))
    out = skew.row_number(df, ["k"], ["t", "id"], **SMALL).collect()
    want = {r[2]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2])), 1)}
    assert {r.id: r.rn for r in out} == want


def numbered(spark, rows, schema, keys, order, **limits):
    out = skew.row_number(spark.createDataFrame(rows, schema), keys, order, **limits).collect()
    return {r.id: r.rn for r in out}


def places(rows, by_key):
    """Row numbers of (key, order, id) rows by a plain sort."""
    want, seen = {}, {}
    for k, _, i in sorted(rows, key=lambda r: (r[1], r[2])):
        seen[by_key and k] = seen.get(by_key and k, 0) + 1
        want[i] = seen[by_key and k]
    return want


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("kind", ["sub-second time", "hashes", "outlier", "text", "decimal", "double"])
def test_orders_of_every_kind(spark, kind, keys):
    """Ids run against the order, so that a tie broken by them would show."""
    n = 3000
    at = {
        "sub-second time": lambda i: datetime.datetime(2024, 1, 1) + datetime.timedelta(microseconds=100 * i),
        "hashes": lambda i: (i * 0x9E3779B97F4A7C15 & (1 << 64) - 1) - (1 << 63),
        "outlier": lambda i: 10**15 if i == n - 1 else i,
        "text": lambda i: f"{i * 7919 % n:05d}",
        "decimal": lambda i: decimal.Decimal(i) / 7,
        "double": lambda i: i / 7 - 100,
    }[kind]
    name = {"sub-second time": "timestamp_ntz", "hashes": "bigint", "outlier": "bigint", "text": "string", "decimal": "decimal(20,10)", "double": "double"}[kind]
    rows = [(0 if i % 3 else i % 10, at(i), -i) for i in range(n)]
    if kind == "decimal":
        rows = [(k, v.quantize(decimal.Decimal("1e-10")), i) for k, v, i in rows]
    for limits in (SMALL, {}):
        assert numbered(spark, rows, f"k int, t {name}, id bigint", keys, ["t", "id"], **limits) == places(rows, bool(keys))


def test_ranges_are_about_equal(spark):
    """One value far out does not put all other rows of a hot key into one range."""
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.when(F.col("id") == 7, 10**15).otherwise(F.col("id")).alias("t"))
    out = skew.row_number(df, ["k"], ["t"], max_task_rows=500)
    assert out.agg(F.max("rn")).first()[0] == 20_000
    sizes = df.repartitionByRange(40, "k", "t").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 30 and max(r["count"] for r in sizes) < 20_000 / 10


def test_streaks_of_a_hot_key(spark):
    rows = [(1 if i % 3 else i % 20, i, (i * 31) % 5 < 3) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, t int, bad boolean")
    got = {r.k: (r.failures, r.streaks, r.longest) for r in
           rollup.failure_streaks(df, "k", ["t"], F.col("bad"), **SMALL).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        runs, run = [], 0
        for _, _, bad in sorted((r for r in rows if r[0] == k), key=lambda r: r[1]):
            if bad:
                run += 1
            elif run:
                runs.append(run)
                run = 0
        if run:
            runs.append(run)
        if runs:
            want[k] = (sum(runs), len(runs), max(runs))
    assert got == want


def test_long_groups_go_on_in_parts(spark):
    rows = [(1, i) for i in range(25)] + [(2, 0)]
    df = spark.createDataFrame(rows, "k int, t int")
    parts = {(r.k, r.part): r.records for r in documents.collect_per_group(df, "k", ["t"], F.col("t"), 10).collect()}
    assert parts == {
        (1, 0): list(range(10)), (1, 1): list(range(10, 20)), (1, 2): list(range(20, 25)), (2, 0): [0],
    }
    wide = rollup.contact_rollup(df, ["k"], F.col("t").cast("string"), ["t"], width=10).collect()
    assert sum(r.addresses for r in wide) == 26 and len(wide) == 4
    assert {(r.k, r.total_addresses) for r in wide} == {(1, 25), (2, 1)}


@pytest.mark.parametrize("order", [["same", "id"], ["none", "id"], ["few", "id"]])
def test_ties_on_the_leading_column(spark, order):
    df = spark.range(2000).select(
        F.lit(1).alias("k"), F.lit(5).alias("same"), F.lit(None).cast("int").alias("none"),
        (F.col("id") % 3).alias("few"), (F.col("id") * 7919 % 2003).alias("id"),
    )
    out = skew.row_number(df, ["k"], order, **SMALL)
    lead = order[0]
    want = sorted(df.select(lead, "id").collect(), key=lambda r: (r[0] or 0, r[1]))
    assert {(r[lead], r["id"]): r.rn for r in out.collect()} == {tuple(r): n for n, r in enumerate(want, 1)}


def test_hot_listing_key_is_split_at_run_time(spark):
    """A key with a third of the listings, and as many without a county: the join splits both."""
    from parcelflow.operators import enrich

    listings = spark.range(300_000).select(
        "id",
        F.when(F.col("id") % 3 == 1, None).otherwise("Lake").alias("county"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.md5(F.col("id").cast("string"))).alias("addr_key"),
    )
    index = spark.range(1000).select(
        F.lit("Lake").alias("county"), F.when(F.col("id") == 0, "hot").otherwise(F.md5(F.col("id").cast("string"))).alias("addr_key"),
        F.col("id").alias("beds"),
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = enrich.enrich(listings.repartition(16, "id"), index, ["beds"])
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(rows) == 300_000
    assert sum(r.matched for r in rows if r.addr_key == "hot") == 100_000
    assert "skew=true" in plan


@pytest.mark.parametrize("keys", [["k"], []])
def test_ranges_have_a_bound(spark, monkeypatch, keys):
    """However few rows a range may have, the ranges, each of which costs the driver memory, do not grow with the table."""
    made = []
    monkeypatch.setattr(skew, "MAX_RANGES", 7)
    monkeypatch.setattr(skew, "stored", lambda df: made.append(df.rdd.getNumPartitions()) or df.localCheckpoint())
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k int, t int, id int, v int")
    out = skew.running_total(df, keys, ["t", "id"], "total", F.col("v"), max_task_rows=2)
    want = {i: total for i, (total, _) in expected(rows, bool(keys)).items()}
    assert {r.id: r.total for r in out.collect()} == want
    if keys:
        skew.last_known(df, keys, ["t", "id"], F.col("v"), "last", max_task_rows=2).collect()
    assert made == [7] * len(made) and made

"""State kept from batch to batch: buckets, bitmaps, counts of the writing pass, versions, marks, sketches, streams."""

import glob
import os
import re
import threading
from datetime import datetime

import pytest
from pyspark.sql import Row, functions as F

from parcelflow.operators import documents, enrich, frontier, rollup
from parcelflow.schemas import EVENTS
from parcelflow.sources import buckets, readers, writers
from parcelflow.streaming import intake, sessions


def files(path):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_a_merge_leaves_other_buckets_as_they_are(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.range(2000).select(F.col("id").alias("url"), F.lit("old").alias("s"), F.lit(0).alias("n"))
    buckets.create(old, path, ["url"], 100)
    with pytest.raises(FileExistsError):
        buckets.create(old, path, ["url"], 100)
    before = files(path)
    batch = spark.createDataFrame([(7, "new", 1), (7, "newer", 2), (90_000, "new", 1)], "url int, s string, n int")
    merge = lambda a, b: frontier.upsert_replace(a, b, ["url"], ["n"])
    touched = buckets.merge_into(path, batch, ["url"], merge)
    after = files(path)
    gone = {re.search(r"bucket=(\d+)", p)[1] for p in before.keys() - after.keys()}
    assert 1 <= len(touched) <= 2 and gone <= {str(t) for t in touched}
    assert all(after[p] == before[p] for p in before if not any(f"bucket={t}/" in p for t in touched))
    want = merge(old, batch.withColumn("url", F.col("url").cast("bigint")))
    assert sorted(map(tuple, buckets.read(spark, path).collect())) == sorted(map(tuple, want.collect()))
    assert buckets.merge_into(path, batch.limit(0), ["url"], merge) == [] and files(path) == after
    plan = buckets.read(spark, path, [3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    with pytest.raises(FileNotFoundError):
        buckets.merge_into(str(tmp_path / "none"), batch, ["url"], merge)


def urls(spark, ids):
    return spark.createDataFrame([(None if i is None else f"u{i}",) for i in ids], "url string")


def test_bitmap_finds_the_same_new_keys(spark):
    processed, seen = urls(spark, [*range(5000), None]), urls(spark, [*range(4990, 5020), 5001, None])
    want = sorted(map(tuple, frontier.new_keys(seen, processed).collect()), key=str)
    kept = frontier.merged_bitmaps(frontier.key_bitmap(processed.limit(100)), frontier.key_bitmap(processed))
    for rows in (1, 16):
        assert sorted(map(tuple, frontier.new_keys_by_bitmap(seen, processed, rows=rows).collect()), key=str) == want
    assert sorted(map(tuple, frontier.new_keys_by_bitmap(seen, processed, bitmap=kept).collect()), key=str) == want
    told = frontier.with_possible(processed, frontier.key_bitmap(seen), "url")
    few = told.filter("possible").count()
    assert 10 <= few < 20, "nearly all processed keys are cleared before a shuffle"
    assert frontier.with_possible(seen.limit(0), kept).count() == 0
    assert frontier.with_possible(seen, kept.limit(0)).filter("possible").count() == 0
    with pytest.raises(ValueError):
        frontier.with_possible(seen, kept, rows=frontier.BITMAP_ROWS + 1)


def test_counts_come_from_the_pass_that_writes(spark, tmp_path):
    merged = spark.createDataFrame([("a", "inserted"), ("a", "filled"), ("b", "unchanged"), ("b", "inserted")], "agent string, action string")
    rows, seen = documents.observed_merge(merged)
    writers.publish(rows, str(tmp_path / "m"))
    assert seen.get == {"rows": 4, "inserted": 2, "filled": 1, "unchanged": 1}
    out, matches = enrich.observed_matches(spark.createDataFrame([(1, True), (2, False), (3, True)], "id int, matched boolean"))
    assert out.count() == 3 and matches.get == {"listings": 3, "matched": 2, "unmatched": 1}
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    out, profile = rollup.observed_profile(df, ["a", "b"])
    out.write.format("noop").mode("overwrite").save()
    assert profile.get == rollup.null_profile(df, ["a", "b"]).first().asDict()
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_writers_at_the_same_time_lose_nothing(spark, tmp_path):
    base, done = str(tmp_path / "t"), []

    def work(n):
        done.append((writers.publish(spark.range(n, n + 1), base), n))

    threads = [threading.Thread(target=work, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len({p for p, _ in done}) == 4 and all([r.id for r in spark.read.parquet(p).collect()] == [n] for p, n in done)
    last = max(done, key=lambda d: int(d[0].rsplit("=")[-1]))
    assert [r.id for r in writers.current(spark, base).collect()] == [last[1]]


def test_files_wait_for_a_merge(spark, tmp_path):
    folder, archive, merged = str(tmp_path / "in"), str(tmp_path / "archive"), []
    read = lambda paths: spark.read.schema("a int").option("header", "true").csv(paths)
    assert writers.consume_files(spark, folder, archive, read, merged.append) == []
    os.makedirs(folder)
    for name, text in (("x 1.csv", "a\n1\n2\n"), ("empty.csv", "a\n"), ("notes.txt", "a\n9\n")):
        (tmp_path / "in" / name).write_text(text)

    def fails(rows):
        raise OSError("down")

    with pytest.raises(OSError):
        writers.consume_files(spark, folder, archive, read, fails)
    assert sorted(os.listdir(folder)) == ["empty.csv", "notes.txt", "x 1.csv"]
    moved = writers.consume_files(spark, folder, archive, read, lambda rows: merged.extend(r.a for r in rows.collect()))
    assert merged == [1, 2] and [m.rsplit("/")[-1] for m in moved] == ["x 1.csv"] and sorted(os.listdir(folder)) == ["empty.csv", "notes.txt"]


def test_a_large_group_is_nested_in_parts(spark):
    df = spark.range(2500).select(F.lit("a").alias("agent"), F.col("id").alias("t"), F.col("id").cast("string").alias("address"))
    nested = documents.nest(df, "agent", ["t"], ["address"])
    assert sorted((r.part, len(r.listings)) for r in nested.collect()) == [(0, 1000), (1, 1000), (2, 500)]
    flat = documents.flatten(nested, "agent").collect()
    assert {r.label: r.address for r in flat} == {f"Address {i + 1}": str(i) for i in range(2500)}


def test_contact_rollup_numbers_once(spark):
    df = spark.range(40).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"))
    out = rollup.contact_rollup(df, ["k"], F.col("t").cast("string"), ["t"], width=7)
    assert {(r.k, r.part, r.addresses, r.total_addresses) for r in out.collect()} == {(k, p, 7 if p < 2 else 6, 20) for k in (0, 1) for p in (0, 1, 2)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("rowsframe") + plan.count("RowFrame") <= 4


def test_a_clock_set_back_changes_nothing(spark, tmp_path):
    """Counts of a later query win whatever the clock; folders carry no time."""
    base = str(tmp_path)
    for run in (1, 2):
        spark.range(10 * run).select(F.col("id").alias("event_id"), F.lit("click").alias("event_type")).write.parquet(f"{base}/in{run}")
        stream = spark.readStream.schema("event_id bigint, event_type string").parquet(f"{base}/in{run}")
        intake.drain(intake.running_counts(stream, "event_type", f"{base}/out"), f"{base}/cp{run}")
    for path in glob.glob(f"{base}/out/generation=2/**/*", recursive=True):
        os.utime(path, (0, 0))
    assert [(r.event_type, r.n) for r in intake.latest_counts(spark, f"{base}/out", "event_type").collect()] == [("click", 20)]
    assert "_at" not in spark.read.parquet(f"{base}/out").columns


def test_numbers_go_on(spark):
    marks = spark.createDataFrame([("a", 3)], "agent string, mark bigint")
    batch = spark.createDataFrame([("a", 5), ("a", 4), ("b", 1), (None, 2)], "agent string, t int")
    numbered, after = documents.number_on(marks, batch, "agent", ["t"])
    assert {(r.agent, r.t): r.n for r in numbered.collect()} == {("a", 4): 4, ("a", 5): 5, ("b", 1): 1, (None, 2): 1}
    assert {r.agent: r.mark for r in after.collect()} == {"a": 5, "b": 1, None: 1}
    again, last = documents.number_on(after, batch.limit(0), "agent", ["t"])
    assert again.count() == 0 and sorted(map(tuple, last.collect()), key=str) == sorted(map(tuple, after.collect()), key=str)


@pytest.mark.parametrize("limits", [{}, {"max_task_rows": 3}])
def test_as_of_enrichment(spark, limits):
    t = lambda d: datetime(2024, 1, d)
    listings = spark.createDataFrame([(i, "k", t(i % 9 + 1)) for i in range(20)] + [(90, "z", t(3)), (91, None, t(3)), (92, "k", None)], "id int, k string, at timestamp")
    loads = spark.createDataFrame(
        [("k", t(3), 1, "a", None), ("k", t(3), 2, "b", 5), ("k", t(6), 1, "c", None), (None, t(1), 1, "d", 1), ("k", None, 9, "e", 1)],
        "k string, at timestamp, seq int, price string, beds int",
    )
    out = enrich.as_of(listings, loads, ["k"], "at", "at", ["price", "beds"], ["seq"], **limits)
    assert out.columns == ["id", "k", "at", "price", "beds"]
    got = {r.id: (r.price, r.beds) for r in out.collect()}
    want = {i: ((None, None) if i % 9 < 2 else ("b", 5) if i % 9 < 5 else ("c", None)) for i in range(20)}
    assert got == {**want, 90: (None, None), 91: (None, None), 92: (None, None)}


def test_sketches_of_batches_add_up(spark):
    batches = [spark.range(n * 3000, n * 3000 + 6000).select((F.col("id") % 2).alias("g"), "id") for n in range(3)]
    kept = [rollup.distinct_sketches(b, ["g"], "id") for b in batches]
    every = kept[0].unionByName(kept[1]).unionByName(kept[2])
    assert all(abs(r.distinct_values - 6000) <= 300 for r in rollup.distinct_estimates(every, ["g"]).collect())
    assert rollup.distinct_estimates(every.limit(0), ["g"]).count() == 0


def test_variants_lose_no_field(spark):
    lines = ['{"a":"x","b":1}', '{"b":"no number","c":[1,{"d":null}]}', "{}", "[1]", "broken{", None, '{"a":null,"e f":true}']
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    out = readers.scan_variants(df, {"a": "string", "b": "int"}, bad="bad")
    rows = out.select("a", "b", F.to_json("rest").alias("rest"), "bad", readers.rest_joined(["a", "b"]).alias("back")).collect()
    assert [(r.a, r.b, r.rest) for r in rows if r.bad is None and r.rest is not None] == [
        ("x", 1, "{}"), (None, None, '{"b":"no number","c":[1,{"d":null}]}'), (None, None, "{}"), (None, None, '{"a":null,"e f":true}')
    ]
    assert [r.back for r in rows if r.rest is not None] == ['{"a":"x","b":1}', '{"b":"no number","c":[1,{"d":null}]}', "{}", '{"a":null,"e f":true}']
    assert [r.bad for r in rows if r.bad is not None] == ["[1]", "broken{"]
    assert readers.scan_variants(df, {"a": "string"}).count() == 5


def at(minute):
    return datetime(2024, 1, 1 + minute // 1440, minute % 1440 // 60, minute % 60)


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    base = str(tmp_path)
    parts = [[(1, 0), (1, 5), (2, 100)], [(1, 300), (2, 310)], [(1, 20), (2, 900)]]
    for n, part in enumerate(parts):
        spark.createDataFrame([(k, at(m)) for k, m in part], "k int, ts timestamp").coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema("k int, ts timestamp").parquet(f"{base}/in")
        found = sessions.sessions(stream, "k", "ts", "10 minutes", "1 hour")
        query = intake.append_files(found, f"{base}/out").option("checkpointLocation", f"{base}/cp").trigger(availableNow=True).start()
        query.awaitTermination()
    assert sessions.dropped_rows(query) == 1, "minute 20 comes when the watermark stands at 250"
    got = sorted((r.k, r.rows, r.seconds) for r in spark.read.parquet(f"{base}/out").collect())
    assert got == [(1, 1, 0.0), (1, 2, 300.0), (2, 1, 0.0), (2, 1, 0.0)]
    assert sorted(r.rows for r in sessions.sessions(spark.read.parquet(f"{base}/in"), "k", "ts", "10 minutes").collect()) == [1, 1, 1, 1, 1, 2]


def test_failure_runs_over_batches_and_expiry(spark, tmp_path):
    base = str(tmp_path)
    spark.conf.set(*sessions.STATE_STORE)
    parts = [[("u", 0, "error"), ("u", 1, "error"), ("v", 1, "view")], [("u", 2, "error"), ("v", 3, "error")], [("w", 5000, "view")], [("u", 5001, "error")]]
    n, sizes = 0, []
    for part in parts:
        rows = [(n + i, at(m), key, kind, 0.0, "") for i, (key, m, kind) in enumerate(part)]
        n += len(rows)
        df = spark.createDataFrame([Row(*r) for r in rows], "event_id bigint, ts timestamp, user string, event_type string, value double, props string")
        df.coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{base}/in")
        runs = sessions.failure_runs(stream, "user", "ts", "event_id", F.col("event_type") == "error", "1 minute", expiry=3600)
        query = intake.upsert_deltas(runs, ["user"], [], f"{base}/out").option("checkpointLocation", f"{base}/cp").trigger(availableNow=True).start()
        query.awaitTermination()
        sizes.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
        if len(sizes) == 2:
            got = {r.user: r for r in intake.latest_rows(spark, f"{base}/out", ["user"], []).collect()}
            assert {u: (r.failures, r.streaks, r.longest, r.run, r.given_up) for u, r in got.items()} == {"u": (3, 1, 3, 3, True), "v": (1, 1, 1, 1, False)}
            assert got["u"].retry_at is None and (got["v"].retry_at - at(3)).total_seconds() == 2
    assert sizes[2] < sizes[1], "keys without rows for an hour are forgotten"
    got = {r.user: r for r in intake.latest_rows(spark, f"{base}/out", ["user"], []).collect()}
    assert (got["u"].failures, got["u"].run, got["u"].given_up) == (1, 1, False)


def test_schema_of_events_is_kept(spark):
    assert [f.name for f in EVENTS.fields][:3] == ["event_id", "ts", "user_id"]

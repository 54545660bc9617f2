"""Sources, sinks and streams on small files."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from parcelflow.schemas import EVENTS, PROVIDER_RAW
from parcelflow.sources import readers, writers
from parcelflow.streaming import intake


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_dir_skips_the_url_export(spark, tmp_path):
    for name in ("a.csv", "b.csv", "Total_URLs.csv", "xTotal_URLs.csv"):
        write(tmp_path / "in" / name, f'k,v\n{name},"1, ""2"""\n')
    write(tmp_path / "in" / "c.txt", "k,v\nno,0\n")
    got = readers.scan_csv_dir(spark, str(tmp_path / "in"), T.StructType.fromDDL("k string, v string")).collect()
    assert {r.k for r in got} == {"a.csv", "b.csv", "xTotal_URLs.csv"}
    assert {r.v for r in got} == {'1, "2"'}


def test_work_and_comma_lists(spark, tmp_path):
    path = write(tmp_path / "w.csv", 'Location,ZipCodes,Completed\nA,"01234, 2,",Yes\nB,"3,4",\n')
    rows = readers.scan_work_list(spark, path).orderBy("line_no").collect()
    assert [(r.location, r.zip_codes, r.completed) for r in rows] == [("A", ["01234", "2"], True), ("B", ["3", "4"], False)]
    path = write(tmp_path / "z.txt", " 01234,  34946 ,34947\n")
    assert [r.zip_code for r in readers.scan_comma_list(spark, path).collect()] == ["01234", "34946", "34947"]


def test_kv_records(spark, tmp_path):
    write(tmp_path / "kv" / "1.txt", "address: 1 Main\nprice: $5: firm\nbroken line\n\naddress: 2 Main\n")
    write(tmp_path / "kv" / "2.txt", "price: 7\r\n")
    rows = readers.scan_kv_records(spark, str(tmp_path / "kv"), ["address", "price"]).collect()
    assert sorted((r.address, r.price, r.bad_lines) for r in rows if r.address) == [("2 Main", "$5: firm", 1)]
    assert [(r.price, r.bad_lines) for r in rows if r.address is None] == [("7", 0)]


@pytest.mark.parametrize("split", ["16", "37", "1000"])
def test_records_of_one_file_over_many_tasks(spark, tmp_path, split):
    """A file of many records is read by ranges of bytes; each record belongs to the range that it begins in, wherever the cuts fall."""
    records = [f"address: {i} Main\nprice: {'9' * (i % 40 + 1)}\nbroken" for i in range(300)]
    path = write(tmp_path / "kv" / "all.txt", writers.RECORD_SEPARATOR.join(records))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = readers.scan_kv_records(spark, path, ["address"], separator=writers.RECORD_SEPARATOR)
        assert found.rdd.getNumPartitions() >= 8
        assert sorted((r.address, r.bad_lines) for r in found.collect()) == sorted((f"{i} Main", 1) for i in range(300))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_documents_json(spark, tmp_path):
    record = T.StructType.fromDDL("address string, price string")
    doc = {"Ann": {"Address 1": {"address": "x", "price": "$1"}, "Address 2": {"address": "y"}}, "Bob": {}}
    path = write(tmp_path / "d.json", json.dumps(doc, indent=4))
    rows = readers.scan_documents_json(spark, path, record, whole_file=True).collect()
    assert sorted((r.agent, r.label, r.address, r.price) for r in rows) == [("Ann", "Address 1", "x", "$1"), ("Ann", "Address 2", "y", None)]
    broken = write(tmp_path / "bad.json", '{"Ann": {')
    assert readers.scan_documents_json(spark, broken, record, whole_file=True).count() == 0
    kept = readers.scan_documents_json(spark, broken, record, whole_file=True, bad="bad").collect()
    assert [(r.agent, r.bad) for r in kept] == [(None, '{"Ann": {')]
    none = readers.scan_documents_json(spark, str(tmp_path / "absent.json"), record)
    assert none.count() == 0 and none.columns == ["agent", "label", "address", "price"]


def test_provider_csv(spark, tmp_path):
    schema = T.StructType(PROVIDER_RAW.fields[:4])
    write(tmp_path / "p" / "a.csv", "County,Address,Sq,Year\n Lake ,1 Main,10,1990\nLake,2 Main,20,1991,9,9\n")
    rows = readers.scan_provider_csv(spark, str(tmp_path / "p"), schema).collect()
    assert [(r.County, r.Address) for r in rows] == [("Lake", "1 Main")]
    every = readers.scan_provider_csv(spark, str(tmp_path / "p"), schema, bad="bad").collect()
    assert sorted((r.bad or "", r.Address) for r in every) == [("", "1 Main"), ("Lake,2 Main,20,1991,9,9", "2 Main")]


def test_lexicon_file(spark, tmp_path):
    path = write(tmp_path / "c.json", json.dumps({"x": 1, "keywords": {"B": ["b1", "b2"], "A": ["a1"]}}, indent=1))
    rows = readers.scan_lexicon(spark, path).collect()
    assert [tuple(r) for r in rows] == [(0, "B", 0, "b1"), (0, "B", 1, "b2"), (1, "A", 0, "a1")]


def test_log_file(spark, tmp_path):
    path = write(tmp_path / "x.log", "2024-08-01 10:00:00 - INFO - done\nTraceback\n")
    assert [(r.level, r.message) for r in readers.scan_log_lines(spark, path).collect()] == [("INFO", "done")]


def test_url_state_filter_is_pushed(spark, tmp_path):
    path = str(tmp_path / "state")
    spark.createDataFrame([("u", "L", "pending"), ("v", "L", "processed")], "url string, location string, state string").write.parquet(path)
    df = readers.scan_url_state(spark, path, "L", "pending")
    assert [r.url for r in df.collect()] == ["u"]
    assert "EqualTo(state,pending)" in df._jdf.queryExecution().executedPlan().toString()


def test_versions(spark, tmp_path):
    base = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        writers.current(spark, base)
    for n in range(5):
        writers.publish(spark.range(n + 1) if n == 0 else writers.current(spark, base).selectExpr("id + 1 AS id"), base)
    assert [r.id for r in writers.current(spark, base).collect()] == [4]
    assert [p.rsplit("=")[-1] for p in writers.retained(spark, base, 3)] == ["5", "4", "3"]
    (tmp_path / "t" / "version=6").mkdir()
    moved = writers.archive_old(spark, base, str(tmp_path / "archive"), 3)
    assert [p.rsplit("/")[-1] for p in moved] == ["version=1", "version=2"]
    assert [r.id for p in moved for r in spark.read.parquet(p).collect()] == [0, 1]
    assert [r.id for r in writers.current(spark, base).collect()] == [4]


def test_append_fresh(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "address string, zip string, price string, n int"
    writers.append(spark.createDataFrame([("a", "1", "$1", 0)], schema), path)
    batch = spark.createDataFrame([("a", "1", "$1", 1), ("b", "1", "$1", 3), ("b", "1", "$1", 2)], schema)
    writers.append_fresh(batch, str(tmp_path / "new"), ["address", "zip", "price"], ["n"])
    assert sorted((r.address, r.n) for r in spark.read.parquet(str(tmp_path / "new")).collect()) == [("a", 1), ("b", 2)]
    for _ in range(2):
        writers.append_fresh(batch, path, ["address", "zip", "price"], ["n"])
    assert sorted((r.address, r.n) for r in spark.read.parquet(path).collect()) == [("a", 0), ("b", 2)]


def events(spark, ids):
    rows = [(i, i % 5, "view" if i % 2 else "click") for i in ids]
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_type string")
    minutes = F.make_interval(mins=F.col("event_id").cast("int"))
    return df.select(
        "event_id", (F.lit("2024-01-01").cast("timestamp_ntz") + minutes).alias("ts"), "user_id", "event_type",
        F.lit(1.0).alias("value"), F.lit("{}").alias("props"),
    )


def test_restart_adds_nothing(spark, tmp_path):
    base = str(tmp_path)
    events(spark, range(20)).write.parquet(f"{base}/in")
    for _ in range(2):
        stream = intake.watch_folder(spark, f"{base}/in", EVENTS)
        intake.drain(intake.append_files(stream, f"{base}/out"), f"{base}/cp")
    assert spark.read.parquet(f"{base}/out").count() == 20


def test_dedup_state_outlives_a_restart(spark, tmp_path):
    base = str(tmp_path)
    for ids in (range(10), range(5, 15)):
        events(spark, ids).write.mode("append").parquet(f"{base}/in")
        stream = intake.watch_folder(spark, f"{base}/in", EVENTS)
        fresh = intake.drop_seen(stream, ["event_id"], "ts", "1 hour")
        intake.drain(intake.append_files(fresh, f"{base}/out"), f"{base}/cp")
    assert sorted(r.event_id for r in spark.read.parquet(f"{base}/out").collect()) == list(range(15))


def test_upserts_and_compaction(spark, tmp_path):
    base, order = str(tmp_path), ["ts", "event_id"]
    for ids in (range(10), range(10, 17)):
        events(spark, ids).write.mode("append").parquet(f"{base}/in")
        stream = intake.watch_folder(spark, f"{base}/in", EVENTS)
        intake.drain(intake.upsert_deltas(stream, ["user_id"], order, f"{base}/out"), f"{base}/cp")
    want = {0: 15, 1: 16, 2: 12, 3: 13, 4: 14}
    latest = intake.latest_rows(spark, f"{base}/out", ["user_id"], order)
    assert {r.user_id: r.event_id for r in latest.collect()} == want
    intake.compact(spark, f"{base}/out", f"{base}/archive", ["user_id"], order)
    assert {r.user_id: r.event_id for r in intake.latest_rows(spark, f"{base}/out", ["user_id"], order).collect()} == want
    assert spark.read.parquet(f"{base}/out").count() == 5 and spark.read.parquet(f"{base}/archive").count() == 10
    events(spark, range(17, 18)).write.mode("append").parquet(f"{base}/in")
    stream = intake.watch_folder(spark, f"{base}/in", EVENTS)
    intake.drain(intake.upsert_deltas(stream, ["user_id"], order, f"{base}/out"), f"{base}/cp")
    assert {r.user_id: r.event_id for r in intake.latest_rows(spark, f"{base}/out", ["user_id"], order).collect()} == want | {2: 17}


def test_a_lost_checkpoint_loses_no_delta(spark, tmp_path):
    base, order = str(tmp_path), ["ts", "event_id"]
    for run, ids in enumerate((range(10), range(3))):
        events(spark, ids).write.parquet(f"{base}/in{run}")
        stream = intake.watch_folder(spark, f"{base}/in{run}", EVENTS)
        intake.drain(intake.upsert_deltas(stream, ["user_id"], order, f"{base}/out"), f"{base}/cp{run}")
    latest = intake.latest_rows(spark, f"{base}/out", ["user_id"], order)
    assert {r.user_id: r.event_id for r in latest.collect()} == {0: 5, 1: 6, 2: 7, 3: 8, 4: 9}


def test_poll_takes_up_new_files(spark, tmp_path):
    base = str(tmp_path)
    events(spark, range(4)).write.parquet(f"{base}/in")
    query = intake.poll(intake.append_files(intake.watch_folder(spark, f"{base}/in", EVENTS), f"{base}/out"), f"{base}/cp", seconds=1)
    try:
        query.processAllAvailable()
        events(spark, range(4, 7)).write.mode("append").parquet(f"{base}/in")
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(f"{base}/out").count() == 7


def test_read_files_are_archived(spark, tmp_path):
    base = str(tmp_path)
    (tmp_path / "archive").mkdir()
    for ids in (range(4), range(4, 7), range(7, 9)):
        events(spark, ids).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = intake.watch_folder(spark, f"{base}/in", EVENTS, archive=f"{base}/archive")
        intake.drain(intake.append_files(stream, f"{base}/out"), f"{base}/cp")
    assert spark.read.parquet(f"{base}/out").count() == 9
    assert any((tmp_path / "archive").rglob("*.parquet"))


def test_counts_over_two_runs(spark, tmp_path):
    base = str(tmp_path)
    for ids in (range(10), range(10, 15)):
        events(spark, ids).write.mode("append").parquet(f"{base}/in")
        stream = intake.watch_folder(spark, f"{base}/in", EVENTS)
        intake.drain(intake.running_counts(stream, "event_type", f"{base}/out"), f"{base}/cp")
    assert {r.event_type: r.n for r in intake.latest_counts(spark, f"{base}/out", "event_type").collect()} == {"click": 8, "view": 7}

"""State that grows batch by batch: touched buckets, key bitmaps, counts from the writing pass, marks, sketches, loads in time, and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelflow.functions import dom
from parcelflow.operators import dedup, documents, enrich, extract, frontier, rollup
from parcelflow.plans.documents import SIDES_SQL, merged
from parcelflow.plans.extraction import element_sql
from parcelflow.plans.frontier import passes
from parcelflow.plans.registry import SQL, query, table
from parcelflow.schemas import EVENTS
from parcelflow.session import stored, workdir
from parcelflow.sources import buckets, readers, writers
from parcelflow.streaming import intake, sessions

CUT = "1998-06-01"


def cut():
    return F.lit(CUT).cast("timestamp_ntz")


@query("bucketed_upsert", f"""
    SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus
    FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}' OR o_custkey % 50 = 3 GROUP BY o_custkey
""")
def bucketed_upsert(spark, sf_dir):
    """A table in 64 buckets, and a batch that touches some of them: only these are read and rewritten."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    order = ["o_orderdate", "o_orderkey"]
    path = f"{workdir(spark, 'buckets')}/orders"
    buckets.create(dedup.last_wins(orders.filter(F.col("o_orderdate") < cut()), ["o_custkey"], order), path, ["o_custkey"], 64)
    batch = orders.filter((F.col("o_orderdate") >= cut()) & (F.col("o_custkey") % 50 == 3))
    buckets.merge_into(path, batch, ["o_custkey"], lambda old, new: frontier.upsert_replace(old, new, ["o_custkey"], order))
    return buckets.read(spark, path).select("o_custkey", "o_orderkey", "o_orderstatus")


@query("frontier_new_bitmap", SQL["frontier_new"])
def frontier_new_bitmap(spark, sf_dir):
    """New keys with a bitmap kept beside the processed ones, and one of the pass before the shuffle."""
    seen, processed = passes(spark, sf_dir)
    return frontier.new_keys_by_bitmap(seen, processed, bitmap=stored(frontier.key_bitmap(processed)))


@query("merge_counts_observed", f"""
    WITH {SIDES_SQL}
    SELECT count(*) AS rows, count(*) FILTER (action = 'inserted') AS inserted, count(*) FILTER (action = 'filled') AS filled,
           count(*) FILTER (action = 'unchanged') AS unchanged FROM merged
""")
def merge_counts_observed(spark, sf_dir):
    """What a merge did, counted by the pass that writes it."""
    rows, seen = documents.observed_merge(merged(spark, sf_dir))
    writers.publish(rows, f"{workdir(spark, 'observed')}/merged")
    return spark.createDataFrame([seen.get], "rows bigint, inserted bigint, filled bigint, unchanged bigint")


@query("consume_input", f"""
    SELECT 'merged' AS place, c_custkey, c_mktsegment FROM customer WHERE c_custkey % 4 < 3
    UNION ALL SELECT 'archived', c_custkey, c_mktsegment FROM customer WHERE c_custkey % 4 < 3
    UNION ALL SELECT 'waiting', c_custkey, c_mktsegment FROM customer WHERE c_custkey % 4 = 3
""")
def consume_input(spark, sf_dir):
    """Files move to the archive once they are merged; those of a merge that fails, and one without rows, stay."""
    base = workdir(spark, "consume")
    schema = "c_custkey bigint, c_mktsegment string"
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")

    def arrive(rows):
        rows.write.mode("append").csv(f"{base}/in")

    def read(paths):
        return spark.read.schema(schema).csv(paths)

    def merge(rows):
        writers.append(rows, f"{base}/table")

    def fails(rows):
        raise OSError("no connection")

    for part in (0, 1):
        arrive(customer.filter(F.col("c_custkey") % 4 == part))
        writers.consume_files(spark, f"{base}/in", f"{base}/archive", read, merge)
    arrive(customer.filter(F.col("c_custkey") % 4 == 2))
    try:
        writers.consume_files(spark, f"{base}/in", f"{base}/archive", read, fails)
    except OSError:
        writers.consume_files(spark, f"{base}/in", f"{base}/archive", read, merge)
    arrive(customer.filter(F.col("c_custkey") % 4 == 3))
    places = [("merged", spark.read.parquet(f"{base}/table")), ("archived", read([f"{base}/archive"])), ("waiting", read([f"{base}/in"]))]
    every = [df.select(F.lit(place).alias("place"), "c_custkey", "c_mktsegment") for place, df in places]
    return every[0].unionByName(every[1]).unionByName(every[2])


@query("labels_across_batches", """
    SELECT o_orderkey, o_custkey, 'Address ' || row_number() OVER (
        PARTITION BY o_custkey ORDER BY least(2, greatest(0, (year(o_orderdate) - 1996) // 2)), o_orderkey DESC) AS label
    FROM orders
""")
def labels_across_batches(spark, sf_dir):
    """Labels given batch by batch: each goes on from the agent's mark, so none changes or comes twice."""
    batch_of = F.least(F.lit(2), F.greatest(F.lit(0), F.floor((F.year("o_orderdate") - 1996) / 2)))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", batch_of.alias("batch"), (-F.col("o_orderkey")).alias("newest"))
    marks, labelled = spark.createDataFrame([], "o_custkey bigint, mark bigint"), None
    for n in range(3):
        numbered, marks = documents.number_on(marks, orders.filter(F.col("batch") == n), "o_custkey", ["newest"])
        marks = stored(marks)
        labelled = numbered if labelled is None else labelled.unionByName(numbered)
    return labelled.select("o_orderkey", "o_custkey", F.concat(F.lit("Address "), F.col("n").cast("string")).alias("label"))


@query("enrich_as_of", """
    WITH loads AS (SELECT o_custkey, o_orderdate, arg_max(o_orderkey, o_orderkey) AS load_key, arg_max(o_totalprice, o_orderkey) AS load_price
                   FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL)
    SELECT l.o_orderkey, l.o_custkey, load_key, load_price
    FROM (SELECT * FROM orders WHERE o_orderstatus <> 'F') l ASOF LEFT JOIN loads p ON l.o_custkey = p.o_custkey AND l.o_orderdate >= p.o_orderdate
""")
def enrich_as_of(spark, sf_dir):
    """Each open order with the finished one that was the customer's last by then."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    loads = orders.filter("o_orderstatus = 'F'").select(
        "o_custkey", "o_orderdate", F.col("o_orderkey").alias("load_key"), F.col("o_totalprice").alias("load_price")
    )
    listings = orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_custkey", "o_orderdate")
    found = enrich.as_of(listings, loads, ["o_custkey"], "o_orderdate", "o_orderdate", ["load_key", "load_price"], ["load_key"])
    return found.drop("o_orderdate")


@query("distinct_by_sketch", """
    SELECT l_linestatus, count(DISTINCT l_orderkey) AS exact, true AS close FROM lineitem GROUP BY l_linestatus
""")
def distinct_by_sketch(spark, sf_dir):
    """Distinct orders from sketches kept per batch, within 5% (three standard errors) of the exact count; no batch is read twice for them."""
    lines = table(spark, sf_dir, "lineitem").select("l_linestatus", "l_orderkey", (F.year("l_shipdate") % 3).alias("batch"))
    base = f"{workdir(spark, 'sketches')}/kept"
    for n in range(3):
        writers.append(rollup.distinct_sketches(lines.filter(F.col("batch") == n), ["l_linestatus"], "l_orderkey"), base)
    about = rollup.distinct_estimates(spark.read.parquet(base), ["l_linestatus"], "about")
    exact = lines.groupBy("l_linestatus").agg(F.countDistinct("l_orderkey").alias("exact"))
    close = F.abs(F.col("about") - F.col("exact")) <= 0.05 * F.col("exact") + 1
    return exact.join(about, "l_linestatus").select("l_linestatus", "exact", close.alias("close"))


@query("variant_round_trip", """
    SELECT c_name AS address, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS INTEGER) END AS beds,
           CASE c_custkey % 3 WHEN 0 THEN '{}' WHEN 1 THEN '{"beds":"many","pool":true}' ELSE '{"tags":["a",' || c_custkey || '],"view":{"sea":null}}' END AS rest,
           '{"address":"' || c_name || '"' || CASE c_custkey % 3 WHEN 0 THEN ',"beds":' || c_custkey || '}' WHEN 1 THEN ',"beds":"many","pool":true}'
               ELSE ',"tags":["a",' || c_custkey || '],"view":{"sea":null}}' END AS back
    FROM customer WHERE c_custkey % 7 <> 0
""")
def variant_round_trip(spark, sf_dir):
    """Documents of three shapes and some that are none: known fields typed, all others kept, and the same documents again."""
    key = F.col("c_custkey").cast("string")
    shapes = F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit('["'), "c_name")).when(
        F.col("c_custkey") % 3 == 0, F.concat(F.lit('{"address":"'), "c_name", F.lit('", "beds":'), key, F.lit("}"))
    ).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit('{"pool":true,"beds":"many","address":"'), "c_name", F.lit('"}'))).otherwise(
        F.concat(F.lit('{"tags":["a", '), key, F.lit('],"address":"'), "c_name", F.lit('","view":{"sea":null}}'))
    )
    path = f"{workdir(spark, 'variants')}/table"
    lines = table(spark, sf_dir, "customer").select(shapes.alias("value"))
    readers.scan_variants(lines, {"address": "string", "beds": "int"}).write.parquet(path)
    saved = spark.read.parquet(path)
    return saved.select("address", "beds", F.to_json("rest").alias("rest"), readers.rest_joined(["address", "beds"]).alias("back"))


GAP_HOURS, LATE_HOURS = 6, 48
SESSIONS_SQL = f"""
    marked AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL {GAP_HOURS} HOURS THEN 0 ELSE 1 END AS starts FROM events),
    placed AS (SELECT user_id, ts, sum(starts) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM marked),
    every AS (SELECT user_id, min(ts) AS began, max(ts) AS ended, count(*) AS rows, CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / 1e6 AS seconds
              FROM placed GROUP BY user_id, n)
"""


def _local(found):
    """Instants as the table's local times."""
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("began", "ended")})


@query("session_elapsed", f"WITH {SESSIONS_SQL} SELECT * FROM every")
def session_elapsed(spark, sf_dir):
    return _local(sessions.sessions(table(spark, sf_dir, "events"), "user_id", "ts", f"{GAP_HOURS} hours"))


@query("stream_sessions", f"""
    WITH {SESSIONS_SQL} SELECT * FROM every WHERE ended + INTERVAL {GAP_HOURS} HOURS <= (SELECT max(ts) FROM events) - INTERVAL {LATE_HOURS} HOURS
""")
def stream_sessions(spark, sf_dir):
    """Sessions of a stream come out once the watermark has passed their end; the last two days' are still open."""
    base = workdir(spark, "stream_sessions")
    stream = intake.watch_folder(spark, f"{sf_dir}/events*.parquet", EVENTS)
    found = sessions.sessions(stream, "user_id", "ts", f"{GAP_HOURS} hours", f"{LATE_HOURS} hours")
    intake.drain(intake.append_files(found, f"{base}/out"), f"{base}/checkpoint")
    return _local(spark.read.schema("user_id bigint, began timestamp, ended timestamp, rows bigint, seconds double").parquet(f"{base}/out"))


@query("stream_failure_runs", SQL["failure_streaks"])
def stream_failure_runs(spark, sf_dir):
    """Runs of failures kept as streaming state over two runs on one checkpoint: the same as from the whole table."""
    base = workdir(spark, "stream_failures")
    spark.conf.set(*sessions.STATE_STORE)
    events = table(spark, sf_dir, "events")
    middle = events.agg(F.percentile_approx("event_id", 0.5)).first()[0] or 0
    for part in (events.filter(F.col("event_id") <= middle), events.filter(F.col("event_id") > middle)):
        part.write.mode("append").parquet(f"{base}/arrivals")
        stream = intake.watch_folder(spark, f"{base}/arrivals", EVENTS)
        runs = sessions.failure_runs(stream, "user_id", "ts", "event_id", F.col("event_type") == "error")
        intake.drain(intake.upsert_deltas(runs, ["user_id"], [], f"{base}/out"), f"{base}/checkpoint")
    latest = intake.latest_rows(spark, f"{base}/out", ["user_id"], [])
    return latest.filter("failures > 0").select("user_id", "failures", "streaks", "longest")


_AD = element_sql('div class="ad"', "div")


@query("select_elements", f"""
    SELECT page_id, {_AD} AS ad, len(string_split(html, '<li>')) - 1 AS items, len(string_split(html, '<p>')) - 1 AS paragraphs,
           nullif(trim(split_part(list_extract(string_split(split_part(html, '</nav>', 1), '">'), -1), '</a>', 1)), '') AS last_item,
           'page ' || page_id AS heading, page_id || ' inner tail' AS outer, 'inner' AS nested, CAST(page_id AS VARCHAR) AS beside, '/n' || page_id AS link
    FROM pages
""")
def select_elements(spark, sf_dir):
    """Elements by selector, from the pages and from markup with comments, scripts, quoted brackets and elements within their like."""
    key = F.col("page_id").cast("string")
    odd = F.concat(
        F.lit("<!-- <h1>old</h1> --><script>var a='<h1>no</h1>';</script><h1>page "), key, F.lit("</h1><DIV class='row main' title='1>0'>"), key,
        F.lit(" <div class=row data-id=7>inner</div> tail<!-- </div> --></DIV><div class='pair'><span class='name'>HOA dues</span><span class=value>"), key,
        F.lit("</span></div><a data-x='1>0' href='/n"), key, F.lit("'>go</a>"),
    )
    pages = table(spark, sf_dir, "pages").select("page_id", dom.tokens("html").alias("t"), dom.tokens(odd).alias("o"))
    pages = pages.withColumn("nav", F.get(dom.select("t", "nav"), 0)["inside"])
    return pages.select(
        "page_id", dom.select_text("t", "div.ad").alias("ad"), F.size(dom.select("t", "li")).cast("bigint").alias("items"),
        F.size(dom.select("t", "p")).cast("bigint").alias("paragraphs"), F.try_element_at(dom.select_texts("nav", "li"), F.lit(-1)).alias("last_item"),
        dom.select_text("o", "h1").alias("heading"), dom.select_text("o", "div.row.main[title]").alias("outer"),
        dom.select_text("o", 'div.row[data-id="7"]').alias("nested"), dom.value_beside("o", "div.pair", "span.name", "span.value", "HOA").alias("beside"),
        dom.attribute(F.get(dom.select("o", "a[href]"), 0)["opening"], "href").alias("link"),
    )


@query("listing_page_fields", """
    SELECT c_custkey, c_custkey || ' Main & 1st St, City ' || c_nationkey || ', FL ' || lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS address,
           'City ' || c_nationkey AS city, 'FL' AS state, lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip_code,
           CASE WHEN c_custkey % 5 > 0 THEN '$' || c_custkey || ',000' END AS price, CASE WHEN c_custkey % 3 > 0 THEN CAST(1000 + c_custkey % 1000 AS INTEGER) END AS rent,
           CAST(c_nationkey AS INTEGER) AS hoa_fee, CAST(7000 + c_custkey % 1000 AS INTEGER) AS property_taxes, CAST(NULL AS INTEGER) AS insurance, CAST(c_custkey AS INTEGER) AS principal_and_interest,
           c_name AS agent_name, CASE WHEN c_custkey % 4 > 0 THEN '813-555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') ELSE 'N/A' END AS phone_number,
           c_custkey % 2 = 0 AS "Motivated", CASE WHEN c_custkey % 2 = 0 THEN 'Fixer Upper' END AS "Trigger Keyword", CASE WHEN c_custkey % 2 = 0 THEN 'fixer upper' END AS "Trigger Sentence",
           CASE WHEN c_custkey % 2 = 0 THEN substr('a fixer upper near the river.' || CASE WHEN c_custkey % 3 > 0 THEN ' est. $1,' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || ' per month' ELSE '' END, 1, 43) END AS "Trigger Context", 'https://h.example/' || c_custkey AS url,
           CASE WHEN c_custkey % 4 > 0 THEN 'saved' ELSE 'no_contact' END AS outcome
    FROM customer
""")
def listing_page_fields(spark, sf_dir):
    """Listing pages from markup to rows: old values in comments and scripts, rows within rows, references, missing fields."""
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    html = F.concat(
        F.lit("<html><!-- <div class='statsValue'>$1</div> --><script>var x = \"<div class='statsValue'>$2</div>\";</script><div class=top><div data-rf-test-id='abp-streetLine' title='a>b'>"),
        key, F.lit(" Main &amp; 1st St </div><div class='dp-subtext  bp-cityStateZip'>City "), nation, F.lit(", FL "), F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0"),
        F.lit("</div>"), F.when(F.col("c_custkey") % 5 > 0, F.concat(F.lit("<div class='statsValue'><span>$"), key, F.lit(",000</span></div>"))).otherwise(""),
        F.lit("<span class='agent-basic-details--heading'>Listed by <span>"), F.col("c_name"), F.lit("</span></span><div class='agent-contact'>Call&nbsp;now "),
        F.when(F.col("c_custkey") % 4 > 0, F.concat(F.lit("813-555-"), F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0"))).otherwise("none"),
        F.lit("</div><div class='Row'><span class='Row--header'>Principal and interest</span><div><span class='Row--content'>$"), key,
        F.lit(".75</span></div></div><div class='Row'><span>Property taxes</span> <b>$7,"), F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"),
        F.lit("</b></div><div class='Row'><span>HOA dues</span><span>$"), nation, F.lit("</span></div><div class='remarks'>A "),
        F.when(F.col("c_custkey") % 2 == 0, "fixer <b>upper</b>").otherwise("home"), F.lit(" near the river."),
        F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit(" Est. $1,"), F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"), F.lit(" per month"))).otherwise(""),
        F.lit("</div></div></html>"),
    )
    # A row group may hold all rows of so narrow a table: dealt anew before they grow to pages, they go to all cores.
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name").repartition(2 * spark.sparkContext.defaultParallelism)
    pages = rows.select("c_custkey", F.concat(F.lit("https://h.example/"), key).alias("page_url"), html.alias("html"))
    return extract.from_markup(pages, ["c_custkey"], "page_url", "html")

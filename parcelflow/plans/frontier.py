"""URL frontier queries. Order keys play URLs; two date ranges that cover the table play crawl passes."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelflow.functions import markup
from parcelflow.operators import dedup, frontier, rollup
from parcelflow.operators.skew import row_number
from parcelflow.plans.registry import query, table

CUT = "1998-06-01"

URLS_SQL = f"""
    keyed AS (SELECT 'https://listings.example/' || o_custkey || '/' || o_orderpriority AS url, o_orderdate,
                     o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders),
    processed AS (SELECT * FROM keyed WHERE o_orderdate < TIMESTAMP '{CUT}'),
    seen AS (SELECT * FROM keyed WHERE o_orderdate >= TIMESTAMP '{CUT}')
"""


def keyed_orders(spark, sf_dir):
    url = F.concat(
        F.lit("https://listings.example/"), F.col("o_custkey").cast("string"), F.lit("/"), "o_orderpriority"
    )
    return table(spark, sf_dir, "orders").withColumn("url", url)


def passes(spark, sf_dir):
    """(seen, processed): the later and the earlier orders."""
    keyed = keyed_orders(spark, sf_dir)
    cut = F.lit(CUT).cast("timestamp_ntz")
    return keyed.filter(F.col("o_orderdate") >= cut), keyed.filter(F.col("o_orderdate") < cut)


BIG_ORDERS_SQL = "SELECT o_custkey FROM orders WHERE o_totalprice > 480000"


def queue(spark, sf_dir):
    """(queued, processed) customers: all of them, and those with a big order."""
    queued = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("url"), "c_name")
    big = table(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 480000)
    return queued, big.select(F.col("o_custkey").alias("url"))


@query("anti_join_pending", f"""
    SELECT c_custkey AS url, c_name FROM customer c
    WHERE NOT EXISTS (SELECT 1 FROM ({BIG_ORDERS_SQL}) b WHERE b.o_custkey = c.c_custkey)
""")
def anti_join_pending(spark, sf_dir):
    return frontier.pending(*queue(spark, sf_dir))


@query("semi_join_known", f"SELECT c_custkey AS url, c_name FROM customer WHERE c_custkey IN ({BIG_ORDERS_SQL})")
def semi_join_known(spark, sf_dir):
    return frontier.known(*queue(spark, sf_dir))


@query("frontier_new", f"WITH {URLS_SQL} SELECT url FROM seen EXCEPT SELECT url FROM processed")
def frontier_new(spark, sf_dir):
    return frontier.new_keys(*passes(spark, sf_dir))


@query("frontier_missing", f"WITH {URLS_SQL} SELECT url FROM processed EXCEPT SELECT url FROM seen")
def frontier_missing(spark, sf_dir):
    return frontier.missing_keys(*passes(spark, sf_dir))


@query("frontier_known", f"WITH {URLS_SQL} SELECT url FROM processed INTERSECT SELECT url FROM seen")
def frontier_known(spark, sf_dir):
    return frontier.known_keys(*passes(spark, sf_dir))


@query("frontier_delta", f"""
    WITH {URLS_SQL}, p AS (SELECT DISTINCT url FROM processed), s AS (SELECT DISTINCT url FROM seen)
    SELECT coalesce(s.url, p.url) AS url,
           CASE WHEN s.url IS NULL THEN 'missing' WHEN p.url IS NULL THEN 'new' ELSE 'known' END AS delta
    FROM s FULL JOIN p ON s.url = p.url
""")
def frontier_delta(spark, sf_dir):
    return frontier.crawl_delta(*passes(spark, sf_dir))


@query("union_distinct_runs", """
    SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
    UNION SELECT o_custkey, o_orderpriority FROM orders
          WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
    UNION SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'
""")
def union_distinct_runs(spark, sf_dir):
    orders, at = table(spark, sf_dir, "orders"), F.col("o_orderdate")
    first, second = (F.lit(d).cast("timestamp_ntz") for d in ("1997-01-01", "1999-01-01"))
    runs = [orders.filter(at < first), orders.filter((at >= first) & (at < second)), orders.filter(at >= second)]
    return frontier.union_runs(*[r.select("o_custkey", "o_orderpriority") for r in runs])


UPSERT_COLUMNS = ["url", "o_orderstatus", "o_orderkey"]
STORED_SQL = """
    stored AS (SELECT url, o_orderstatus, o_orderkey FROM (
        SELECT *, row_number() OVER (PARTITION BY url ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM processed)
        WHERE rn = 1)
"""


def stored_and_batch(spark, sf_dir):
    """A stored table with one row per URL, and a batch in which URLs repeat."""
    seen, processed = passes(spark, sf_dir)
    stored = dedup.last_wins(
        processed.select(*UPSERT_COLUMNS, "o_orderdate"), ["url"], ["o_orderdate", "o_orderkey"]
    )
    return stored.select(*UPSERT_COLUMNS), seen.select(*UPSERT_COLUMNS)


@query("upsert_ignore", f"""
    WITH {URLS_SQL}, {STORED_SQL},
    fresh AS (SELECT url, o_orderstatus, o_orderkey FROM (
        SELECT *, row_number() OVER (PARTITION BY url ORDER BY o_orderkey) AS rn FROM seen) WHERE rn = 1)
    SELECT * FROM stored UNION ALL SELECT * FROM fresh WHERE url NOT IN (SELECT url FROM stored)
""")
def upsert_ignore(spark, sf_dir):
    return frontier.upsert_ignore(*stored_and_batch(spark, sf_dir), ["url"], ["o_orderkey"])


@query("upsert_replace", f"""
    WITH {URLS_SQL}, {STORED_SQL},
    fresh AS (SELECT url, o_orderstatus, o_orderkey FROM (
        SELECT *, row_number() OVER (PARTITION BY url ORDER BY o_orderkey DESC) AS rn FROM seen) WHERE rn = 1)
    SELECT * FROM fresh UNION ALL SELECT * FROM stored WHERE url NOT IN (SELECT url FROM fresh)
""")
def upsert_replace(spark, sf_dir):
    return frontier.upsert_replace(*stored_and_batch(spark, sf_dir), ["url"], ["o_orderkey"])


@query("state_transition", """
    SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
           THEN 'B' ELSE o_orderstatus END AS o_orderstatus
    FROM orders
""")
def state_transition(spark, sf_dir):
    moved = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return frontier.move_state(orders, moved.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "o_orderstatus", "B")


@query("advance_frontier", f"""
    WITH {URLS_SQL},
    s AS (SELECT url, min(o_orderstatus) AS location FROM seen GROUP BY url),
    p AS (SELECT url, max(o_orderstatus) AS location, min(o_orderdate) AS lo, max(o_orderdate) AS hi
          FROM processed GROUP BY url)
    SELECT coalesce(p.url, s.url) AS url, coalesce(p.location, s.location) AS location,
           CASE WHEN p.url IS NULL THEN 'pending' WHEN s.url IS NULL THEN 'missing' ELSE 'processed' END AS state,
           coalesce(strftime(p.lo, '%Y-%m-%d'), '2001-12-31') AS first_seen,
           CASE WHEN s.url IS NULL THEN strftime(p.hi, '%Y-%m-%d') ELSE '2001-12-31' END AS last_seen
    FROM p FULL JOIN s ON p.url = s.url
""")
def advance_frontier(spark, sf_dir):
    """One crawl pass over the state table: new, missing and known URLs in one shuffle."""
    seen, processed = passes(spark, sf_dir)
    state = processed.groupBy("url").agg(
        F.max("o_orderstatus").alias("location"), F.lit(frontier.PROCESSED).alias("state"), F.lit(0).alias("attempts"),
        F.min("o_orderdate").cast("date").alias("first_seen"), F.max("o_orderdate").cast("date").alias("last_seen"),
    )
    hits = seen.select("url", F.col("o_orderstatus").alias("location"))
    after = frontier.advance(state, hits, F.lit("2001-12-31").cast("date"))
    return after.select(
        "url", "location", "state", F.date_format("first_seen", "yyyy-MM-dd").alias("first_seen"),
        F.date_format("last_seen", "yyyy-MM-dd").alias("last_seen"),
    )


@query("record_outcomes", """
    WITH r AS (SELECT user_id, bool_or(event_type <> 'error') AS ok, count(*) FILTER (WHERE event_type = 'error') AS bad
               FROM events GROUP BY user_id),
    s AS (SELECT DISTINCT user_id FROM events)
    SELECT s.user_id AS url, CASE WHEN r.ok THEN 'processed' WHEN NOT r.ok AND bad >= 3 THEN 'failed' ELSE 'pending' END
           AS state, CAST(coalesce(bad, 0) AS INTEGER) AS attempts
    FROM s LEFT JOIN r ON s.user_id = r.user_id
""")
def record_outcomes(spark, sf_dir):
    """Results of an extraction pass: failed URLs keep a state of their own and a number of attempts."""
    events = table(spark, sf_dir, "events").withColumn("url", F.col("user_id"))
    day = F.lit("2024-01-01").cast("date")
    state = events.select("url").distinct().select(
        "url", F.lit("x").alias("location"), F.lit(frontier.PENDING).alias("state"), F.lit(0).alias("attempts"),
        day.alias("first_seen"), day.alias("last_seen"),
    )
    outcomes = events.select("url", (F.col("event_type") != "error").alias("success"))
    return frontier.record_outcomes(state, outcomes).select("url", "state", "attempts")


@query("first_pending", """
    SELECT o_orderkey, o_custkey FROM orders WHERE lower(trim(o_orderstatus)) <> 'f' ORDER BY o_orderkey LIMIT 1
""")
def first_pending(spark, sf_dir):
    work = table(spark, sf_dir, "orders")
    done = F.lower(F.trim("o_orderstatus")) == "f"
    return frontier.first_pending(work, done, ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("assign_batches", """
    SELECT o_orderkey, o_orderstatus,
           CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) // 5 AS BIGINT) AS batch
    FROM orders
""")
def assign_batches(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return rollup.batch_ids(orders, ["o_orderstatus"], ["o_orderkey"], 5)


@query("round_robin_bucket", """
    SELECT s_suppkey, CAST((row_number() OVER (ORDER BY s_suppkey) - 1) % 10 AS BIGINT) AS worker FROM supplier
""")
def round_robin_bucket(spark, sf_dir):
    return rollup.round_robin(table(spark, sf_dir, "supplier").select("s_suppkey"), ["s_suppkey"], 10)


@query("state_counts", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def state_counts(spark, sf_dir):
    return rollup.state_counts(table(spark, sf_dir, "orders"), "o_orderstatus")


@query("urls_per_group", r"""
    SELECT host, count(DISTINCT url) AS urls FROM (
        SELECT regexp_extract(url, '^[A-Za-z]+://([^/:?#]+)', 1) AS host, url FROM pages) GROUP BY host
    UNION ALL SELECT 'all hosts', count(DISTINCT url) FROM pages
""")
def urls_per_group(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("url", markup.url_host("url").alias("host"))
    total = pages.select(F.lit("all hosts").alias("host"), "url")
    return frontier.urls_per_group(pages.unionByName(total), "host")


@query("page_novelty", """
    WITH hits AS (SELECT DISTINCT l_linestatus, CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INTEGER) AS page, l_partkey
                  FROM lineitem),
    firsts AS (SELECT l_linestatus, l_partkey, min(page) AS page FROM hits GROUP BY ALL),
    counted AS (
        SELECT h.l_linestatus, h.page, count(*) AS urls, count(f.page) AS new_urls
        FROM hits h LEFT JOIN firsts f
          ON h.l_linestatus = f.l_linestatus AND h.l_partkey = f.l_partkey AND h.page = f.page
        GROUP BY h.l_linestatus, h.page),
    stops AS (SELECT l_linestatus, min(page) AS stop FROM counted WHERE new_urls = 0 GROUP BY l_linestatus)
    SELECT c.l_linestatus, c.page, urls, new_urls, coalesce(page = stop, false) AS stops_here
    FROM counted c LEFT JOIN stops s ON c.l_linestatus = s.l_linestatus
""")
def page_novelty(spark, sf_dir):
    month = (F.year("l_shipdate") * 12 + F.month("l_shipdate")).alias("page")
    hits = table(spark, sf_dir, "lineitem").select("l_linestatus", month, "l_partkey")
    return frontier.page_novelty(hits, "l_linestatus", "page", "l_partkey")


@query("failure_streaks_sliced", """
    WITH marked AS (
        SELECT user_id, event_type = 'error' AS failed,
               sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END)
                   OVER (PARTITION BY user_id ORDER BY date_trunc('minute', ts), -event_id) AS run
        FROM events),
    runs AS (SELECT user_id, run, count(*) AS length FROM marked WHERE failed GROUP BY user_id, run)
    SELECT user_id, CAST(sum(length) AS BIGINT) AS failures, count(*) AS streaks, max(length) AS longest
    FROM runs GROUP BY user_id
""")
def failure_streaks_sliced(spark, sf_dir):
    """The same on the path of hot keys, in an order that runs against the ids."""
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.date_trunc("minute", "ts").alias("minute"), (-F.col("event_id")).alias("newest")
    )
    return rollup.failure_streaks(events, "user_id", ["minute", "newest"], F.col("event_type") == "error", max_task_rows=1000)


@query("row_numbers_sliced", """
    SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, -event_id) AS rn,
           row_number() OVER (ORDER BY props, ts, -event_id) AS place
    FROM events
""")
def row_numbers_sliced(spark, sf_dir):
    """Places by sub-second time against the ids, per hot key and over the whole table, the latter led by a text."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "props", "ts", (-F.col("event_id")).alias("newest"))
    limit = {"max_task_rows": 1000}
    numbered = row_number(events, ["event_type"], ["ts", "newest"], "rn", **limit)
    return row_number(numbered, [], ["props", "ts", "newest"], "place", **limit).select("event_id", "rn", "place")


@query("failure_streaks", """
    WITH marked AS (
        SELECT user_id, event_type = 'error' AS failed,
               sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END)
                   OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run
        FROM events),
    runs AS (SELECT user_id, run, count(*) AS length FROM marked WHERE failed GROUP BY user_id, run)
    SELECT user_id, CAST(sum(length) AS BIGINT) AS failures, count(*) AS streaks, max(length) AS longest
    FROM runs GROUP BY user_id
""")
def failure_streaks(spark, sf_dir):
    return rollup.failure_streaks(
        table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error"
    )

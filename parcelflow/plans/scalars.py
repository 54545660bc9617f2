"""Scalar functions and filters on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelflow.functions import contact, locality, logs, markup, money, text
from parcelflow.operators.dedup import project_to_schema
from parcelflow.operators.metrics import add_offer_metrics
from parcelflow.plans.registry import query, table
from parcelflow.schemas import METRIC_COLUMNS

PHONE_SQL = r"""
    nullif(regexp_extract(text, '(\+[0-9]{1,3} )?\([0-9]{3}\) [0-9]{3}-[0-9]{4}', 0), '')
"""
PHONE_PATTERN = r"(\+[0-9]{1,3} )?\([0-9]{3}\) [0-9]{3}-[0-9]{4}"


def phone_in_text():
    """The first phone of a document's text; null without one."""
    return markup.first_match("text", PHONE_PATTERN, 0)


@query("normalize_key", r"""
    SELECT doc_id, md5(lower(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g'))) AS key_md5 FROM documents
""")
def normalize_key(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.normalize_key("text")).alias("key_md5"))


@query("sanitize_identifier", r"""
    SELECT p_partkey, regexp_replace(p_brand || ' / ' || p_type, '[^\p{L}\p{N}_]+', '_', 'g') AS identifier FROM part
""")
def sanitize_identifier(spark, sf_dir):
    name = F.concat("p_brand", F.lit(" / "), "p_type")
    return table(spark, sf_dir, "part").select("p_partkey", text.sanitize_identifier(name).alias("identifier"))


@query("location_slug", """
    SELECT DISTINCT replace(replace(p_name || ', ' || p_brand, ' ', '_'), ',', '_') AS slug FROM part
""")
def location_slug(spark, sf_dir):
    name = F.concat("p_name", F.lit(", "), "p_brand")
    return table(spark, sf_dir, "part").select(text.location_slug(name).alias("slug")).distinct()


@query("file_slug", """
    SELECT page_id, replace(replace(replace(replace(url, ' ', '_'), ',', ''), '/', ''), '|', '') AS slug FROM pages
""")
def file_slug(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.file_slug("url").alias("slug"))


@query("clean_numeric", """
    WITH raw AS (
        SELECT c_custkey, CASE
            WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 1000 THEN '—'
            WHEN c_mktsegment = 'FURNITURE' AND c_acctbal < 1000 THEN 'Not Found'
            WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 1000 THEN 'N/A'
            WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 1000 THEN 'call us'
            WHEN c_acctbal < 0 THEN ''
            ELSE ' $' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || ' ' END AS money_text
        FROM customer)
    SELECT c_custkey, coalesce(TRY_CAST(trim(translate(money_text, '$,', '')) AS DOUBLE), 0.0) AS amount FROM raw
""")
def clean_numeric(spark, sf_dir):
    segment, poor = F.col("c_mktsegment"), F.col("c_acctbal") < 1000
    money_text = (
        F.when((segment == "MACHINERY") & poor, "—")
        .when((segment == "FURNITURE") & poor, "Not Found")
        .when((segment == "BUILDING") & poor, "N/A")
        .when((segment == "HOUSEHOLD") & poor, "call us")
        .when(F.col("c_acctbal") < 0, "")
        .otherwise(F.concat(F.lit(" $"), money.money("c_acctbal").cast("string"), F.lit(" ")))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", money.clean_numeric(money_text).alias("amount"))


@query("round_money", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.75 AS DECIMAL(4,2)), 2) AS DOUBLE) AS cash_offer
    FROM lineitem
""")
def round_money(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        money.round_money("l_extendedprice", money.CASH_SHARE).cast("double").alias("cash_offer"),
    )


FORMAT_PHONE_SQL = """
    CASE WHEN length(d) = 10 THEN substr(d, 1, 3) || '-' || substr(d, 4, 3) || '-' || substr(d, 7)
         WHEN length(d) > 10 THEN '+' || substr(d, 1, length(d) - 10) || '-' || substr(d, length(d) - 9, 3)
              || '-' || substr(d, length(d) - 6, 3) || '-' || substr(d, length(d) - 3)
         ELSE 'N/A' END
"""


@query("format_phone", rf"""
    WITH phones AS (
        SELECT 'document' AS kind, doc_id AS id, regexp_replace({PHONE_SQL}, '[^0-9]', '', 'g') AS d FROM documents
        UNION ALL
        SELECT 'customer', c_custkey, regexp_replace(c_name || c_nationkey, '[^0-9]', '', 'g') FROM customer
        UNION ALL
        SELECT 'supplier', s_suppkey, '1' || regexp_replace(s_name || s_nationkey, '[^0-9]', '', 'g') FROM supplier)
    SELECT kind, id, {FORMAT_PHONE_SQL} AS phone FROM phones
""")
def format_phone(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), contact.format_phone(phone_in_text()).alias("phone")
    )
    customers = table(spark, sf_dir, "customer").select(
        F.lit("customer"), "c_custkey", contact.format_phone(F.concat("c_name", F.col("c_nationkey").cast("string")))
    )
    parts = F.array(F.lit("1"), F.col("s_name"), F.col("s_nationkey").cast("string"))
    suppliers = table(spark, sf_dir, "supplier").select(F.lit("supplier"), "s_suppkey", contact.join_phone_parts(parts))
    return docs.union(customers).union(suppliers)


@query("sentinel_to_null", """
    WITH raw AS (
        SELECT o_orderkey, o_orderstatus, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'Not found'
            WHEN '5-LOW' THEN ' N/A ' WHEN '1-URGENT' THEN '' ELSE o_orderpriority END AS p FROM orders)
    SELECT o_orderkey, CASE WHEN trim(p) IN ('', '—', 'N/A', 'Not found', 'not found', 'None', 'nan') THEN NULL
           ELSE p END AS priority,
           coalesce(CASE WHEN trim(p) IN ('', '—', 'N/A', 'Not found', 'not found', 'None', 'nan') THEN NULL
           ELSE p END, 'N/A') AS shown
    FROM raw
""")
def sentinel_to_null(spark, sf_dir):
    p = F.col("o_orderpriority")
    raw = (
        F.when(p == "4-NOT SPECIFIED", "Not found").when(p == "5-LOW", " N/A ").when(p == "1-URGENT", "").otherwise(p)
    )
    clean = text.sentinel_to_null(raw)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", clean.alias("priority"), F.coalesce(clean, F.lit(contact.MISSING)).alias("shown")
    )


PLACES_SQL = """
    SELECT s.s_suppkey, s.s_name, CASE WHEN n.n_regionkey = 4 THEN n.n_name
        ELSE ' ' || n.n_name || ', ' || r.r_name || ' ' || CAST(10000 + s.s_suppkey AS VARCHAR) END AS locality
    FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def places(spark, sf_dir):
    """Suppliers with a locality line; those of one region lack state and ZIP."""
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    line = F.concat(
        F.lit(" "), "n_name", F.lit(", "), "r_name", F.lit(" "), (F.col("s_suppkey") + 10000).cast("string")
    )
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select("s_suppkey", "s_name", F.when(F.col("n_regionkey") == 4, F.col("n_name")).otherwise(line).alias("locality"))
    )


@query("split_locality", f"""
    WITH p AS ({PLACES_SQL}),
    cut AS (SELECT s_suppkey, string_split(trim(locality), ',') AS a FROM p),
    tail AS (SELECT s_suppkey, a, string_split(trim(a[2]), ' ') AS b FROM cut)
    SELECT s_suppkey, CASE WHEN len(a) > 1 THEN trim(a[1]) ELSE 'Not found' END AS city,
           CASE WHEN len(a) > 1 THEN b[1] ELSE 'Not found' END AS state,
           CASE WHEN len(a) > 1 THEN b[2] ELSE 'Not found' END AS zip_code
    FROM tail
""")
def split_locality(spark, sf_dir):
    return places(spark, sf_dir).select("s_suppkey", locality.split_locality("locality").alias("p")).select(
        "s_suppkey", "p.*"
    )


@query("format_address_line", f"""
    SELECT s_suppkey, trim(s_name) || ', ' || trim(locality) AS line FROM ({PLACES_SQL})
""")
def format_address_line(spark, sf_dir):
    return places(spark, sf_dir).select("s_suppkey", locality.address_line("s_name", "locality").alias("line"))


@query("last_token", "SELECT p_partkey, list_extract(string_split(trim(p_name), ' '), -1) AS token FROM part")
def last_token(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.last_token("p_name").alias("token"))


@query("url_replace_fragment", """
    SELECT page_id, split_part(url, '#', 1) || '#climate-section' AS url FROM pages
""")
def url_replace_fragment(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.replace_fragment("url", "climate-section").alias("url"))


@query("build_page_urls", """
    SELECT s_suppkey, page, 'https://listings.example/zipcode/' || trim(' ' || CAST(10000 + s_suppkey AS VARCHAR) || ' ')
           || '/filter/status=active/page-' || CAST(page AS VARCHAR) AS url
    FROM supplier, (SELECT unnest(range(1, 4)) AS page)
""")
def build_page_urls(spark, sf_dir):
    zips = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.concat(F.lit(" "), (F.col("s_suppkey") + 10000).cast("string"), F.lit(" ")).alias("zip_code"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(3).cast("bigint"))).alias("page"),
    )
    url = text.page_url(F.lit("https://listings.example/zipcode/"), "zip_code", F.lit("/filter/status=active"), "page")
    return zips.select("s_suppkey", "page", url.alias("url"))


@query("stamp_as_of", """
    SELECT o_orderkey, '2024-08-31' AS as_of_date, '2024-08-31T12:00:00' AS as_of_ts,
           CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2024-08-31') AS BIGINT) AS age_days
    FROM orders
""")
def stamp_as_of(spark, sf_dir):
    """The time of a run is an argument, so a repeated run gives the same rows."""
    as_of = F.to_timestamp_ntz(F.lit("2024-08-31 12:00:00"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format(as_of, "yyyy-MM-dd").alias("as_of_date"),
        F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss").alias("as_of_ts"),
        F.datediff(as_of.cast("date"), F.col("o_orderdate").cast("date")).cast("bigint").alias("age_days"),
    )


@query("case_and_trim", """
    SELECT c_custkey, upper(trim('  ' || c_name || ' ')) AS upper_name, lower(c_mktsegment) AS segment,
           upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS title
    FROM customer
""")
def case_and_trim(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.upper(F.trim(F.concat(F.lit("  "), "c_name", F.lit(" ")))).alias("upper_name"),
        F.lower("c_mktsegment").alias("segment"),
        F.initcap("c_mktsegment").alias("title"),
    )


@query("composite_key", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_orderkey || '_' || l_partkey || '_'
           || coalesce(CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END, '') || '_' || l_linenumber AS key
    FROM lineitem
""")
def composite_key(spark, sf_dir):
    flag = F.when(F.col("l_returnflag") == "N", None).otherwise(F.col("l_returnflag"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        text.composite_key("l_orderkey", "l_partkey", flag, "l_linenumber").alias("key"),
    )


@query("parse_log_lines", """
    WITH lines AS (
        SELECT event_id, CASE WHEN event_type = 'signup' THEN 'no log line ' || props
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || ' - '
            || CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARNING' ELSE 'INFO' END
            || ' - user ' || user_id || ' - ' || props END AS line
        FROM events)
    SELECT event_id,
           nullif(regexp_extract(line, '^(\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}) - ([A-Z]+) - (.*)$', 1), '') AS ts,
           nullif(regexp_extract(line, '^(\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}) - ([A-Z]+) - (.*)$', 2), '') AS level,
           nullif(regexp_extract(line, '^(\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}) - ([A-Z]+) - (.*)$', 3), '') AS message
    FROM lines
""".replace("\\\\", "\\"))
def parse_log_lines(spark, sf_dir):
    kind = F.col("event_type")
    level = F.when(kind == "error", "ERROR").when(kind == "purchase", "WARNING").otherwise("INFO")
    line = F.when(kind == "signup", F.concat(F.lit("no log line "), "props")).otherwise(
        F.concat(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" - "), level, F.lit(" - user "),
            F.col("user_id").cast("string"), F.lit(" - "), "props",
        )
    )
    parsed = table(spark, sf_dir, "events").select("event_id", logs.parse_log_line(line).alias("l"))
    return parsed.select(
        "event_id", F.date_format("l.ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "l.level", "l.message"
    )


@query("elapsed_between_events", """
    SELECT user_id, CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS BIGINT) AS elapsed_us FROM events GROUP BY user_id
""")
def elapsed_between_events(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts")).alias("elapsed_us")
    )


@query("offer_metrics", """
    WITH x AS (
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
            CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
            CASE WHEN l_returnflag = 'R' THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(round(CAST(l_extendedprice AS DECIMAL(18,2))
                 * CAST(0.08 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) END AS rent,
            CAST(l_quantity AS DECIMAL(18,2)) AS insurance,
            CAST(l_linenumber * 10 AS DECIMAL(18,2)) AS taxes, CAST(l_suppkey AS DECIMAL(18,2)) AS hoa
        FROM lineitem),
    f AS (
        SELECT *, CASE WHEN rent > 0 THEN CAST(round(rent * CAST(0.10 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2))
                       ELSE CAST(0 AS DECIMAL(18,2)) END AS management_fee,
                  CASE WHEN rent > 0 THEN CAST(round(rent * CAST(0.05 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2))
                       ELSE CAST(0 AS DECIMAL(18,2)) END AS capex_fee
        FROM x),
    m AS (
        SELECT *, CASE WHEN rent > 0 THEN CAST(rent - (350 + insurance + taxes + management_fee + capex_fee + capex_fee)
                       AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS payment
        FROM f)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
           CAST(management_fee AS DOUBLE) AS management_fee, CAST(capex_fee AS DOUBLE) AS capex_fee,
           CAST(capex_fee AS DOUBLE) AS vacancy_fee, CAST(payment AS DOUBLE) AS monthly_creative_payments,
           CASE WHEN rent > 0 THEN CAST(round(price * CAST(0.10 AS DECIMAL(4,2)), 2) AS DOUBLE) ELSE 0.0 END AS downpayment,
           CAST(round(price * CAST(0.75 AS DECIMAL(4,2)), 2) AS DOUBLE) AS cash_offer,
           CAST(hoa AS DOUBLE) AS hoa_fee,
           CASE WHEN payment > 0 THEN greatest(0, CAST((CAST(price * 100 AS HUGEINT) * 20
                + CAST(payment * 100 AS HUGEINT) * 100 - 1) // (CAST(payment * 100 AS HUGEINT) * 100) AS BIGINT)) ELSE 0 END
                AS term_length_months
    FROM m
""")
def offer_metrics(spark, sf_dir):
    price = money.money("l_extendedprice")
    rent = F.when(F.col("l_returnflag") == "R", F.lit(0).cast(money.MONEY_TYPE)).otherwise(money.share_of(price, "0.08"))
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    listings = table(spark, sf_dir, "lineitem").select(
        *ids, price.alias("price"), rent.alias("rent"), money.money("l_quantity").alias("insurance"),
        money.money(F.col("l_linenumber") * 10).alias("property_taxes"), money.money("l_suppkey").alias("hoa_fee"),
    )
    priced = add_offer_metrics(listings)
    return priced.select(
        *ids, *[F.col(c).cast("double").alias(c) for c in METRIC_COLUMNS if c != "term_length_months"],
        "term_length_months",
    )


@query("term_length", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN payment > 0 THEN
           CAST((price * 20 + payment * 100 - 1) // (payment * 100) AS BIGINT) ELSE 0 END AS months
    FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS HUGEINT) AS price,
                 CAST(CAST(l_quantity - 5 AS DECIMAL(18,2)) * 100 AS HUGEINT) AS payment FROM lineitem)
""")
def term_length(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        money.term_length("l_extendedprice", F.col("l_quantity") - 5).alias("months"),
    )


@query("project_to_schema", """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment, CAST(NULL AS VARCHAR) AS phone_number, c_name,
           c_acctbal FROM customer
""")
def project_to_declared(spark, sf_dir):
    from pyspark.sql import types as T

    declared = T.StructType([
        T.StructField("c_custkey", T.StringType()), T.StructField("c_mktsegment", T.StringType()),
        T.StructField("phone_number", T.StringType()), T.StructField("c_name", T.StringType()),
        T.StructField("c_acctbal", T.DoubleType()),
    ])
    return project_to_schema(table(spark, sf_dir, "customer"), declared)


@query("filter_valid_text", """
    SELECT doc_id FROM documents WHERE regexp_matches(text, '[0-9]') AND NOT contains(lower(text), 'license')
""")
def filter_valid_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter(contact.valid_address("text", "license")).select("doc_id")


@query("filter_url_blocklist", "SELECT page_id, url FROM pages WHERE NOT contains(lower(url), 'page=')")
def filter_url_blocklist(spark, sf_dir):
    return table(spark, sf_dir, "pages").filter(~text.contains_ci("url", "Page=")).select("page_id", "url")


@query("filter_has_contact", rf"""
    WITH p AS (SELECT doc_id, regexp_replace({PHONE_SQL}, '[^0-9]', '', 'g') AS d FROM documents),
    f AS (SELECT doc_id, {FORMAT_PHONE_SQL} AS phone FROM p)
    SELECT doc_id, phone FROM f WHERE phone IS NOT NULL AND phone <> 'N/A'
""")
def filter_has_contact(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", contact.format_phone(phone_in_text()).alias("phone"))
    return docs.filter(contact.has_contact("phone"))


@query("filter_by_state", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'
""")
def filter_by_state(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.filter((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT")).select(
        "o_orderkey", "o_custkey"
    )


@query("lookup_contains", """
    SELECT c.c_custkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE r.r_name = upper('asia') AND contains(lower(n.n_name), lower('Nation_1'))
""")
def lookup_contains(spark, sf_dir):
    """Customers of one region whose nation name contains a text, taken literally."""
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    wanted = nation.join(region, nation.n_regionkey == region.r_regionkey).filter(
        (F.col("r_name") == F.upper(F.lit("asia"))) & text.contains_ci("n_name", "Nation_1")
    )
    return customer.join(wanted, customer.c_nationkey == wanted.n_nationkey).select("c_custkey", "n_name")


@query("filter_exclude_any", """
    SELECT doc_id FROM documents WHERE NOT (contains(text, 'license') OR contains(text, 'free')
        OR contains(text, '555-') OR contains(text, '$$$') OR contains(text, 'http://') OR contains(text, '|'))
""")
def filter_exclude_any(spark, sf_dir):
    noise = logs.is_noise("text", ["license", "free", "555-", "$$$", "http://", "|"])
    return table(spark, sf_dir, "documents").filter(~noise).select("doc_id")


@query("filter_level_below", """
    SELECT event_id, event_type FROM events
    WHERE CASE event_type WHEN 'error' THEN 40 WHEN 'purchase' THEN 30 WHEN 'click' THEN 10 ELSE 20 END < 30
""")
def filter_level_below(spark, sf_dir):
    kind = F.col("event_type")
    level = F.when(kind == "error", "ERROR").when(kind == "purchase", "WARNING").when(kind == "click", "DEBUG").otherwise("INFO")
    return table(spark, sf_dir, "events").filter(logs.level_below(level, "WARNING")).select("event_id", "event_type")


@query("flag_missing_contact", rf"""
    WITH p AS (SELECT doc_id, regexp_replace({PHONE_SQL}, '[^0-9]', '', 'g') AS d FROM documents),
    f AS (SELECT doc_id, {FORMAT_PHONE_SQL} AS phone FROM p)
    SELECT doc_id, coalesce(phone, 'N/A') = 'N/A' AS expired,
           CASE WHEN coalesce(phone, 'N/A') = 'N/A'
                THEN substr(sha256(CAST(doc_id AS VARCHAR)), 1, 32) || '@example.com' END AS email
    FROM f
""")
def flag_missing_contact(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", contact.format_phone(phone_in_text()).alias("phone"))
    return docs.select(
        "doc_id", (~contact.has_contact("phone")).alias("expired"),
        contact.contact_or_placeholder("phone", "doc_id").alias("email"),
    )


@query("contact_line", """
    SELECT s_suppkey, concat_ws(', ', s_name, concat_ws(' ', CASE WHEN s_suppkey % 3 > 0 THEN n_name END, 'FL', CAST(10000 + s_nationkey AS VARCHAR))) AS line
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def contact_line(spark, sf_dir):
    """The line of a contact roll-up: every part trimmed of all blanks, missing parts left out."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    rows = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    return rows.select("s_suppkey", locality.contact_line(
        F.concat(F.lit("\t"), "s_name", F.lit("\xa0 ")), F.when(F.col("s_suppkey") % 3 > 0, F.concat("n_name", F.lit("\r"))), F.lit(" FL\u3000"),
        F.col("s_nationkey") + 10000,
    ).alias("line"))


@query("clean_money", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount FROM orders
""")
def clean_money(spark, sf_dir):
    """Money texts with signs, blanks of all kinds and sentinels, exact to the cent."""
    exact = money.money("o_totalprice").cast("string")
    written = F.when(F.col("o_orderkey") % 5 == 0, "N/A\r").otherwise(F.concat(F.lit("\xa0$"), F.regexp_replace(exact, r"([0-9]{3})\.", r",$1."), F.lit("\t\r")))
    return table(spark, sf_dir, "orders").select("o_orderkey", money.clean_money(written).cast("double").alias("amount"))

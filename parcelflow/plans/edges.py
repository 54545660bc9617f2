"""Sources and sinks: whole tables go out through a sink and come back through a source."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from parcelflow.functions.text import normalize_key
from parcelflow.operators import dedup, documents, enrich
from parcelflow.plans.registry import query, table
from parcelflow.schemas import POSTAL, PROVIDER_COLUMNS
from parcelflow.session import workdir
from parcelflow.sources import readers, writers

ORDER_CSV = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
])


@query("scan_csv_dir", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def scan_csv_dir(spark, sf_dir):
    """A folder of CSV files with a URL export among them, which the scan leaves out."""
    base = workdir(spark, "scan_csv_dir")
    orders = table(spark, sf_dir, "orders")
    writers.write_csv(orders.select(*ORDER_CSV.fieldNames()), f"{base}/orders.csv")
    urls = orders.select(F.concat(F.lit("https://listings.example/"), F.col("o_orderkey").cast("string")).alias("url"))
    writers.export_urls(urls, f"{base}/{readers.URL_EXPORT}")
    return readers.scan_csv_dir(spark, base, ORDER_CSV)


@query("explode_list_column", """
    SELECT p_partkey, trim(unnest(string_split(replace(p_name, ' ', ' , ') || ',' || p_type || ', ' || p_brand, ','))) AS item
    FROM part
""")
def explode_list_column(spark, sf_dir):
    """A comma list with uneven blanks in one field, one row per element."""
    listed = F.concat(
        F.replace(F.col("p_name"), F.lit(" "), F.lit(" , ")), F.lit(","), "p_type", F.lit(", "), "p_brand"
    )
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(readers.split_list(listed)).alias("item"))


@query("parse_kv_records", """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, 'see: ' || c_mktsegment AS note,
           CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS BIGINT) AS bad_lines
    FROM customer
""")
def parse_kv_records(spark, sf_dir):
    """'key: value' records written and read back; a value may hold the separator, a line may lack it."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, F.concat("c_name", F.lit("\nno separator here"))).otherwise(F.col("c_name")).alias("c_name"),
        F.concat(F.lit("see: "), "c_mktsegment").alias("note"),
    )
    path = writers.save_kv_records(rows, workdir(spark, "parse_kv_records"), ["c_custkey", "c_name", "note"])
    return readers.scan_kv_records(spark, path, ["c_custkey", "c_name", "note"], writers.RECORD_SEPARATOR)


@query("json_field_extract", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def json_field_extract(spark, sf_dir):
    kind = T.StructType([T.StructField("k", T.LongType())])
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", kind)["k"].alias("k"))


DOCUMENT_RECORD = T.StructType([T.StructField("address", T.StringType()), T.StructField("status", T.StringType())])


@query("document_json_round_trip", """
    SELECT CAST(o_custkey AS VARCHAR) AS agent,
           'Address ' || row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS label,
           CAST(o_orderkey AS VARCHAR) AS address, o_orderstatus AS status
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
    WHERE rn <= 15
""")
def document_json_round_trip(spark, sf_dir):
    """Nested documents saved as JSON and read back to flat rows."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    capped = dedup.top_per_group(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 15)
    named = capped.select(
        "o_custkey", "o_orderdate", "o_orderkey", F.col("o_orderkey").cast("string").alias("address"),
        F.col("o_orderstatus").alias("status"),
    )
    path = writers.save_documents_json(
        named, workdir(spark, "document_json"), "o_custkey", ["o_orderdate", "o_orderkey"], ["address", "status"]
    )
    return readers.scan_documents_json(spark, path, DOCUMENT_RECORD)


LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]


@query("append_dedup", """
    WITH stored AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-06-01'),
    batch AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey
              ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS rn
              FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-06-01')
    SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM stored
    UNION ALL
    SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM batch b
    WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM stored s WHERE s.l_partkey = b.l_partkey AND s.l_suppkey = b.l_suppkey)
""")
def append_dedup(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", *LINE_ORDER)
    cut = F.lit("1998-06-01").cast("timestamp_ntz")
    stored, batch = lines.filter(F.col("l_shipdate") < cut), lines.filter(F.col("l_shipdate") >= cut)
    return dedup.append_dedup(stored, batch, ["l_partkey", "l_suppkey"], LINE_ORDER).drop("l_shipdate")


@query("union_all_append", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def union_all_append(spark, sf_dir):
    """Two batches appended to one table, without any dedup."""
    path = f"{workdir(spark, 'append')}/orders"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    writers.append(orders.filter("o_totalprice < 250000"), path)
    writers.append(orders.filter("o_totalprice >= 250000"), path)
    return spark.read.parquet(path)


@query("csv_round_trip", """
    SELECT c_custkey, c_name, CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment || ', "checked"' AS note FROM customer
""")
def csv_round_trip(spark, sf_dir):
    """A CSV table rewritten in place: the new version is derived from the one it replaces."""
    base = workdir(spark, "csv_round_trip")
    schema = T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
        T.StructField("c_acctbal", T.DoubleType()), T.StructField("note", T.StringType()),
    ])
    raw = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_acctbal", F.concat("c_mktsegment", F.lit(', "raw"')).alias("note")
    )
    writers.write_csv(raw, f"{base}/in")
    writers.publish(spark.read.schema(schema).options(header=True, escape='"').csv(f"{base}/in"), f"{base}/table")
    now = writers.current(spark, f"{base}/table")
    writers.publish(now.withColumn("note", F.replace("note", F.lit("raw"), F.lit("checked"))), f"{base}/table")
    return writers.current(spark, f"{base}/table")


@query("export_distinct_urls", "SELECT DISTINCT split_part(url, '#', 1) AS URL FROM pages")
def export_distinct_urls(spark, sf_dir):
    path = f"{workdir(spark, 'export_urls')}/{readers.URL_EXPORT}"
    pages = table(spark, sf_dir, "pages").select(F.substring_index("url", "#", 1).alias("url"))
    writers.export_urls(pages, path)
    return spark.read.schema("URL string").options(header=True, escape='"').csv(path)


@query("union_by_name_distinct", """
    SELECT p_brand, p_type, p_size, CAST(NULL AS DOUBLE) AS p_retailprice FROM part
    UNION SELECT p_brand, p_type, CAST(NULL AS INTEGER), p_retailprice FROM part
""")
def union_by_name_distinct(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return dedup.union_by_name_distinct(
        part.select("p_brand", "p_type", "p_size"), part.select("p_retailprice", "p_brand", "p_type")
    )


@query("rollup_table_merge", """
    SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL
    UNION SELECT o_custkey, o_orderstatus, count(*) FROM orders WHERE o_orderdate < TIMESTAMP '1998-06-01' GROUP BY ALL
""")
def rollup_table_merge(spark, sf_dir):
    """A roll-up saved twice: the second save keeps old rows and drops whole-row duplicates."""
    base = workdir(spark, "rollup_table")
    orders = table(spark, sf_dir, "orders")
    early = orders.filter(F.col("o_orderdate") < F.lit("1998-06-01").cast("timestamp_ntz"))
    for frame in (early, orders):
        writers.save_contact_rollup(
            frame.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n")), base
        )
    return writers.current(spark, base)


@query("document_json_uncapped", """
    SELECT CAST(o_custkey AS VARCHAR) AS agent, CAST(o_orderkey AS VARCHAR) AS address,
           'Address ' || row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS label
    FROM orders
""")
def document_json_uncapped(spark, sf_dir):
    """A sink writes what it gets: without a cap before it, every listing of an agent."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", F.col("o_orderkey").cast("string").alias("address"))
    path = writers.save_documents_json(rows, workdir(spark, "document_json_all"), "o_custkey", ["o_orderdate", "o_orderkey"], ["address"])
    return readers.scan_documents_json(spark, path, T.StructType([T.StructField("address", T.StringType())]))


@query("flatten_documents", """
    SELECT o_custkey, 'Address ' || row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS label,
           o_orderkey, o_orderstatus FROM orders WHERE o_custkey IS NOT NULL
""")
def flatten_documents(spark, sf_dir):
    """Nested and flattened again: every row comes back under its label."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    nested = documents.nest(orders, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderstatus"])
    return documents.flatten(nested, "o_custkey")


@query("scan_work_list", """
    SELECT p_brand || ', no. ' || p_partkey AS location, z AS zip_code, p_size > 25 AS completed
    FROM part, (SELECT unnest(range(0, 3)) AS i) t, LATERAL (SELECT CAST((p_partkey * 7 + i * 13) % 90000 + 10000 AS VARCHAR) AS z) v
""")
def scan_work_list(spark, sf_dir):
    """A work list as CSV: a quoted list of ZIPs with uneven blanks, and a flag in any case."""
    zips = [F.format_string("%05d", ((F.col("p_partkey") * 7 + i * 13) % 90000 + 10000).cast("bigint")) for i in range(3)]
    rows = table(spark, sf_dir, "part").select(
        F.concat("p_brand", F.lit(", no. "), F.col("p_partkey").cast("string")).alias("Location"),
        F.concat(zips[0], F.lit(" ,\t"), zips[1], F.lit(",, "), zips[2], F.lit(" , ")).alias("ZipCodes"),
        F.when(F.col("p_size") > 40, " YES\t").when(F.col("p_size") > 25, "yes").when(F.col("p_size") > 10, "no").alias("Completed"),
    )
    path = f"{workdir(spark, 'work_list')}/list"
    writers.write_csv(rows, path)
    return readers.scan_work_list(spark, path).select("location", F.explode("zip_codes").alias("zip_code"), "completed")


@query("scan_comma_list", """
    SELECT CAST(s_suppkey + 10000 AS VARCHAR) AS zip_code FROM supplier
    UNION ALL SELECT lpad(CAST(s_nationkey AS VARCHAR), 5, '0') FROM supplier
""")
def scan_comma_list(spark, sf_dir):
    """Text lines of ZIPs; leading zeros stay, blanks and empty parts go."""
    path = f"{workdir(spark, 'comma_list')}/zips"
    line = F.concat(F.lit(" "), (F.col("s_suppkey") + 10000).cast("string"), F.lit("\t,,  "), F.lpad(F.col("s_nationkey").cast("string"), 5, "0"), F.lit(" ,"))
    table(spark, sf_dir, "supplier").select(line.alias("value")).write.text(path)
    return readers.scan_comma_list(spark, path)


@query("scan_lexicon", """
    WITH types AS (SELECT DISTINCT p_brand, p_type FROM part)
    SELECT CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS priority, p_brand AS keyword,
           CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_type) - 1 AS INTEGER) AS synonym_pos, p_type AS synonym
    FROM types
""")
def scan_lexicon(spark, sf_dir):
    """A lexicon of brands and their types, saved as configuration and read in its order."""
    path = f"{workdir(spark, 'lexicon')}/config"
    synonyms = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_sort(F.collect_set("p_type")).alias("t"))
    entries = F.array_sort(F.collect_list(F.struct("p_brand", "t")))
    synonyms.agg(F.to_json(F.struct(F.lit(1).alias("version"), F.map_from_entries(entries).alias("keywords"))).alias("value")).write.text(path)
    return readers.scan_lexicon(spark, f"{path}/*.txt")


@query("scan_postal_reference", """
    WITH postal AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS zip, max(n_name) AS county FROM nation GROUP BY 1)
    SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip, coalesce(county, 'Unknown') AS county
    FROM customer LEFT JOIN postal ON zip = lpad(CAST(c_nationkey AS VARCHAR), 5, '0')
""")
def scan_postal_reference(spark, sf_dir):
    """The postal table saved with repeated ZIPs, read back, and reduced to one row per ZIP for the lookup."""
    path = f"{workdir(spark, 'postal')}/table"
    nation = table(spark, sf_dir, "nation")
    zip_code = F.lpad(F.col("n_nationkey").cast("string"), 5, "0")
    fields = [zip_code.alias("postal_code"), F.col("n_name").alias("county_name"), F.lit("x").alias("state_name"), F.lit("XX").alias("state_code")]
    older = nation.select(*fields).withColumn("county_name", F.concat(F.lit("A former "), "county_name"))
    older.unionByName(nation.select(*fields)).select(*POSTAL.fieldNames()).write.parquet(path)
    postal = readers.scan_postal_reference(spark, path)
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("zip"))
    return enrich.zip_to_county(customer, postal, ("zip", "postal_code"), "county_name")


@query("scan_url_state", """
    SELECT 'https://listings.example/' || o_orderkey AS url, CAST(o_orderkey % 4 AS INTEGER) AS attempts
    FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'
""")
def scan_url_state(spark, sf_dir):
    """The URL state table by location and state."""
    path = f"{workdir(spark, 'url_state')}/table"
    day = F.col("o_orderdate").cast("date")
    table(spark, sf_dir, "orders").select(
        F.concat(F.lit("https://listings.example/"), F.col("o_orderkey").cast("string")).alias("url"), F.col("o_orderpriority").alias("location"),
        F.col("o_orderstatus").alias("state"), (F.col("o_orderkey") % 4).cast("int").alias("attempts"), day.alias("first_seen"), day.alias("last_seen"),
    ).write.parquet(path)
    return readers.scan_url_state(spark, path, "1-URGENT", "P").select("url", "attempts")


def _provider_values() -> list[tuple[str, str]]:
    """(provider column, value in SQL): what stands in each of the columns that enrichment copies."""
    return [(c, f"p_type || ' {i} ' || (p_size + {i})") for i, c in enumerate(PROVIDER_COLUMNS)]


def raw_lines(df, path: str) -> None:
    """Lines as they are, in files named as CSV."""
    df.write.options(sep="\x01", quote="\x02", escape="\x02").csv(path)


@query("provider_files_to_listings", f"""
    WITH listing AS (SELECT p_partkey, p_brand AS county FROM part)
    SELECT l.p_partkey, l.county, p_size % 3 > 0 AS matched, {", ".join(f'CASE WHEN p_size % 3 > 0 THEN {v} END AS "{c}"' for c, v in _provider_values())}
    FROM listing l JOIN part ON l.p_partkey = part.p_partkey
""")
def provider_files_to_listings(spark, sf_dir):
    """Provider files with broken lines among them, read, indexed, and all their columns joined to the listings."""
    base, part = workdir(spark, "provider"), table(spark, sf_dir, "part")
    address = F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string"))
    known = part.filter("p_size % 3 > 0")
    rows = known.select(
        F.concat(F.lit("\t"), "p_brand", F.lit(" ")).alias("County"), address.alias("Address"), *[F.expr(v).alias(c) for c, v in _provider_values()]
    )
    writers.write_csv(rows, f"{base}/good.csv")
    raw_lines(known.select(F.concat("p_brand", F.lit(",broken,"), "p_type")), f"{base}/bad.csv")
    provider = readers.scan_provider_csv(spark, f"{base}/*.csv")
    index = enrich.provider_index(provider, "County", "Address", ["load_seq"])
    listings = part.select("p_partkey", F.col("p_brand").alias("county"), normalize_key(F.upper(address)).alias("addr_key"))
    return enrich.enrich(listings, index, PROVIDER_COLUMNS).drop("addr_key")


@query("bad_lines", """
    SELECT 'documents' AS source, count(*) FILTER (WHERE c_custkey % 7 = 0) AS bad, count(*) FILTER (WHERE c_custkey % 7 <> 0) AS good FROM customer
    UNION ALL SELECT 'logs', count(*) FILTER (WHERE c_custkey % 5 = 0), count(*) FILTER (WHERE c_custkey % 5 <> 0) FROM customer
    UNION ALL SELECT 'provider', count(*) FILTER (WHERE c_custkey % 3 = 0), count(*) FILTER (WHERE c_custkey % 3 <> 0) FROM customer
""")
def bad_lines(spark, sf_dir):
    """Lines that a reader cannot take are told, not lost."""
    base, customer, key = workdir(spark, "bad_lines"), table(spark, sf_dir, "customer"), F.col("c_custkey").cast("string")

    def saved(name: str, line) -> str:
        raw_lines(customer.select(line), f"{base}/{name}")
        return f"{base}/{name}"

    docs = saved("documents", F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit('{"'), "c_name", F.lit('": {'))).otherwise(
        F.concat(F.lit('{"'), key, F.lit('": {"Address 1": {"address": "'), "c_name", F.lit('"}}}'))))
    logs = saved("logs", F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("  at "), "c_name")).otherwise(
        F.concat(F.lit("2024-08-01 10:00:00 - INFO - "), "c_name")))
    provider = saved("provider.csv", F.when(F.col("c_custkey") % 3 == 0, F.concat("c_name", F.lit(",1,2,3,4"))).otherwise(
        F.concat(F.lit("Lake,"), "c_name", F.lit(",5"))))
    record = T.StructType([T.StructField("address", T.StringType())])
    short = T.StructType([T.StructField(c, T.StringType()) for c in ("County", "Address", "Year Built")])
    found = [
        ("documents", readers.scan_documents_json(spark, docs, record, bad="bad")), ("logs", readers.scan_log_lines(spark, logs, bad="bad")),
        ("provider", readers.scan_provider_csv(spark, provider, short, bad="bad", header=False)),
    ]
    counts = [
        df.agg(F.count("bad").alias("bad"), F.count_if(F.col("bad").isNull() & F.col(df.columns[1]).isNotNull()).alias("good")).select(F.lit(name).alias("source"), "bad", "good")
        for name, df in found
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("retained_and_archived", """
    SELECT c_mktsegment, CAST(v AS INTEGER) AS version, CASE WHEN v > 2 THEN 'kept' ELSE 'archived' END AS place, count(*) AS n
    FROM customer, (SELECT unnest(range(1, 6)) AS v) t GROUP BY ALL
""".replace("GROUP BY ALL", "GROUP BY c_mktsegment, v"))
def retained_and_archived(spark, sf_dir):
    """Five versions of a table: the newest three stay, the older two are moved, and all can be read."""
    base = workdir(spark, "retained")
    segments = table(spark, sf_dir, "customer").select("c_mktsegment")
    for version in range(1, 6):
        writers.publish(segments.withColumn("version", F.lit(version)), f"{base}/table")
    moved = writers.archive_old(spark, f"{base}/table", f"{base}/archive")
    kept = writers.retained(spark, f"{base}/table")
    both = [spark.read.parquet(p).withColumn("place", F.lit(place)) for place, paths in (("archived", moved), ("kept", kept)) for p in paths]
    every = both[0]
    for df in both[1:]:
        every = every.unionByName(df)
    return every.groupBy("c_mktsegment", "version", "place").agg(F.count(F.lit(1)).alias("n"))

"""Field extraction from pages and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelflow.functions import lexicon, markup, text
from parcelflow.operators import extract
from parcelflow.plans.registry import query, table
from parcelflow.session import workdir
from parcelflow.sources import readers

# The listing lexicon, led by words that occur in the test texts.
TEXT_LEXICON: lexicon.Lexicon = {
    "License": ["license", "licence"],
    "Free": ["free", "no charge"],
    **lexicon.LISTING_LEXICON,
}


def _lexicon_values(lex: lexicon.Lexicon) -> str:
    return ", ".join(
        "({}, '{}', {}, '{}')".format(i, k.replace("'", "''"), j, s.replace("'", "''"))
        for i, k, j, s in lexicon.lexicon_rows(lex)
    )


LEXICON_SQL = f"lex(priority, keyword, synonym_pos, synonym) AS (VALUES {_lexicon_values(TEXT_LEXICON)})"


def texts(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@query("keyword_theta_join", f"""
    WITH {LEXICON_SQL}
    SELECT doc_id, CAST(priority AS INTEGER) AS priority, keyword, CAST(synonym_pos AS INTEGER) AS synonym_pos, synonym
    FROM documents JOIN lex ON contains(lower(text), synonym)
""")
def keyword_theta_join(spark, sf_dir):
    """All (text, synonym) hits, found in one pass over each text; only hits become rows."""
    hits = texts(spark, sf_dir).select("doc_id", F.explode(lexicon.keyword_hits("text", TEXT_LEXICON)).alias("h"))
    return hits.select("doc_id", "h.priority", "h.keyword", "h.synonym_pos", "h.synonym")


@query("first_keyword_match", f"""
    WITH {LEXICON_SQL},
    ranked AS (
        SELECT doc_id, keyword, synonym, row_number() OVER (PARTITION BY doc_id ORDER BY priority, synonym_pos) AS rn
        FROM documents JOIN lex ON contains(lower(text), synonym))
    SELECT doc_id, keyword, synonym FROM ranked WHERE rn = 1
""")
def first_keyword_match(spark, sf_dir):
    """Misses go by exploding an empty array: a filter on the result would search each text twice."""
    found = F.array_compact(F.array(lexicon.first_keyword("text", TEXT_LEXICON)))
    return texts(spark, sf_dir).select("doc_id", F.explode(found).alias("m")).select("doc_id", "m.keyword", "m.synonym")


@query("keyword_match_scanned", """
    WITH lex AS (
        SELECT CAST(dense_rank() OVER (ORDER BY r_name) - 1 AS INTEGER) AS priority, r_name AS keyword,
               CAST(row_number() OVER (PARTITION BY r_name ORDER BY n_name) - 1 AS INTEGER) AS synonym_pos, lower(substr(n_name, 1, 4)) AS synonym
        FROM nation JOIN region ON n_regionkey = r_regionkey)
    SELECT doc_id, priority, keyword, synonym_pos, synonym FROM documents JOIN lex ON contains(lower(text), synonym)
""")
def keyword_match_scanned(spark, sf_dir):
    """A lexicon that is not in the code: regions and the beginnings of their nations' names, saved as configuration, scanned and searched."""
    names = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    synonyms = names.groupBy("r_name").agg(F.transform(F.array_sort(F.collect_list("n_name")), lambda n: F.substring(n, 1, 4)).alias("s"))
    entries = F.array_sort(F.collect_list(F.struct("r_name", "s")))
    path = f"{workdir(spark, 'lexicon')}/config"
    synonyms.agg(F.to_json(F.struct(F.map_from_entries(entries).alias("keywords"))).alias("value")).write.text(path)
    scanned = lexicon.lexicon_of(readers.scan_lexicon(spark, f"{path}/*.txt"))
    hits = texts(spark, sf_dir).select("doc_id", F.explode(lexicon.keyword_hits("text", scanned)).alias("h"))
    return hits.select("doc_id", "h.priority", "h.keyword", "h.synonym_pos", "h.synonym")


@query("keyword_context", """
    WITH x AS (SELECT doc_id, lower(text) AS t, strpos(lower(text), 'free') AS p FROM documents)
    SELECT doc_id, substr(t, greatest(1, p - 30), p + 4 + 30 - greatest(1, p - 30)) AS context FROM x WHERE p > 0
""")
def keyword_context(spark, sf_dir):
    found = texts(spark, sf_dir).select("doc_id", text.keyword_context("text", "Free").alias("context"))
    return found.filter("context IS NOT NULL")


@query("keyword_occurrences", """
    WITH x AS (SELECT doc_id, string_split(lower(text), 'free') AS a FROM documents),
    hits AS (SELECT doc_id, a, len(a) - 1 AS n, unnest(range(1, len(a))) AS i FROM x)
    SELECT doc_id, CAST(n AS BIGINT) AS occurrences, CAST(i AS BIGINT) AS hit,
           right(array_to_string(a[greatest(1, i - 30):i], 'free'), 30) || 'free'
           || left(array_to_string(a[i + 1:i + 31], 'free'), 30) AS context
    FROM hits
""")
def keyword_occurrences(spark, sf_dir):
    docs = texts(spark, sf_dir).select(
        "doc_id", text.keyword_count("text", "free").alias("occurrences"),
        F.posexplode(text.keyword_contexts("text", "free")).alias("hit", "context"),
    )
    return docs.select("doc_id", "occurrences", (F.col("hit") + 1).cast("bigint").alias("hit"), "context")


@query("extract_labelled_amounts", r"""
    WITH x AS (
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
            'Principal and Interest $ ' || CAST(CAST(floor(l_extendedprice / 1000) AS BIGINT) AS VARCHAR) || ','
            || lpad(CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0') || '.50 property taxes $'
            || CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR)
            || CASE WHEN l_returnflag = 'N' THEN ' no dues' ELSE ' HOA dues  $7' END
            || ' Est. $1,' || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || ' per month' AS t
        FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
        TRY_CAST(replace(regexp_extract(t, '(?i)Principal and interest\s*[$]\s*([0-9,]+)', 1), ',', '') AS INTEGER)
            AS principal_and_interest,
        TRY_CAST(replace(regexp_extract(t, '(?i)Property taxes\s*[$]\s*([0-9,]+)', 1), ',', '') AS INTEGER)
            AS property_taxes,
        TRY_CAST(replace(regexp_extract(t, '(?i)HOA dues\s*[$]\s*([0-9,]+)', 1), ',', '') AS INTEGER) AS hoa_dues,
        TRY_CAST(replace(regexp_extract(t, '(?i)Homeowners insurance\s*[$]\s*([0-9,]+)', 1), ',', '') AS INTEGER)
            AS homeowners_insurance,
        TRY_CAST(replace(regexp_extract(t, '(?i)Est\.\s*[$]?([0-9,]+)\s*per month', 1), ',', '') AS INTEGER) AS rent
    FROM x
""")
def extract_labelled_amounts(spark, sf_dir):
    dollars = F.floor("l_extendedprice")
    rendered = F.concat(
        F.lit("Principal and Interest $ "), F.floor(F.col("l_extendedprice") / 1000).cast("string"), F.lit(","),
        F.lpad((dollars % 1000).cast("string"), 3, "0"), F.lit(".50 property taxes $"),
        F.floor("l_quantity").cast("string"),
        F.when(F.col("l_returnflag") == "N", " no dues").otherwise(" HOA dues  $7"),
        F.lit(" Est. $1,"), F.lpad(F.col("l_linenumber").cast("string"), 3, "0"), F.lit(" per month"),
    )
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(*ids, rendered.alias("t")).select(
        *ids,
        *[markup.labelled_amount("t", label).alias(label.lower().replace(" ", "_")) for label in markup.COST_LABELS],
        markup.rent_amount("t").alias("rent"),
    )


@query("url_host", r"""
    SELECT page_id, regexp_extract(url, '^[A-Za-z]+://([^/:?#]+)', 1) AS host FROM pages
""")
def url_host(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", markup.url_host("url").alias("host"))


def element_sql(tag: str, closing: str | None = None) -> str:
    """Text of the first element, by splitting at its tags; the pages hold these references only."""
    inner = f"split_part(list_extract(string_split(html, '<{tag}>'), 2), '</{closing or tag}>', 1)"
    plain = f"list_reduce(list_transform(string_split({inner}, '<'), lambda x, i: CASE WHEN i = 1 THEN x ELSE substr(x, strpos(x, '>') + 1) END), lambda x, y: x || y)"
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        plain = f"replace({plain}, '&{name};', '{char}')"
    return f"nullif(trim({plain}), '')"


@query("extract_links", """
    WITH parts AS (SELECT page_id, url, string_split(html, '<a href="') AS p FROM pages),
    raw AS (SELECT page_id, url, i - 2 AS pos, replace(split_part(p[i], '"', 1), '&amp;', '&') AS link
            FROM (SELECT page_id, url, p, unnest(range(2, len(p) + 1)) AS i FROM parts)),
    whole AS (SELECT page_id, pos, split_part(url, '/', 1) || '//' || split_part(split_part(split_part(url, '/', 3), '?', 1), '#', 1) || link AS href FROM raw)
    SELECT page_id, CAST(pos AS BIGINT) AS pos, href FROM whole WHERE NOT contains(lower(href), '/the') AND NOT contains(lower(href), 'casino')
""")
def extract_links(spark, sf_dir):
    """Links of every page as absolute URLs, without those on the block list."""
    found = table(spark, sf_dir, "pages").select("page_id", "url", F.posexplode(markup.links("html")).alias("pos", "link"))
    whole = found.select("page_id", F.col("pos").cast("bigint").alias("pos"), markup.absolute_link("link", "url").alias("href"))
    return whole.filter(~text.contains_any(F.lower("href"), ["/the", "casino"]))


@query("extract_tag_text", f"SELECT page_id, {element_sql('title')} AS title, {element_sql('h1')} AS heading FROM pages")
def extract_tag_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", markup.tag_text("html", "title").alias("title"), markup.tag_text("html", "h1").alias("heading")
    )


@query("extract_with_fallback", f"""
    SELECT page_id, coalesce({element_sql('h2')}, {element_sql('footer')}, {element_sql('h1')}, 'N/A') AS value FROM pages
""")
def extract_with_fallback(spark, sf_dir):
    strategies = [markup.tag_text("html", tag) for tag in ("h2", "footer", "h1")]
    return table(spark, sf_dir, "pages").select("page_id", markup.first_of(*strategies).alias("value"))


@query("motivated_status", f"""
    WITH {LEXICON_SQL},
    ranked AS (
        SELECT doc_id, keyword, synonym, row_number() OVER (PARTITION BY doc_id ORDER BY priority, synonym_pos) AS rn,
               lower(text) AS t, strpos(lower(text), synonym) AS p
        FROM documents JOIN lex ON contains(lower(text), synonym)),
    hit AS (SELECT doc_id, keyword, substr(t, greatest(1, p - 30), p + length(synonym) + 30 - greatest(1, p - 30)) AS context
            FROM ranked WHERE rn = 1)
    SELECT d.doc_id, h.doc_id IS NOT NULL AS motivated, keyword, context,
           NOT (contains(context, 'not') OR contains(context, 'never') OR contains(context, 'ideal')) AS plain
    FROM documents d LEFT JOIN hit h ON d.doc_id = h.doc_id
""")
def motivated_status(spark, sf_dir):
    """Every text with its first keyword, the context of it, and whether the context speaks against it."""
    found = texts(spark, sf_dir).select("doc_id", lexicon.motivated_status("text", TEXT_LEXICON).alias("m"))
    return found.select(
        "doc_id", "m.motivated", "m.keyword", "m.context",
        lexicon.plain_context("m.context", ["not", "never", "ideal"]).alias("plain"),
    )


@query("extract_listing_fields", rf"""
    WITH {LEXICON_SQL},
    cut AS (
        SELECT page_id, url, html, {element_sql('h1')} AS street, {element_sql('footer')} AS agent_name,
            split_part(split_part(split_part(url, '/', 3), '?', 1), '#', 1) AS city, regexp_extract(url, '/([a-z][a-z])/', 1) AS state,
            nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS zip_code, len(string_split(html, '<p>')) - 1 AS paragraphs,
            len(string_split(html, '<a ')) - 1 AS anchors
        FROM pages),
    ranked AS (
        SELECT page_id, keyword, lower(html) AS t, synonym, strpos(lower(html), synonym) AS p,
               row_number() OVER (PARTITION BY page_id ORDER BY priority, synonym_pos) AS rn
        FROM pages JOIN lex ON contains(lower(html), synonym)),
    hit AS (SELECT page_id, keyword, synonym, substr(t, greatest(1, p - 30), p + length(synonym) + 30 - greatest(1, p - 30)) AS context
            FROM ranked WHERE rn = 1),
    listed AS (
        SELECT c.page_id, street || ', ' || city || ', ' || trim(state || ' ' || coalesce(zip_code, '')) AS address, city, state, zip_code,
               CASE WHEN paragraphs % 5 = 0 THEN NULL ELSE '$' || paragraphs || ',000' END AS price, CAST(length(html) AS INTEGER) AS rent,
               CAST(anchors AS INTEGER) AS hoa_fee, CAST(paragraphs AS INTEGER) AS property_taxes, agent_name,
               CASE WHEN contains(url, 'page=') THEN 'N/A' ELSE '813-555-' || lpad(CAST(length(html) % 10000 AS VARCHAR), 4, '0') END AS phone_number,
               keyword IS NOT NULL AS "Motivated", keyword AS "Trigger Keyword", synonym AS "Trigger Sentence", context AS "Trigger Context", url
        FROM cut c LEFT JOIN hit h ON c.page_id = h.page_id)
    SELECT *, CAST(NULL AS INTEGER) AS insurance, property_taxes * 1000 + hoa_fee AS principal_and_interest,
           CASE WHEN NOT coalesce(regexp_matches(address, '[0-9]') AND NOT contains(lower(address), 'undisclosed address'), false)
                THEN 'invalid_address' WHEN phone_number = 'N/A' THEN 'no_contact' ELSE 'saved' END AS outcome
    FROM listed
""")
def extract_listing_fields(spark, sf_dir):
    """Pages to listing rows: all listing columns, cut from the page, and what became of the page.

    The pages name no prices and phones, so their numbers of paragraphs, links and characters are written out as such.
    """
    pages = table(spark, sf_dir, "pages").withColumns({
        "paragraphs": F.regexp_count("html", F.lit("<p>")), "anchors": F.regexp_count("html", F.lit("<a ")), "size": F.length("html"),
    })
    place = F.concat(
        markup.url_host("url"), F.lit(", "), F.regexp_extract("url", "/([a-z][a-z])/", 1), F.lit(" "), F.regexp_extract("url", "/([0-9]+)", 1)
    )
    price = F.when(F.col("paragraphs") % 5 == 0, "N/A\r").otherwise(F.concat(F.lit("\t$"), F.col("paragraphs").cast("string"), F.lit(",000 ")))
    phone = F.concat(F.lit("Call 813-555-"), F.lpad((F.col("size") % 10000).cast("string"), 4, "0"), F.lit("\xa0"))
    number = lambda c, width=1: F.lpad(F.col(c).cast("string"), width, "0")
    costs = F.concat(
        F.lit("Est. $"), F.col("size").cast("string"), F.lit(" per month. Principal and interest $ "), F.col("paragraphs").cast("string"),
        F.lit(","), number("anchors", 3), F.lit(".25 HOA dues $"), F.col("anchors").cast("string"), F.lit(" Property taxes\n$"),
        F.col("paragraphs").cast("string"), F.lit(" no insurance"),
    )
    rows = extract.listing_fields(
        pages, ["page_id"], F.col("url"), markup.tag_text("html", "h1"), place, price, markup.tag_text("html", "footer"),
        F.when(F.col("url").contains("page="), "No phone").otherwise(phone), F.col("html"), costs, TEXT_LEXICON,
    )
    return rows.withColumn("zip_code", F.nullif("zip_code", F.lit("")))

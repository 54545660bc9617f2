"""One query per operator, on its whole table, and SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelflow.llm import bitplanes, bpe, crf, cuckoo, licenses, mixing, simhash, tiles, tokenfile, toxicity, trie, urlfilter, warc
from parcelflow.llm.common import table


def op1_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return crf.scored(docs, crf.fit(docs, table(spark, sf_dir, "labels")))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo.exact_dedup(table(spark, sf_dir, "documents"))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), bpe.default_ranks())


#: The rules of the query: verdict, host and path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([(host, path, verdict) for verdict, host, path in RULES], urlfilter.RULE_SCHEMA)
    return urlfilter.judge(table(spark, sf_dir, "pages"), rules)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, sf_dir, "documents"))


def op10_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.near_dedup(table(spark, sf_dir, "embeddings"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op12_toxic_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op13_bitplane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.cluster(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_line_quality, op2_license_scan, op3_cuckoo_dedup, op4_simhash_dedup, op5_source_mix, op6_bpe_transducer,
    op7_url_rules, op8_token_files, op9_embedding_dedup, op10_warc_round_trip,
    op11_prefix_trie, op12_toxic_clauses, op13_bitplane_clusters,
)}

_HOST_PATH = """
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)
"""

def _cluster_rounds(k: int, rounds: int) -> str:
    """Assignments a0, a1, ... and centroids c1, c2, ... from the centroids c0."""
    parts = []
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
            SELECT x.n, min(CAST(list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS HUGEINT) * {k} + c.k) AS best
            FROM kept x, c{r} c GROUP BY x.n
        )""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
            SELECT c.k, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
                SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
                    SELECT best % {k} AS k, i, sum(v[i]) AS s, count(*) AS n
                    FROM kept JOIN a{r} USING (n), (SELECT unnest(range(1, 65)) AS i) GROUP BY ALL
                ) GROUP BY k
            ) m ON m.k = c.k
        )""")
    return ",\n        ".join(parts)


SQL: dict[str, str] = {
    "op3_cuckoo_dedup": r"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
        )
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
    "op7_url_rules": f"""
        WITH u AS (SELECT row_number() OVER () AS n, * FROM ({_HOST_PATH})),
        r AS (SELECT * FROM (VALUES {", ".join(str((v, h, p)) for v, h, p in RULES)}) AS t (verdict, rule_host, rule_path)),
        fit AS (
            SELECT n, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                   max_by(verdict, length(rule_host || rule_path)) AS verdict
            FROM u JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY n
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN fit USING (n)
    """,
    "op9_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        ),
        fit AS (
            SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(e, lambda x: x <> 0)) > 0
        ),
        link AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.93
        ),
        reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
        least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
        n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM v JOIN least ON least.a = vec_id LEFT JOIN n ON n.a = vec_id
    """,
    "op10_warc_round_trip": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
        ),
        d AS (
            SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY h) AS last,
                   array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
                       substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, CAST(1 + 5 * i AS INTEGER), 5) AS BIGINT) >> s) & 31 AS INTEGER) + 1, 1)), '')), '') AS payload_digest
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> last THEN last END AS refers_to
        FROM d
    """,
    "op11_prefix_trie": """
        WITH own AS (
            SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
                   sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS dig, length(coalesce(text, '')) AS chars
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        convs AS (
            SELECT DISTINCT c, c - c % 100 AS first, xor(list_reduce(range(0, 8 * length(CAST(c AS VARCHAR))), lambda crc, k: xor(
                xor(crc, CASE WHEN k % 8 = 0 THEN ascii(substr(CAST(c AS VARCHAR), CAST(k // 8 + 1 AS INTEGER), 1)) ELSE 0 END) >> 1,
                (xor(crc, CASE WHEN k % 8 = 0 THEN ascii(substr(CAST(c AS VARCHAR), CAST(k // 8 + 1 AS INTEGER), 1)) ELSE 0 END) & 1) * 3988292384
            ), CAST(4294967295 AS BIGINT)), 4294967295) % 6 AS h FROM own
        ),
        rebuilt AS (
            SELECT v.c, list({'dig': o.dig, 'chars': o.chars} ORDER BY o.c <> v.first OR o.i > h, o.i) FILTER (o.c IS NOT NULL) AS turns
            FROM convs v LEFT JOIN own o ON (o.c = v.first AND o.i <= h) OR (o.c = v.c AND o.i > h) GROUP BY v.c
        ),
        prefix AS (
            SELECT c, turns[1:d] AS path, coalesce(len(turns), 0) = d AS ended
            FROM (SELECT c, coalesce(turns, []) AS turns, unnest(range(0, coalesce(len(turns), 0) + 1)) AS d FROM rebuilt)
        ),
        node AS MATERIALIZED (
            SELECT path, len(path) AS depth, min(c) AS conv_id, count(*) AS n,
                   sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ended), '')) AS ends_sha256
            FROM prefix GROUP BY path
        ),
        kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
        up AS (
            SELECT path[1:a] AS path, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM (
                SELECT path, CAST(n_children IS NULL AS BIGINT) AS leaf, CASE WHEN depth = 0 THEN 0 ELSE (n - 1) * path[depth].chars END AS saved, unnest(range(0, depth + 1)) AS a
                FROM node LEFT JOIN kids USING (path)
            ) GROUP BY 1
        )
        SELECT x.conv_id, x.depth, p.conv_id AS parent_conv_id, x.n AS n_convs, coalesce(n_children, 0) AS n_children,
               CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, x.ends_sha256
        FROM node x JOIN up USING (path) LEFT JOIN kids USING (path) LEFT JOIN node p ON x.depth > 0 AND p.path = x.path[1:x.depth - 1]
    """,
    "op13_bitplane_clusters": f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        c0 AS MATERIALIZED (
            SELECT k, v FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS k, v FROM kept) WHERE k < 16
        ),
        {_cluster_rounds(16, 3)}
        SELECT vec_id, CAST(best % 16 AS INTEGER) AS cluster, CAST(best // 16 AS BIGINT) AS distance,
               CAST(sum(best // 16) OVER (PARTITION BY best % 16) AS BIGINT) AS cluster_inertia, CAST(sum(best // 16) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c3.v, ',')) AS centroid_sha256
        FROM kept JOIN a3 USING (n) JOIN c3 ON c3.k = best % 16
    """,
}

"""URL rules behind a blocked Bloom filter.

A rule is a host and a path; it fits its host and all subdomains where the URL's path starts with the
rule's. The keys that a URL can be listed under are its host's ends, each with the starts of its path that are
as long as some rule's path. The filter passes the keys that may be listed, and an exact join with the
rules takes out what it passed wrongly. The longest rule decides.

The filter has blocks of 512 bits; a key sets one bit in each of the eight words of one block. Its bits
are made by tasks and combined per block. It has at most ``MAX_BLOCKS`` blocks (32 MB), so it can be sent to
all executors whatever the number of rules; a longer list makes more false hits and the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from xxhash import xxh3_128_intdigest

WORDS = 8
MAX_BLOCKS = 1 << 19
KEYS_PER_BLOCK = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE_SCHEMA = "host string, path string, verdict string"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path; both empty for a null URL or one without ``://``."""
    # What follows the first "://", which need not be the last one.
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _bits(key: str, blocks: int) -> tuple[int, list[int]]:
    """The block of a key, and the one bit that it sets in each word."""
    h = xxh3_128_intdigest(key)
    return (h >> 64) % blocks, [1 << (h >> 6 * i & 63) for i in range(WORDS)]


class BlockedBloom:
    def __init__(self, blocks: int):
        self.words = np.zeros((blocks, WORDS), np.uint64)

    def __contains__(self, key: str) -> bool:
        block, bits = _bits(key, len(self.words))
        return all(int(word) & bit for word, bit in zip(self.words[block], bits, strict=True))


def bloom(keys: DataFrame, max_blocks: int = MAX_BLOCKS) -> BlockedBloom:
    """The filter of the column ``key``; tasks make the bits, Spark combines them per block."""
    blocks = min(max_blocks, max(1, -(-keys.count() // KEYS_PER_BLOCK)))
    names = [f"w{i}" for i in range(WORDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_bits(k.as_py(), blocks) for k in batch.column("key")]
            words = np.array([b for _, b in found], np.uint64).reshape(-1, WORDS).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in found], pa.int32()), *(pa.array(words[:, i]) for i in range(WORDS))], ["block", *names]
            )

    bits = keys.mapInArrow(run, "block int, " + ", ".join(f"{n} bigint" for n in names))
    rows = bits.groupBy("block").agg(*[F.bit_or(n).alias(n) for n in names]).collect()  # at most max_blocks rows
    out = BlockedBloom(blocks)
    for row in rows:
        out.words[row["block"]] = np.array(row[1:], np.int64).view(np.uint64)
    return out


def keys_of(host: str, path: str, lengths: list[int]) -> Iterator[str]:
    """All rules that would fit, as host and path in one string."""
    starts = [path[:n] for n in lengths if n <= len(path)]
    while host:
        for start in starts:
            yield host + start
        host = host.partition(".")[2]


def _possible(filter_: object, lengths: list[int]):
    """Adds the keys that the filter passes, and a number that parts the rows of this run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found, number = filter_.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            hits = [
                [k for k in keys_of(host.as_py(), path.as_py(), lengths) if k in found]
                for host, path in zip(batch.column("host"), batch.column("path"), strict=True)
            ]
            row = pa.array(np.arange(number, number + batch.num_rows), pa.int64())
            number += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, row, pa.array(hits, pa.list_(pa.string()))], [*batch.schema.names, "row", "hits"]
            )

    return run


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url",
          max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """(id_col, host, path, rule, verdict) for every row of ``pages``.

    ``rules`` has (host, path, verdict); of rules with equal host and path the smallest verdict counts, and rows
    with a null are left out. Of two fitting rules of equal length the one with the longer host wins. A URL
    without a fitting rule has a null rule and the ``default`` verdict, as have null URLs and URLs without
    ``://``. Repeated rows are judged alike, each on its own.
    """
    spark: SparkSession = pages.sparkSession
    host, path = host_and_path(F.col(url_col).cast("string"))
    listed = rules.filter("host is not null and path is not null and verdict is not null").groupBy("host", "path").agg(
        F.min("verdict").alias("ruled")
    ).select(F.concat("host", "path").alias("key"), F.length("host").alias("host_length"), "ruled")
    # Paths begin with a slash and hosts hold none, so a key names one rule.
    lengths = sorted(r[0] for r in rules.filter("path is not null").select(F.length("path")).distinct().collect())
    sent = spark.sparkContext.broadcast(bloom(listed.select("key"), max_blocks))
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), host.alias("host"), path.alias("path")).mapInArrow(
        _possible(sent, lengths), "page_id bigint, host string, path string, row bigint, hits array<string>"
    )
    clear = rows.filter("size(hits) = 0").select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    best = F.max(F.when(F.col("ruled").isNotNull(), F.struct(F.length("key"), "host_length", F.col("key"), F.col("ruled")))).alias("best")
    checked = (
        rows.filter("size(hits) > 0").select("page_id", "host", "path", "row", F.explode("hits").alias("key"))
        .join(listed, "key", "left").groupBy("row", "page_id", "host", "path").agg(best)
        .select("page_id", "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.ruled", F.lit(default)).alias("verdict"))
    )
    return clear.unionByName(checked).withColumnRenamed("page_id", id_col)

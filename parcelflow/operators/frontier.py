"""The URL frontier: which URLs are new, missing, known, pending or done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelflow.operators.dedup import last_wins
from parcelflow.schemas import URL_STATE

PENDING, PROCESSED, FAILED, MISSING = "pending", "processed", "failed", "missing"


def pending(queued: DataFrame, processed: DataFrame, key: str = "url") -> DataFrame:
    """Queued rows that are not processed; a null among the processed hides nothing."""
    return queued.join(processed.select(key).distinct(), key, "left_anti")


def known(queued: DataFrame, processed: DataFrame, key: str = "url") -> DataFrame:
    return queued.join(processed.select(key).distinct(), key, "left_semi")


def new_keys(seen: DataFrame, processed: DataFrame, key: str = "url") -> DataFrame:
    return seen.select(key).distinct().join(processed.select(key).distinct(), key, "left_anti")


#: Bits of a key bitmap: 32,768 bits to a row of 4 KB, 8 MB in all.
BITMAP_ROWS = 2048
BITS_PER_ROW = 1 << 15


def _bit(key: Column, rows: int) -> Column:
    """The bit of a key, from 1, as Spark's bitmap functions count."""
    return F.pmod(F.xxhash64(key), F.lit(rows * BITS_PER_ROW)) + 1


def key_bitmap(df: DataFrame, key: str = "url", rows: int = BITMAP_ROWS) -> DataFrame:
    """(bitmap_no, bits): the keys of a table as set bits, ``rows`` rows of 4 KB at most; combines on the map side.

    Bitmaps of several batches of keys are one after ``merged_bitmaps``, so a bitmap can be kept beside a table and grows with it.
    Its size does not depend on the table's; with as many keys as bits two thirds of the bits are set.
    """
    bit = _bit(F.col(key), rows)
    keys = df.filter(F.col(key).isNotNull())
    return keys.groupBy(F.bitmap_bucket_number(bit).alias("bitmap_no")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))


def merged_bitmaps(*bitmaps: DataFrame) -> DataFrame:
    every = bitmaps[0]
    for more in bitmaps[1:]:
        every = every.unionByName(more)
    return every.groupBy("bitmap_no").agg(F.bitmap_or_agg("bits").alias("bits"))


def with_possible(df: DataFrame, bitmap: DataFrame, key: str = "url", out: str = "possible", rows: int = BITMAP_ROWS) -> DataFrame:
    """``df`` plus ``out``: whether the bitmap may hold the key. False is certain, also for a null key.

    ``rows`` is that of the bitmap. The bitmap has at most ``rows`` rows of 4 KB, which the hint on it relies on.
    """
    if rows > BITMAP_ROWS:
        raise ValueError(f"a bitmap of more than {BITMAP_ROWS} rows is not sent to every task")
    bit = _bit(F.col(key), rows)
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    side = F.broadcast(bitmap.select(F.col("bitmap_no").alias("_no"), F.col("bits").alias("_bits")))
    joined = df.withColumn("_want", F.bitmap_bucket_number(bit)).join(side, F.col("_want") == F.col("_no"), "left")
    hit = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return joined.select(*[df[c] for c in df.columns], hit.alias(out))


def new_keys_by_bitmap(seen: DataFrame, processed: DataFrame, key: str = "url", rows: int = BITMAP_ROWS, bitmap: DataFrame | None = None) -> DataFrame:
    """``new_keys`` where one pass sees few keys of a large table: most processed keys never reach the shuffle.

    A bitmap of the seen keys clears the processed ones that cannot be among them, on the side of the scan. With ``bitmap``, the one kept
    beside the processed table, seen keys that it does not hold are new without a look at the table. What is left goes through the exact anti join.
    """
    keys = seen.select(key).distinct()
    among = with_possible(processed.select(key), key_bitmap(seen, key, rows), key, "_maybe", rows).filter("_maybe").select(key).distinct()
    if bitmap is None:
        return keys.join(among, key, "left_anti")
    told = with_possible(keys, bitmap, key, "_maybe", rows)
    sure = told.filter("NOT _maybe").select(key)
    return sure.unionByName(told.filter("_maybe").select(key).join(among, key, "left_anti"))


def missing_keys(seen: DataFrame, processed: DataFrame, key: str = "url") -> DataFrame:
    return new_keys(processed, seen, key)


def known_keys(seen: DataFrame, processed: DataFrame, key: str = "url") -> DataFrame:
    return seen.select(key).intersect(processed.select(key))


def crawl_delta(seen: DataFrame, processed: DataFrame, key: str = "url") -> DataFrame:
    """New, missing and known keys in one pass and one shuffle."""
    both = seen.select(key, F.lit(1).alias("_seen")).unionByName(processed.select(key, F.lit(0).alias("_seen")))
    return both.groupBy(key).agg(F.max("_seen").alias("_s"), F.min("_seen").alias("_p")).select(
        key,
        F.when(F.col("_s") == 0, MISSING).when(F.col("_p") == 1, "new").otherwise("known").alias("delta"),
    )


def union_runs(*runs: DataFrame) -> DataFrame:
    """Distinct rows of several crawl passes."""
    out = runs[0]
    for run in runs[1:]:
        out = out.unionByName(run)
    return out.distinct()


def upsert_ignore(stored: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The stored row stays on a conflict; among new rows of one key the first wins."""
    tagged = stored.withColumn("_src", F.lit(1)).unionByName(batch.withColumn("_src", F.lit(0)))
    rest = [c for c in stored.columns if c not in keys]
    best = tagged.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(-F.col("_src"), *order)).alias("_r"))
    return best.select(*keys, *[F.col("_r").getField(c).alias(c) for c in rest]).select(*stored.columns)


def upsert_replace(stored: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The new row wins on a conflict; among new rows of one key the last wins."""
    tagged = stored.withColumn("_src", F.lit(0)).unionByName(batch.withColumn("_src", F.lit(1)))
    return last_wins(tagged, keys, ["_src", *order]).select(*stored.columns)


def move_state(table: DataFrame, moved: DataFrame, key: str, state: str, to: str) -> DataFrame:
    """Rows whose key is in ``moved`` change to state ``to``; the others keep theirs."""
    hits = moved.select(F.col(key).alias("_k")).distinct()
    joined = table.join(hits, table[key] == hits["_k"], "left")
    changed = F.when(F.col("_k").isNotNull(), F.lit(to)).otherwise(F.col(state))
    return joined.select(*[changed.alias(c) if c == state else F.col(c) for c in table.columns])


def advance(state: DataFrame, seen: DataFrame, as_of: Column) -> DataFrame:
    """One crawl pass over the state table (``URL_STATE``), with one shuffle by URL.

    ``seen`` has (url, location). A URL not seen before becomes pending; a processed URL not
    seen in this pass becomes missing and stays so until a pass sees it again.
    """
    old = state.select(*URL_STATE.fieldNames(), F.lit(0).alias("_seen"))
    now = seen.select(
        "url", "location", F.lit(PENDING).alias("state"), F.lit(0).alias("attempts"),
        as_of.alias("first_seen"), as_of.alias("last_seen"), F.lit(1).alias("_seen"),
    )
    g = old.unionByName(now).groupBy("url").agg(
        F.max(F.when(F.col("_seen") == 0, F.col("state"))).alias("old_state"),
        F.max(F.when(F.col("_seen") == 0, F.col("attempts"))).alias("attempts"),
        F.max(F.when(F.col("_seen") == 0, F.col("location"))).alias("old_location"),
        F.min(F.when(F.col("_seen") == 1, F.col("location"))).alias("new_location"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.max("_seen").alias("_seen"),
    )
    old_state, was_seen = F.col("old_state"), F.col("_seen") == 1
    return g.select(
        "url",
        F.coalesce("old_location", "new_location").alias("location"),
        F.when(old_state.isNull(), PENDING)
        .when(~was_seen & (old_state == PROCESSED), MISSING)
        .when(was_seen & (old_state == MISSING), PROCESSED)
        .otherwise(old_state)
        .alias("state"),
        F.coalesce("attempts", F.lit(0)).alias("attempts"),
        "first_seen",
        "last_seen",
    )


def record_outcomes(state: DataFrame, outcomes: DataFrame, max_attempts: int = 3) -> DataFrame:
    """Apply (url, success) rows: processed on success, failed once the attempts are used up."""
    result = outcomes.groupBy("url").agg(
        F.bool_or("success").alias("_ok"), F.count_if(~F.col("success")).cast("int").alias("_bad")
    )
    tries = F.col("attempts") + F.coalesce("_bad", F.lit(0))
    return state.join(result, "url", "left").select(
        "url", "location",
        F.when(F.col("_ok"), PROCESSED)
        .when(~F.col("_ok") & (tries >= max_attempts), FAILED)
        .otherwise(F.col("state")).alias("state"),
        tries.alias("attempts"), "first_seen", "last_seen",
    )


def first_pending(work: DataFrame, done: Column, order: list[str]) -> DataFrame:
    """The first row in order that is not done."""
    return work.filter(~done).orderBy(*order).limit(1)


def urls_per_group(df: DataFrame, group: str, url: str = "url") -> DataFrame:
    return df.groupBy(group).agg(F.countDistinct(url).alias("urls"))


def page_novelty(hits: DataFrame, group: str, page: str, url: str) -> DataFrame:
    """Per page: distinct URLs, URLs first seen there, and whether the crawl stops at it.

    A URL is new on its first page. The crawl of a group stops at its first page without
    a new URL. ``hits`` shrinks to one row per (group, page, url) before any shuffle.
    """
    on_page = hits.select(group, page, url).distinct()
    first = F.min(page).over(Window.partitionBy(group, url))
    counted = on_page.withColumn("_first", first).groupBy(group, page).agg(
        F.count(F.lit(1)).alias("urls"), F.count_if(F.col(page) == F.col("_first")).alias("new_urls")
    )
    stop = F.min(F.when(F.col("new_urls") == 0, F.col(page))).over(Window.partitionBy(group))
    return counted.select(group, page, "urls", "new_urls", F.coalesce(F.col(page) == stop, F.lit(False)).alias("stops_here"))

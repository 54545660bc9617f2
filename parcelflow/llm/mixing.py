"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame operations alone.

A source is cut into shards of about ``SHARD_WORDS`` words by a seeded hash of the ids, a shard into
equal blocks of about ``BLOCK_WORDS`` words along a seeded order of its documents. All words of the mix go to sources by the
highest quotients target / (2k - 1), and those of a source to its shards in the same way: a seat is one word, so sources of a few words
get their share like large ones. A shard with n words and a quota of q takes every block q div n times, and then, along a seeded
order of its blocks, whole blocks for q mod n words once more; the last of these gives only its first words, so that the quota is met
to the word. What a document gives is what these blocks hold of it.

Quotients are never listed in full. With weights p that sum to 1 and N seats, rounding p * (N - s/2 - 1)
for the s parties gives too few seats and p * (N + s/2 + 1) too many; only the seats between the two,
about two to a party, are ranked. The ranking of sources runs in one task over one small row per source,
that of shards in one task per source over about three rows per million words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelflow.functions.text import let
from parcelflow.llm.common import WORD, stored

BLOCK_WORDS = 32
SHARD_WORDS = 1_000_000
#: How often a document may be taken at most.
MOST = 3
SEED = 20
#: The prime that steps through a shard's blocks; no shard has as many.
STEP = 2_147_483_647


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def apportion(parties: DataFrame, within: list[str], key: str, weight: str, seats: str, out: str) -> DataFrame:
    """``parties`` plus ``out``: seats by Sainte-Lague in each group ``within``.

    ``seats`` is the number of seats of the group and is the same in all its rows. Ties go to the smaller
    ``key``, which is unique in its group. A party without weight gets no seat while another has some.
    """
    group = Window.partitionBy(*within)
    share = F.coalesce(F.try_divide(F.col(weight), F.sum(weight).over(group)), F.lit(0.0))
    reach = F.count(F.lit(1)).over(group) / 2 + 1
    bounds = parties.withColumns({
        "_low": F.greatest(F.lit(0), F.floor(share * (F.col(seats) - reach) + 0.5)).cast("bigint"),
        "_high": (F.floor(share * (F.col(seats) + reach) + 0.5) + 1).cast("bigint"),
    }).withColumn("_open", F.col(seats) - F.sum("_low").over(group))
    quotients = group.orderBy((F.col(weight) / (2 * F.col("_seat") - 1)).desc(), key)
    ranked = bounds.withColumn("_seat", F.explode(F.sequence(F.col("_low") + 1, F.col("_high")))).withColumn(
        "_rank", F.row_number().over(quotients)
    )
    return ranked.groupBy(*parties.columns, "_low").agg(F.count_if(F.col("_rank") <= F.col("_open")).alias("_more")).select(
        *parties.columns, (F.col("_low") + F.col("_more")).alias(out)
    )


def weights_by_rank(sizes: DataFrame) -> DataFrame:
    """Weights 1, 2, 3, 1, 2, ... for the sources by code point, null last."""
    return sizes.withColumn("weight", (F.pmod(F.col("source_no") - 1, F.lit(3)) + 1).cast("double"))


def targets(sizes: DataFrame) -> DataFrame:
    """``sizes`` (source_no, source_size, weight) plus ``target``: all words shared by weight.

    A target stops at ``MOST`` times its source's size, and the excess is shared again by weight. With
    sources in the order of their limit per weight, the level that the targets reach per weight is
    the highest of those that result when the first 0, 1, 2, ... sources stand at their limits.
    """
    limit = F.col("source_size") * MOST
    every, order = Window.partitionBy(), Window.partitionBy().orderBy(limit / F.col("weight"), "source_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum(limit).over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    return sizes.withColumn("_level", level).withColumn(
        "target", F.least(limit.cast("double"), F.max("_level").over(every) * F.col("weight"))
    ).drop("_level")


def _shard(key: Column, shards: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(SEED)), shards)


def plan(rows: DataFrame, weights=weights_by_rank) -> tuple[DataFrame, DataFrame]:
    """Sources and shards with their quotas, from rows (doc_id, source, size).

    ``weights`` adds the column weight (above zero) to (source, source_size, source_no).
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn(
        "source_no", F.row_number().over(Window.partitionBy().orderBy(F.col("source").asc_nulls_last())).cast("bigint")
    )
    shared = targets(weights(sizes)).withColumn("seats", F.sum("source_size").over(Window.partitionBy()).cast("bigint"))
    sources = stored(
        apportion(shared, [], "source_no", "target", "seats", "quota")
        .withColumn("quota", F.least("quota", MOST * F.col("source_size")))
        .withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD_WORDS)).cast("bigint"))
        .select("source", "source_no", "source_size", "target", "quota", "shards")
    )
    in_shards = with_sources(rows, sources).groupBy("source_no", "shard", "quota").agg(F.sum("size").alias("shard_size"))
    shards = apportion(in_shards, ["source_no"], "shard", "shard_size", "quota", "shard_quota").select(
        "source_no", "shard", "shard_size", F.least("shard_quota", MOST * F.col("shard_size")).alias("shard_quota")
    )
    return sources, stored(shards)


def with_sources(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` beside their source; the join carries no hint, its small side is measured."""
    named = sources.withColumnRenamed("source", "_source")
    return rows.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn(
        "shard", _shard(F.col("place"), F.col("shards"))
    )


def _taken_of(block: Column) -> Column:
    """How many words of a block, its first ones, are taken once more.

    Blocks come in the order of their ``turn``, a seeded step through their numbers. All have ``width`` words but the last, which lacks
    ``lack``; so the words of all blocks that come before one are known without a sum.
    """
    turn = _turn(block)
    before = turn * F.col("width") - F.when(F.col("last_turn") < turn, F.col("lack")).otherwise(F.lit(0))
    size = F.col("width") - F.when(block == F.col("blocks") - 1, F.col("lack")).otherwise(F.lit(0))
    return F.least(size, F.greatest(F.lit(0), F.col("more") - before))


def _turn(block: Column) -> Column:
    return F.pmod(block * F.col("step") + F.col("offset"), F.col("blocks"))


def _blocks_of() -> Column:
    """The blocks that a document lies in."""
    return F.sequence(F.floor(F.col("start") / F.col("width")), F.floor((F.col("end") - 1) / F.col("width")))


def _held(block: Column) -> tuple[Column, Column]:
    """Where a block begins in a document, from 0, and how many words of it the block takes once more; they follow each other."""
    first = block * F.col("width")
    low = F.greatest(F.col("start"), first)
    return low - F.col("start"), F.greatest(F.lit(0), F.least(F.col("end"), first + _taken_of(block)) - low)


def placed(rows: DataFrame, sources: DataFrame, shards: DataFrame) -> DataFrame:
    """``rows`` (doc_id, place, source, size, ...) with their place in the shard and what is taken of them.

    ``rounds`` is how often all of the document is taken, ``part`` how many words are taken once more.
    """
    order = Window.partitionBy("source_no", "shard").orderBy(F.xxhash64("place", F.lit(SEED + 1)), "place", "size")
    at = with_sources(rows, sources.drop("quota")).withColumn(
        "end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("start", F.col("end") - F.col("size")).join(shards, ["source_no", "shard"])
    some = F.greatest(F.lit(1), F.col("shard_size"))  # a shard without words takes none
    at = at.withColumn("blocks", F.ceil(some / BLOCK_WORDS).cast("bigint")).withColumn("width", F.ceil(some / F.col("blocks")).cast("bigint")).withColumns({
        "lack": F.col("blocks") * F.col("width") - some,
        "rounds": F.floor(F.col("shard_quota") / some),
        "more": F.pmod("shard_quota", some),
        "offset": F.pmod(F.xxhash64("source_no", "shard", F.lit(SEED + 2)), F.col("blocks")),
        "step": F.pmod(F.lit(STEP), F.col("blocks")),
    }).withColumn("last_turn", _turn(F.col("blocks") - 1))
    part = F.aggregate(_blocks_of(), F.lit(0).cast("bigint"), lambda total, block: total + _held(block)[1])
    return at.withColumn("part", F.when(F.col("size") > 0, part).otherwise(F.lit(0).cast("bigint")))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    """(doc_id, place, source, size, ...); ``place`` decides shard and order, by the id or, without one, by the text."""
    own = F.col(id_col).cast("bigint")
    return docs.select(
        own.alias("doc_id"), F.coalesce(own, F.xxhash64(F.col(text_col))).alias("place"), F.col(source_col).cast("string").alias("source"),
        words(F.col(text_col)).alias("size"), *more,
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=weights_by_rank) -> DataFrame:
    """(id_col, size, source_size, target, taken) for every row of ``docs``.

    taken is how many words the mix takes of the document, repeats counted: 0 to ``MOST`` times its
    size. The words taken of a source differ from its target by rounding to whole words, in all sources by less than one seat
    each and one word a shard. Null and blank texts have size 0 and are not taken. A null source
    is a source of its own. Rows without an id are placed by their text; rows that repeat
    an id count as rows. The same rows give the same result. An empty table gives an empty result.
    """
    rows = stored(_sized(docs, id_col, text_col, source_col))
    return placed(rows, *plan(rows, weights)).select(
        F.col("doc_id").alias(id_col), "size", "source_size", "target",
        (F.col("rounds") * F.col("size") + F.col("part")).cast("bigint").alias("taken"),
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          chars_col: str | None = "n_chars", weights=weights_by_rank) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document once per round, and the part of it that
    is taken once more as a shorter text with its own white space between words.

    ``chars_col`` is set to the length of a shortened text where the table has such a column.
    """
    rows = stored(_sized(docs, id_col, text_col, source_col))
    whole = _sized(docs, id_col, text_col, source_col, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    at = placed(whole, *plan(rows, weights)).withColumn("copies", F.col("rounds") + (F.col("part") > 0).cast("bigint"))
    each = at.filter("size > 0 and copies > 0").withColumn("round", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    pieces = F.regexp_extract_all(F.col("row")[text_col], F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))

    def held(words_: Column) -> Column:
        def of_block(block: Column) -> Column:
            at, n = _held(block)
            return F.slice(words_, (at + 1).cast("int"), n.cast("int"))

        return F.flatten(F.transform(_blocks_of(), of_block))

    kept = let(pieces, held)
    cut = F.col("round") > F.col("rounds")
    text = F.when(cut & (F.col("part") < F.col("size")), F.ltrim(F.array_join(kept, ""))).otherwise(F.col("row")[text_col])
    each = each.withColumn("_text", text)
    out = {c: F.col("row")[c] for c in docs.columns} | {text_col: F.col("_text")}
    if chars_col in docs.columns:
        out[chars_col] = F.when(cut, F.length("_text").cast(docs.schema[chars_col].dataType)).otherwise(F.col("row")[chars_col])
    return each.select(*[v.alias(c) for c, v in out.items()])

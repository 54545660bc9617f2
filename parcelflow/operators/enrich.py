"""Enrichment of listings from a provider and a postal reference.

Joins carry no broadcast hint: Spark compares the measured size with
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges, where adaptive
execution splits a hot key of the listing side (the provider side has one row per key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from parcelflow.functions.text import normalize_key, strip
from parcelflow.operators.dedup import last_wins
from parcelflow.operators.skew import last_known


def provider_index(provider: DataFrame, county: str, address: str, load_order: list[str]) -> DataFrame:
    """One provider row per (county, addr_key): the one loaded last, over all files."""
    rest = [F.col(f"`{c}`") for c in provider.columns if c != county]
    keyed = provider.select(*rest, strip(county).alias("county"), normalize_key(address).alias("addr_key"))
    return last_wins(keyed.filter("county IS NOT NULL AND addr_key IS NOT NULL"), ["county", "addr_key"], load_order)


def enrich(listings: DataFrame, index: DataFrame, columns: list[str], matched: str = "matched") -> DataFrame:
    """Left join on (county, addr_key). A match overwrites ``columns`` of the listing.

    The provider columns are always present and null without a match; a column that the
    listing already had keeps its value only when nothing matched.
    """
    side = index.select(
        F.col("county").alias("_county"), F.col("addr_key").alias("_addr"),
        *[F.col(f"`{c}`").alias(f"_p_{i}") for i, c in enumerate(columns)], F.lit(True).alias("_hit"),
    )
    on = (listings["county"] == side["_county"]) & (listings["addr_key"] == side["_addr"])
    joined = listings.join(side, on, "left")
    hit = F.col("_hit").isNotNull()
    kept = [F.col(f"`{c}`") for c in listings.columns if c not in columns]

    def value(i: int, c: str) -> Column:
        new = F.col(f"_p_{i}")
        return (F.when(hit, new).otherwise(F.col(f"`{c}`")) if c in listings.columns else new).alias(c)

    return joined.select(*kept, *[value(i, c) for i, c in enumerate(columns)], hit.alias(matched))


def zip_to_county(
    df: DataFrame, postal: DataFrame, on: tuple[str, str], county: str, out: str = "county", default: str = "Unknown",
    order: list[str] | None = None,
) -> DataFrame:
    """The name in ``postal`` for a ZIP; a miss and a null name both give ``default``.

    ``on`` names the ZIP's column in ``df`` and in ``postal``. A ZIP that repeats in ``postal`` multiplies no row: the last one in
    ``order`` counts, by default the one with the largest name.
    """
    mine, theirs = on
    one = one_per_zip(postal.select(F.col(theirs).alias("_zip"), F.col(county).alias("_name"), *(order or [])), "_zip", order or ["_name"])
    return df.join(one.select("_zip", "_name"), df[mine] == F.col("_zip"), "left").select(df["*"], F.coalesce("_name", F.lit(default)).alias(out))


def one_per_zip(postal: DataFrame, zip_code: str, order: list[str]) -> DataFrame:
    """The postal table with one row per ZIP, the last in ``order``, so that a lookup multiplies no row."""
    return last_wins(postal.filter(F.col(zip_code).isNotNull()), [zip_code], order)


def as_of(
    listings: DataFrame, loads: DataFrame, keys: list[str], listed: str, loaded: str, columns: list[str], order: list[str] | None = None, **limits: int
) -> DataFrame:
    """Each listing with the ``columns`` of the provider row that was the last one loaded for its keys when it was listed.

    A load of the same moment counts; among loads of one moment the last in ``order`` does. Where none came before, the columns are null, as for
    a listing without a time or with a null key. One union and one pass in time order, so a hot key is cut at values of time and no listing is
    paired with more than one load. The columns must not be columns of ``listings``.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    order = order or []
    kinds = [loads.schema[c].dataType for c in order]
    record = F.struct(*[F.col(f"`{c}`") for c in columns])
    whole = F.struct(*[F.col(f"`{c}`") for c in listings.columns])

    def side(df: DataFrame, at: str, load: bool) -> DataFrame:
        ties = [F.col(c) if load else F.lit(None).cast(t) for c, t in zip(order, kinds, strict=True)]
        parts = [F.col(k).alias(n) for k, n in zip(keys, names, strict=True)] + [F.col(at).cast("timestamp").alias("_at"), F.lit(0 if load else 1).alias("_side")]
        parts += [t.alias(f"_t{i}") for i, t in enumerate(ties)]
        return df.select(*parts, record.alias("_load") if load else whole.alias("_row"))

    fits = F.col("_at").isNotNull()
    for n in names:
        fits &= F.col(n).isNotNull()
    both = side(listings, listed, False).unionByName(side(loads, loaded, True).filter(fits), allowMissingColumns=True)
    carried = last_known(both, names, ["_at", "_side", *[f"_t{i}" for i in range(len(order))]], F.col("_load"), "_known", **limits)
    known = F.when(fits, F.col("_known"))
    return carried.filter("_side = 1").select("_row.*", *[known[c].alias(c) for c in columns])


def observed_matches(enriched: DataFrame, matched: str = "matched", name: str = "enrich") -> tuple[DataFrame, Observation]:
    """``enriched`` as it is, and what its first action will have counted: listings, matched and unmatched ones."""
    seen = Observation(name)
    hit = F.col(matched)
    return enriched.observe(seen, F.count(F.lit(1)).alias("listings"), F.count_if(hit).alias("matched"), F.count_if(~hit).alias("unmatched")), seen


def match_rate(enriched: DataFrame, group: str = "county", matched: str = "matched") -> DataFrame:
    return enriched.groupBy(group).agg(
        F.count(F.lit(1)).alias("listings"),
        F.count_if(F.col(matched)).alias("matched"),
        F.count_if(~F.col(matched)).alias("unmatched"),
    )

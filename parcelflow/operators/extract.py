"""From pages to listing rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from parcelflow.functions import contact, dom, lexicon as lex, locality, markup
from parcelflow.functions.text import last_token, sentinel_to_null, strip

SAVED, INVALID_ADDRESS, NO_CONTACT = "saved", "invalid_address", "no_contact"


@dataclass(frozen=True)
class Selectors:
    """Where a listing page holds its fields: one selector for each, ``costs`` for the rows of the cost table."""

    # The elements of the pages that listings are read from.
    street: str = 'div[data-rf-test-id="abp-streetLine"]'
    place: str = "div.dp-subtext.bp-cityStateZip"
    price: str = "div.statsValue"
    agent: str = "span.agent-basic-details--heading"
    agent_name: str = "span"
    contact: str = "div.agent-contact"
    info: str = "div.remarks"
    costs: str = "div.Row"


def from_markup(
    pages: DataFrame, keys: list[str], url: str, html: str, selectors: Selectors = Selectors(), lexicon: lex.Lexicon = lex.LISTING_LEXICON,
) -> DataFrame:
    """``listing_fields`` of pages of markup, by selectors. What a page does not hold is null.

    The agent's name is the element ``agent_name`` inside the first ``agent`` element. The rows of the cost table are read as texts, so a cost is found beside
    its label whatever elements lie between. The markup is cut into tokens once, and the tags of one name are paired once for all selectors.
    """
    cut = pages.select(*keys, F.col(url).alias("_url"), dom.tokens(html).alias("_t"))
    on_page = [s for f, s in vars(selectors).items() if f != "agent_name"]
    place = {s: f"_at_{dom.parse(s).tag}" for s in on_page}
    cut = cut.select("*", *[dom.spans("_t", tag).alias(f"_at_{tag}") for tag in dict.fromkeys(dom.parse(s).tag for s in on_page)])
    section = lambda s: dom.select_text("_t", s, place[s])
    agent = dom.select_text(F.get(dom.select("_t", selectors.agent, place[selectors.agent]), 0)["inside"], selectors.agent_name)
    texts = cut.select(
        *keys, "_url", section(selectors.street).alias("_street"), section(selectors.place).alias("_where"), section(selectors.price).alias("_price"),
        agent.alias("_agent"), section(selectors.contact).alias("_contact"), section(selectors.info).alias("_info"),
        F.array_join(dom.select_texts("_t", selectors.costs, place[selectors.costs]), " ").alias("_costs"),
    )
    costs = F.concat_ws(" ", "_costs", "_info")
    return listing_fields(
        texts, keys, F.col("_url"), F.col("_street"), F.col("_where"), F.col("_price"), F.col("_agent"), F.col("_contact"), F.col("_info"), costs, lexicon,
    )


def listing_fields(
    pages: DataFrame, keys: list[str], url: Column, address: Column, place: Column, price: Column, agent: Column,
    contact_section: Column, info: Column, costs: Column, lexicon: lex.Lexicon = lex.LISTING_LEXICON,
) -> DataFrame:
    """One row per page with the listing columns (``schemas.LISTING_COLUMNS``) and an ``outcome``; nothing is dropped.

    The values are cut from the page by the caller's expressions, as are the texts that hold the
    contact (its last word is the phone), the description and the monthly costs. Rows to keep are
    those with the outcome 'saved': a valid address and a phone. Price and agent stay texts (see
    ``money.clean_money``); a missing one is null.
    """
    cut = pages.select(
        *keys,
        locality.address_line(address, place).alias("address"),
        locality.split_locality(place).alias("_place"),
        sentinel_to_null(strip(price)).alias("price"),
        sentinel_to_null(strip(agent)).alias("agent_name"),
        contact.format_phone(last_token(contact_section)).alias("phone_number"),
        lex.motivated_status(info, lexicon).alias("_m"),
        markup.rent_amount(costs).alias("rent"),
        *[markup.labelled_amount(costs, label).alias(name) for label, name in markup.COST_COLUMNS.items()],
        url.alias("url"),
    )
    outcome = (
        F.when(~F.coalesce(contact.valid_address("address"), F.lit(False)), INVALID_ADDRESS)
        .when(~contact.has_contact("phone_number"), NO_CONTACT)
        .otherwise(SAVED)
    )
    return cut.select(
        *keys, "address", "_place.*", "price", "rent", "hoa_fee", "property_taxes", "insurance", "principal_and_interest",
        "agent_name", "phone_number", F.col("_m.motivated").alias("Motivated"), F.col("_m.keyword").alias("Trigger Keyword"),
        F.col("_m.synonym").alias("Trigger Sentence"), F.col("_m.context").alias("Trigger Context"), "url", outcome.alias("outcome"),
    )

"""Merge, frontier, enrichment and dedup rules, and the decisions on known defects."""

import datetime
import random

from pyspark.sql import Row, functions as F, types as T

from parcelflow.operators import dedup, documents, enrich, frontier, metrics, rollup
from parcelflow.schemas import LISTING_RAW, URL_STATE
from parcelflow.sources import readers, writers

AS_OF = datetime.datetime(2024, 9, 1)
EARLY = datetime.datetime(2024, 1, 1)


def merge(spark, stored, batch, as_of=AS_OF):
    s = spark.createDataFrame(stored, "agent string, address string, price int, rent int, ts timestamp_ntz")
    b = spark.createDataFrame(batch, "agent string, address string, price int, rent int, seq int")
    out = documents.fill_null_upsert(s, b, ["agent", "address"], ["price", "rent"], "ts", "seq",
                                     F.lit(as_of).cast("timestamp_ntz"))
    return out


def merge_by_hand(stored, batch):
    """The same merge as a loop over dictionaries."""
    table = {(a, d): [p, r, t, False, True] for a, d, p, r, t in stored}
    for a, d, p, r, _ in sorted(batch, key=lambda x: x[4]):
        if a is None or d is None:
            continue
        if (a, d) not in table:
            table[a, d] = [p, r, AS_OF, False, False]
            continue
        row = table[a, d]
        for i, v in enumerate((p, r)):
            if row[i] is None and v is not None:
                row[i] = v
                row[3] = True
    return {k: (p, r, t, ("filled" if f else "unchanged") if known else "inserted") for k, (p, r, t, f, known) in table.items()}


def test_fill_null_upsert_like_the_loop(spark):
    rng = random.Random(11)
    opt = lambda: rng.choice([None, rng.randint(1, 9)])
    stored = [(f"a{i}", f"d{j}", opt(), opt(), EARLY) for i in range(6) for j in range(4)]
    batch = [(rng.choice(["a1", "a2", "b1", None]), rng.choice(["d1", "d2", "d9", "d8"]), opt(), opt(), n) for n in range(200)]
    got = {(r.agent, r.address): (r.price, r.rent, r.ts, r.action) for r in merge(spark, stored, batch).collect()}
    assert got == merge_by_hand(stored, batch)


def test_second_run_changes_nothing(spark):
    stored = [("a", "x", None, 1, EARLY)]
    batch = [("a", "x", 5, 2, 0), ("a", "y", None, 3, 1), ("a", "y", 4, 9, 2)]
    first = merge(spark, stored, batch)
    assert {r.address: (r.price, r.rent, r.action) for r in first.collect()} == {
        "x": (5, 1, "filled"), "y": (4, 3, "inserted")
    }
    again = merge(spark, [tuple(r)[:5] for r in first.collect()], batch, datetime.datetime(2025, 1, 1))
    assert {r.action for r in again.collect()} == {"unchanged"}
    assert {(r.address, r.ts) for r in again.collect()} == {("x", EARLY), ("y", AS_OF)}


def test_existing_price_is_kept(spark):
    out = merge(spark, [("a", "x", 7, None, EARLY)], [("a", "x", 8, None, 0)]).collect()
    assert [(r.price, r.action, r.ts) for r in out] == [(7, "unchanged", EARLY)]


def test_cap_keeps_the_newest_and_labels_are_dense(spark):
    """The sixteenth listing evicts the oldest, and no label is used twice."""
    rows = [("a", i, f"d{i}") for i in range(17)] + [("b", 0, "x")]
    df = spark.createDataFrame(rows, "agent string, t int, address string")
    capped = documents.cap_latest(df, "agent", [F.desc("t")])
    got = documents.label_capped(capped, "agent", [F.asc("t")]).filter("agent = 'a'").collect()
    assert sorted(r.t for r in got) == list(range(2, 17))
    assert {r.t: r.label for r in got} == {t: f"Address {t - 1}" for t in range(2, 17)}


def test_nest_and_flatten(spark):
    rows = [("a", 2, "y"), ("a", 1, "x"), ("b", 1, "z"), (None, 1, "w")]
    df = spark.createDataFrame(rows, "agent string, t int, address string")
    nested = documents.nest(df, "agent", [F.asc("t")], ["address"])
    assert {r.agent: {k: v.address for k, v in r.listings.items()} for r in nested.collect()} == {
        "a": {"Address 1": "x", "Address 2": "y"}, "b": {"Address 1": "z"}
    }
    assert sorted(tuple(r) for r in documents.flatten(nested, "agent").collect()) == [
        ("a", "Address 1", "x"), ("a", "Address 2", "y"), ("b", "Address 1", "z")
    ]


def test_nesting_drops_nothing(spark, tmp_path):
    df = spark.range(40).selectExpr("'a' as agent", "id as t", "cast(id as string) as address")
    path = writers.save_documents_json(df, str(tmp_path / "docs"), "agent", [F.asc("t")], ["address"])
    record = T.StructType([T.StructField("address", T.StringType())])
    assert sorted(int(r.address) for r in readers.scan_documents_json(spark, path, record).collect()) == list(range(40))
    capped = documents.cap_latest(df, "agent", [F.desc("t")])
    path = writers.save_documents_json(capped, str(tmp_path / "docs"), "agent", [F.asc("t")], ["address"])
    back = readers.scan_documents_json(spark, path, record).collect()
    assert {r.label: int(r.address) for r in back} == {f"Address {i + 1}": 25 + i for i in range(15)}


def test_a_repeated_zip_multiplies_no_row(spark):
    postal = spark.createDataFrame([("1", "Old", 1), ("1", "New", 2), (None, "x", 3)], "zip string, county string, n int")
    df = spark.createDataFrame([(1, "1"), (2, "9"), (3, None)], "id int, z string")
    out = enrich.zip_to_county(df, postal, ("z", "zip"), "county", out="place", order=["n"]).collect()
    assert sorted((r.id, r.place) for r in out) == [(1, "New"), (2, "Unknown"), (3, "Unknown")]


def test_merge_reports(spark):
    out = merge(spark, [("a", "x", None, 1, EARLY)], [("a", "x", 5, 2, 0), ("a", "y", 1, 1, 1), ("b", "y", 1, 1, 2)])
    assert {tuple(r) for r in documents.merge_summary(out, "agent").collect()} == {("filled", 1, 1), ("inserted", 2, 2)}
    assert {tuple(r) for r in documents.agents_by_action(out, "agent").collect()} == {
        ("filled", "a"), ("inserted", "a"), ("inserted", "b")
    }


def test_metrics(spark):
    rows = [(1, "200000", "2000", "100", "200", "50"), (2, "200000", "0", "1", "1", "1"), (3, "100.10", "400", "0", "0", "0"),
            (4, "0", "2000", "0", "0", "0")]
    df = spark.createDataFrame(rows, "id int, price string, rent string, insurance string, property_taxes string, hoa_fee string")
    money_cols = {c: F.col(c).cast("decimal(18,2)") for c in df.columns if c != "id"}
    out = {r.id: r for r in metrics.add_offer_metrics(df.withColumns(money_cols)).collect()}
    a = out[1]
    assert [float(x) for x in (a.management_fee, a.capex_fee, a.vacancy_fee, a.monthly_creative_payments, a.downpayment,
                               a.cash_offer, a.hoa_fee)] == [200, 100, 100, 950, 20000, 150000, 50]
    assert a.term_length_months == 43
    b = out[2]
    assert (float(b.cash_offer), float(b.downpayment), b.term_length_months, float(b.hoa_fee)) == (150000, 0, 0, 1)
    assert (float(out[3].cash_offer), float(out[3].monthly_creative_payments), out[3].term_length_months) == (75.08, -30, 0)
    assert out[4].term_length_months == 0


def state_rows(spark, rows):
    return spark.createDataFrame(rows, URL_STATE)


def test_missing_stays_until_seen_again(spark):
    day = [datetime.date(2024, 1, d) for d in range(1, 5)]
    state = state_rows(spark, [("p", "L", "processed", 0, day[0], day[0]), ("q", "L", "pending", 1, day[0], day[0])])

    def step(current, urls, on):
        seen = spark.createDataFrame([(u, "M") for u in urls], "url string, location string")
        return frontier.advance(current, seen, F.lit(on))

    one = step(state, ["q", "n", "n"], day[1])
    got = {r.url: (r.state, r.location, r.attempts, r.first_seen, r.last_seen) for r in one.collect()}
    assert got == {
        "p": ("missing", "L", 0, day[0], day[0]), "q": ("pending", "L", 1, day[0], day[1]),
        "n": ("pending", "M", 0, day[1], day[1]),
    }
    two = step(one, ["q"], day[2])
    assert {r.url: r.state for r in two.collect()}["p"] == "missing"
    three = step(two, ["p"], day[3])
    assert {r.url: r.state for r in three.collect()}["p"] == "processed"


def test_failed_urls_are_not_processed(spark):
    day = datetime.date(2024, 1, 1)
    state = state_rows(spark, [(u, "L", "pending", a, day, day) for u, a in (("ok", 0), ("bad", 2), ("once", 0), ("idle", 0))])
    tried = spark.createDataFrame([("ok", False), ("ok", True), ("bad", False), ("once", False)], "url string, success boolean")
    got = {r.url: (r.state, r.attempts) for r in frontier.record_outcomes(state, tried).collect()}
    assert got == {"ok": ("processed", 1), "bad": ("failed", 3), "once": ("pending", 1), "idle": ("pending", 0)}


def test_frontier_sets_are_whole_and_disjoint(spark):
    rng = random.Random(2)
    seen = spark.createDataFrame([(rng.randint(0, 99),) for _ in range(150)], "url int")
    done = spark.createDataFrame([(rng.randint(50, 149),) for _ in range(150)] + [(None,)], "url int")
    new = {r.url for r in frontier.new_keys(seen, done).collect()}
    known = {r.url for r in frontier.known_keys(seen, done).collect()}
    assert not new & known and new | known == {r.url for r in seen.collect()}
    assert {r.url for r in frontier.pending(seen, done).collect()} == new
    delta = {r.url: r.delta for r in frontier.crawl_delta(seen, done).collect()}
    assert {u for u, d in delta.items() if d == "new"} == new
    assert {u for u, d in delta.items() if d == "known"} == known


def test_page_novelty_like_the_loop(spark):
    rng = random.Random(4)
    rows = [(g, p, rng.randint(0, 12)) for g in "ab" for p in range(1, 9) for _ in range(4)]
    df = spark.createDataFrame(rows, "g string, p int, u int")
    got = {(r.g, r.p): (r.urls, r.new_urls, r.stops_here) for r in frontier.page_novelty(df, "g", "p", "u").collect()}
    for g in "ab":
        seen, stopped = set(), False
        for p in range(1, 9):
            here = {u for gg, pp, u in rows if (gg, pp) == (g, p)}
            fresh = here - seen
            assert got[g, p] == (len(here), len(fresh), not fresh and not stopped)
            stopped = stopped or not fresh
            seen |= here


def test_upserts(spark):
    old = spark.createDataFrame([("x", "old", 0), ("y", "old", 0)], "url string, s string, n int")
    new = spark.createDataFrame([("x", "n1", 1), ("x", "n2", 2), ("z", "n1", 1), ("z", "n2", 2)], "url string, s string, n int")
    keep = {r.url: r.s for r in frontier.upsert_ignore(old, new, ["url"], ["n"]).collect()}
    assert keep == {"x": "old", "y": "old", "z": "n1"}
    take = {r.url: r.s for r in frontier.upsert_replace(old, new, ["url"], ["n"]).collect()}
    assert take == {"x": "n2", "y": "old", "z": "n2"}


def test_enrichment_keeps_rows_and_last_load_wins(spark):
    listings = spark.createDataFrame(
        [(1, "Orange", "1main", "keep"), (2, "Orange", "2main", "keep"), (3, None, "1main", "keep"), (4, "Orange", "1main", "keep")],
        "id int, county string, addr_key string, status string",
    )
    provider = spark.createDataFrame(
        [(" Orange ", "1 Main", 1, "old", 10), ("Orange", "1-MAIN", 2, None, 20), ("Lake", "2 Main", 3, "x", 30), (None, "1 main", 4, "y", 40)],
        "County string, Address string, seq int, status string, beds int",
    )
    index = enrich.provider_index(provider, "County", "Address", ["seq"])
    out = {r.id: (r.status, r.beds, r.matched) for r in enrich.enrich(listings, index, ["status", "beds"]).collect()}
    assert out == {1: (None, 20, True), 4: (None, 20, True), 2: ("keep", None, False), 3: ("keep", None, False)}
    rates = enrich.match_rate(enrich.enrich(listings, index, ["status"])).collect()
    assert {r.county: (r.listings, r.matched, r.unmatched) for r in rates} == {"Orange": (3, 2, 1), None: (1, 0, 1)}


def test_zip_lookup_miss_and_null_are_unknown(spark):
    df = spark.createDataFrame([("01234",), ("99999",), ("11111",), (None,)], "zip string")
    postal = spark.createDataFrame([("01234", "Orange"), ("11111", None)], "postal_code string, county_name string")
    out = enrich.zip_to_county(df, postal, ("zip", "postal_code"), "county_name")
    assert {r.zip: r.county for r in out.collect()} == {"01234": "Orange", "99999": "Unknown", "11111": "Unknown", None: "Unknown"}


def test_append_dedup(spark):
    old = spark.createDataFrame([("a", None, 1), ("a", None, 1)], "k string, z string, n int")
    new = spark.createDataFrame([("a", None, 2), ("b", "x", 4), ("b", "x", 3)], "k string, z string, n int")
    got = sorted(tuple(r) for r in dedup.append_dedup(old, new, ["k", "z"], ["n"]).select("k", "n").collect())
    assert got == [("a", 1), ("a", 1), ("b", 3)]


def test_project_to_schema(spark):
    df = spark.createDataFrame([("1 Main", "x", 5)], "address string, extra string, `Trigger Keyword` int")
    out = dedup.project_to_schema(df, LISTING_RAW)
    assert out.columns == LISTING_RAW.fieldNames()
    row = out.first()
    assert (row.address, row["Trigger Keyword"], row.city) == ("1 Main", "5", None)


def test_rollups(spark):
    df = spark.createDataFrame([("Lake", "FL"), ("Lake", "FL"), (None, "FL"), ("Lake", None)], "c string, s string")
    assert {tuple(r) for r in rollup.count_by_geo(df, "c", "s").collect()} == {("Lake, FL", 2), ("unidentified", 2)}
    assert rollup.null_profile(df, ["c", "s"]).first() == Row(rows=4, missing_c=1, missing_s=1)
    empty = rollup.progress_ratio(df.filter("false"), F.col("c") == "Lake").first()
    assert (empty.done, empty.total, empty.ratio) == (0, 0, None)


def test_listing_fields(spark):
    from parcelflow.operators import extract
    from parcelflow.schemas import LISTING_COLUMNS

    pages = spark.createDataFrame(
        [
            (1, " 1 Main St ", "Tampa, FL 01234", "Listed by A 813.555.0000", "Must sell!", "HOA dues $ 1,250.99 Est. $900 per month"),
            (2, "Undisclosed address 5", "Tampa, FL", "x", "", ""),
            (3, "2 Main St", "Tampa", "Call (813) 555-0000", None, None),
            (4, None, None, None, None, None),
        ],
        "id int, street string, place string, section string, info string, costs string",
    )
    url, price, agent = F.concat(F.lit("u"), "id"), F.when(F.col("id") == 1, "\t$250,000\r").otherwise("N/A\r"), F.lit(" Ann ")
    args = [url, F.col("street"), F.col("place"), price, agent, *[F.col(c) for c in ("section", "info", "costs")]]
    out = extract.listing_fields(pages, ["id"], *args)
    assert set(LISTING_COLUMNS) < set(out.columns)
    rows = {r.id: r for r in out.collect()}
    assert [(rows[i].price, rows[i].agent_name, rows[i].url) for i in (1, 2)] == [("$250,000", "Ann", "u1"), (None, "Ann", "u2")]
    a = rows[1]
    assert (a.address, a.city, a.state, a.zip_code, a.phone_number) == ("1 Main St, Tampa, FL 01234", "Tampa", "FL", "01234", "813-555-0000")
    assert (a.hoa_fee, a.property_taxes, a.rent, a.Motivated, a["Trigger Keyword"], a["Trigger Context"]) == (1250, None, 900, True, "Urgent", "must sell!")
    assert [rows[i].outcome for i in (1, 2, 3, 4)] == ["saved", "invalid_address", "no_contact", "invalid_address"]
    assert rows[4].Motivated is False and len(rows) == 4

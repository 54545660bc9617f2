"""Plan guards: what must not appear in any query, and what must appear in some."""

import re

import pytest

from parcelflow.plans import QUERIES

SF_DIR = "/root/testdata/sf0.001"

# What one task may receive: partial rows of an aggregate over the whole table, one per task; and
# the totals per range of a global order, of which there is one per ten million rows.
ONE_TASK = re.compile(r"SinglePartition.*\n.*HashAggregate\(keys=\[(__range#\d+)?\]")


WORD_SEARCH = ["extract_listing_fields", "first_keyword_match", "keyword_match_scanned", "keyword_theta_join", "listing_page_fields", "motivated_status"]


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_unbounded_step(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"BatchEvalPython|InPandas|InArrow", text)
    # The one-pass search for words is the only function in Python, once per plan and over Arrow batches.
    assert len(re.findall(r"ArrowEvalPython \[found\(", text)) == text.count("ArrowEvalPython") == int(name in WORD_SEARCH)
    assert len(ONE_TASK.findall(text)) == text.count("SinglePartition")


@pytest.mark.parametrize("name", ["cap_latest_per_group", "retain_latest_3", "listing_cycle", "nested_document_json"])
def test_groups_shrink_before_the_shuffle(spark, name):
    text = plan(spark, name)
    partial, final = text.find(", Partial"), text.find(", Final")
    assert -1 < final < partial, "WindowGroupLimit runs on both sides of the exchange"


@pytest.mark.parametrize("name,column,absent", [
    ("filter_by_state", "EqualTo(o_orderstatus,O)", "o_totalprice"),
    ("state_counts", "ReadSchema: struct<o_orderstatus:string>", "o_custkey"),
    ("cap_latest_per_group", "ReadSchema", "o_orderpriority"),
])
def test_filters_and_columns_reach_the_scan(spark, name, column, absent):
    text = plan(spark, name)
    assert column in text and absent not in text


@pytest.mark.parametrize("name", ["upsert_fill_null", "upsert_ignore", "upsert_replace", "advance_frontier", "frontier_delta"])
def test_merges_need_no_join(spark, name):
    text = plan(spark, name)
    assert "Join" not in text


def test_lookup_joins_carry_no_hint(spark):
    """Broadcasts of lookup tables follow from measured sizes: without a threshold none is left."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("broadcast_lookup", "enrich_left_join", "anti_join_pending", "state_transition", "frontier_new"):
            text = plan(spark, name)
            assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_page_novelty_reads_once_and_joins_nothing(spark):
    text = plan(spark, "page_novelty")
    assert text.count("Scan parquet") == 1 and "Join" not in text


@pytest.mark.parametrize("name", ["first_keyword_match", "extract_links", "extract_tag_text", "normalize_key", "filter_exclude_any"])
def test_raw_text_is_not_shuffled(spark, name):
    assert "Exchange" not in plan(spark, name)


def test_listing_pages_pair_tags_once_and_use_all_cores(spark):
    df = QUERIES["listing_page_fields"](spark, SF_DIR)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    # Six selectors of div elements share the places of their tags.
    assert len(re.findall(r"\(\?i\)\^</?\??div\(", optimized)) == 1
    assert "array_sort" not in optimized.lower() and "arraysort" not in optimized.lower()
    assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism

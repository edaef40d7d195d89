"""Physical-plan checks for the scale properties the README claims."""

import re

import pytest

from streamweave import catalog


def plan(spark, df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def exchanges(p: str) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", p))


def test_hot_items_prunes_and_limits_before_shuffle(spark, sf_dir, static_plans):
    p = plan(spark, catalog.QUERIES["hot_items_top5"](spark, sf_dir))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "value" not in schema and "user_id" not in schema
    assert "partial_count" in p


def test_keyed_scan_shuffles_the_data_once(spark, sf_dir, static_plans):
    p = plan(spark, catalog.QUERIES["count_per_key"](spark, sf_dir))
    # data by (key, chunk); summary partial -> final; summary prefix window;
    # summary to the merge join. The data side is not shuffled again.
    assert exchanges(p) == 4
    assert "SortMergeJoin" in p and "BroadcastExchange" not in p


def scans(p: str) -> int:
    return len(re.findall(r"FileScan", p))


def test_session_windows_are_one_scan_and_few_exchanges(spark, sf_dir, static_plans):
    p = plan(spark, catalog.QUERIES["session_windows_1h"](spark, sf_dir))
    assert scans(p) == 1 and exchanges(p) <= 5 and "SortMergeJoin" not in p and "SortAggregate" not in p


def test_firing_changelog_has_at_most_six_exchanges(spark, sf_dir, static_plans):
    p = plan(spark, catalog.QUERIES["firing_changelog_min"](spark, sf_dir))
    assert exchanges(p) <= 6 and p.count("SortMergeJoin") == 1


def test_text_is_split_into_words_once(spark, sf_dir, static_plans):
    p = plan(spark, catalog.QUERIES["rolling_word_count"](spark, sf_dir))
    assert "RoundRobin" not in p and "ReusedExchange" in p and scans(p) == 1


def test_shuffled_words_are_sorted_once(spark, sf_dir, static_plans):
    p = plan(spark, catalog.QUERIES["rolling_word_count"](spark, sf_dir))
    # Windows: the running counts of the words and the prefixes of the totals, which are hashed from the same exchange.
    assert len(re.findall(r"Window \[", p)) == 2 and exchanges(p) == 4


@pytest.mark.parametrize("name", ["dedup_hot_items", "dedup_item_timestamp", "temperature_jumps", "rolling_max"])
def test_aggregates_hash(spark, sf_dir, static_plans, name):
    p = plan(spark, catalog.QUERIES[name](spark, sf_dir))
    assert "HashAggregate" in p and "SortAggregate" not in p


@pytest.mark.parametrize("name,predicate", [
    ("behavior_pv", r"In\(event_type, \[pv,view\]\)"), ("hot_items_top5", r"In\(event_type, \[pv,view\]\)"),
    ("dedup_hot_items", r"In\(event_type, \[pv,view\]\)"), ("table_select_where", r"EqualTo\(user_id,4\)"),
    ("sql_not_equal", r"Not\(EqualTo\(user_id,4\)\)")])
def test_filters_reach_the_scan(spark, sf_dir, static_plans, name, predicate):
    p = plan(spark, catalog.QUERIES[name](spark, sf_dir))
    assert re.search(r"PushedFilters: \[.*" + predicate, p)


def test_dedup_is_partially_aggregated(spark, sf_dir, static_plans):
    p = plan(spark, catalog.QUERIES["dedup_item_timestamp"](spark, sf_dir))
    assert re.search(r"Aggregate\(keys?=.*functions=\[partial_min", p)

"""What the physical plans must and must not contain, at any size of data."""

import re

import pytest

from tallyhouse.catalog.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
STREAMED_OR_LOADED = {n for n in QUERIES if n.startswith(("stream_", "load_", "append_", "merged_", "backfill_", "run_"))} - {"backfill_chunks"}
LAZY = sorted(set(QUERIES) - STREAMED_OR_LOADED)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    """Plans as Spark makes them for large inputs, where nothing is broadcast by estimate."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    made = {name: physical(QUERIES[name](spark, FOLDER)) for name in LAZY}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return made


@pytest.mark.parametrize("name", LAZY)
def test_no_slow_operators(plans, name):
    bad = ["EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin", "Window"]
    if not name.endswith("_of_bitmaps"):
        # Spark merges bitmaps in sorted order, as their buffers are binary.
        bad.append("SortAggregate")
    if name != "required_fields_check":
        # That one brings together one row of counts per task.
        bad.append("SinglePartition")
    assert [b for b in bad if b in plans[name]] == []


def exchanges(plan: str) -> int:
    return plan.count("Exchange ")


@pytest.mark.parametrize("name", [
    "tokenize_column", "tokenize_payments", "mask_contacts", "redact_table", "conform_orders_v2", "conform_rejects",
    "record_fingerprint", "text_preview", "email_validity", "retry_queue",
])
def test_row_operators_do_not_shuffle(plans, name):
    assert exchanges(plans[name]) == 0


@pytest.mark.parametrize("name, shuffles", [
    ("order_metrics_v2", 1), ("payment_metrics", 1), ("notification_metrics", 1), ("merchant_payment_stats", 1),
    ("dedup_repeated_batch", 1), ("param_scan", 1),
])
def test_number_of_shuffles(plans, name, shuffles):
    assert exchanges(plans[name]) == shuffles


@pytest.mark.parametrize("name, columns", [
    ("order_daily", {"o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"}),
    ("payment_metrics", {"l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"}),
    ("required_fields_check", {"l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"}),
])
def test_scans_read_only_what_is_needed(plans, name, columns):
    listed = re.search(r"FileScan parquet \[(.*?)\]", plans[name]).group(1)
    assert {c.split("#")[0] for c in listed.split(",")} == columns


@pytest.mark.parametrize("name", ["order_daily", "payment_daily", "daily_active_users", "previous_day_slice"])
def test_time_filters_reach_the_scan(plans, name):
    assert "GreaterThanOrEqual(" in plans[name].split("PushedFilters")[1]


def test_texts_are_never_shuffled(plans):
    assert [n for n, plan in plans.items() if any("Exchange " in line and "text#" in line for line in plan.splitlines())] == []

"""Physical-plan shapes the scale design relies on."""

import re

import pytest

import __spark_entry__ as entry
from sf_dirs import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they look when no side is small enough to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_payment_fact_has_no_window(spark):
    plan = _plan(entry.queries()["fact_payment_summary"](spark, SF_SMALL))
    assert "Window" not in plan
    assert "max_by" in plan


def test_payments_are_hashed_before_the_first_exchange(spark):
    """No sort on the raw payments: HashAggregate from the scan to the exchange."""
    from stratum.plans import gold
    from stratum.sources import retail
    df = gold.payment_totals(retail.order_payments(spark, SF_SMALL))
    lines = _plan(df).splitlines()
    assert not any("SortAggregate(keys=[order_id" in x and "payment_type" in x.split("functions")[0] for x in lines)
    first = max(k for k, x in enumerate(lines) if "Exchange hashpartitioning" in x)     # the deepest
    below = "\n".join(lines[first + 1:])
    assert "HashAggregate(keys=[order_id" in below and "Sort" not in below


def test_latest_per_key_limits_before_the_shuffle(spark):
    plan = _plan(entry.queries()["latest_per_key"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(entry.queries()["fact_sales"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all("l_comment" not in s and "l_quantity" not in s for s in lineitem)


def test_seller_fact_aggregates_items_before_joining_sellers(spark, no_broadcast):
    df = entry.queries()["fact_seller_performance"](spark, SF_SMALL)
    plan = _plan(df)
    # the join with the seller list has the per-seller aggregate as an input
    assert re.search(r"SortMergeJoin \[seller_id#\d+L\], \[seller_id#\d+L\], LeftOuter", plan)
    join_at = plan.index("SortMergeJoin [seller_id")
    assert "HashAggregate(keys=[seller_id" in plan[join_at:]

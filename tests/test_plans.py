"""Shape of the plans: narrow scans, pushed filters, no Cartesian product."""

import pytest

import __spark_entry__ as entry
from conftest import DATA
from basketlens.plans.dashboard import select_rows
from basketlens.sources.retail import retail_orders

QUERIES = entry.queries()
# Their plans are those of fitted models, or belong to the optional part.
FITTED = ("op", "pipeline", "m4", "m5", "m6_f", "m7_f", "m8_f", "m9", "m10", "f0", "f1", "x", "io_load", "io_nonempty", "j1_r")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_channel_report_reads_only_its_columns(spark):
    text = plan(QUERIES["q11_device_channel"](spark, DATA))
    assert "lineitem" not in text and "customer.parquet" not in text
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in text
    assert text.count("FileScan") == 1


def test_unused_sources_are_not_joined(spark):
    assert "Join" not in plan(retail_orders(spark, DATA, ["Purchase_Amount", "Purchase_Month"]))
    assert "part.parquet" not in plan(retail_orders(spark, DATA, ["Return_Rate"]))


def test_filter_reaches_the_scan(spark):
    orders = retail_orders(spark, DATA, ["Purchase_Amount", "Purchase_Channel"])
    text = plan(orders.where("Purchase_Amount > 100").select("Purchase_Amount"))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,100.0)]" in text
    assert "o_orderstatus" in plan(select_rows(orders, Purchase_Channel=["Online"]))


@pytest.mark.parametrize("name", ["q03_top_categories", "q12_top_locations", "w07_sample", "w10_preview"])
def test_limits_are_top_k(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, DATA))


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if not n.startswith(FITTED)])
def test_no_cartesian_product(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text

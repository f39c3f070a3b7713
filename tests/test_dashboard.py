"""The dashboard cube, and plans that read no more than they need."""

import __spark_entry__ as entry
from basketlens.plans import dashboard
from basketlens.sources.retail import first_orders, retail_orders
from conftest import DATA

NEEDED = [*dashboard.FILTERS, "Customer_ID", "Age", "Purchase_Amount", "Customer_Satisfaction", "Time_of_Purchase", "Purchase_Category", "Payment_Method",
          "Frequency_of_Purchase"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(frame):
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in frame.collect()]


def test_cube_gives_what_the_filtered_rows_give(spark):
    orders = retail_orders(spark, DATA, NEEDED)
    cube = dashboard.DashboardCube(orders)
    for choice in ((), (["Online"], [], ["Female"]), ([], ["Low", "High"], []), (["No such channel"], [], [])):
        kept = cube.datasets(*choice)
        with dashboard.dashboard(orders, *choice) as direct:
            for name, frame in direct.items():
                got = kept[name].drop("Customer_ID") if name == "scatter" else kept[name]
                assert got.columns == frame.columns and rows(got) == rows(frame), (name, choice)


def test_a_choice_that_comes_again_reads_nothing(spark):
    cube = dashboard.DashboardCube(retail_orders(spark, DATA, NEEDED))
    first = cube.datasets(["Online", "Mixed"], [], ["Male"])
    again = cube.datasets(("Mixed", "Online"), (), ("Male",))
    assert all(again[name] is frame for name, frame in first.items())
    assert all("FileScan" not in plan(frame) for frame in again.values())
    # Other choices read the cube, not the orders.
    assert "orders.parquet" not in plan(cube.cells) + plan(cube.samples)


def test_new_orders_replace_what_was_kept(spark):
    orders = retail_orders(spark, DATA, NEEDED)
    cube = dashboard.DashboardCube(orders)
    whole = cube.datasets()["kpi"].first().n
    cube.refresh(orders.where("Age < 40"))
    assert 0 < cube.datasets()["kpi"].first().n < whole


def test_preview_joins_only_its_own_orders(spark):
    text = plan(first_orders(spark, DATA, 50))
    for table, key in (("lineitem", "l_orderkey"), ("customer", "c_custkey"), ("orders", "o_orderkey")):
        assert f"{key}#" in text and f"PushedFilters: [In({key}" in text.replace("IsNotNull(" + key + "),", "") or f"{key} IN" in text, table


def test_shape_reads_the_order_file_alone(spark):
    text = plan(entry.queries()["c_shape"](spark, DATA))
    assert text.count("FileScan") == 1 and "Join" not in text


def test_correlations_read_one_written_table(spark, monkeypatch):
    from basketlens.operators import explore

    written = []
    original = explore.materialise
    monkeypatch.setattr(explore, "materialise", lambda df, name: written.append(plan(df)) or original(df, name))
    frame = retail_orders(spark, DATA, ["Age", "Purchase_Amount", "Research_Hours"])
    assert explore.correlations(frame, frame.columns).count() == 9
    assert len(written) == 1 and written[0].count("lineitem.parquet") == 1

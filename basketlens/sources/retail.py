"""The order table as a view over a retail star schema.

Each output column names the inputs it needs, and only those inputs are joined,
so a report on channel and amount is one narrow scan of the order file.  Every
join is a left join on a unique key: leaving one out never changes the rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.operators.clean import add_calendar, add_flags
from basketlens.operators.skew import salted_left_join


def _pick(index: str, *names: str) -> str:
    quoted = ", ".join('"' + name + '"' for name in names)
    return f"element_at(array({quoted}), cast({index} as int) + 1)"


# name -> (inputs beside the order file, SQL expression).  Fixed values: the level names in the expressions.
COLUMNS: dict[str, tuple[set[str], str]] = {
    "Customer_ID": (set(), "cast(o_orderkey as string)"),
    "Age": (set(), "cast(18 + o_custkey % 53 as int)"),
    "Gender": (set(), _pick("o_custkey % 2", "Female", "Male")),
    "Income_Level": (
        {"customer"},
        "case when c_acctbal < 2500 then 'Low' when c_acctbal < 6500 then 'Middle' else 'High' end",
    ),
    "Marital_Status": (
        {"customer"},
        _pick("(o_custkey * 3 + c_nationkey) % 4", "Single", "Married", "Divorced", "Widowed"),
    ),
    "Education_Level": (
        {"customer"},
        _pick("(o_custkey + c_nationkey) % 5", "High School", "Bachelor's", "Master's", "PhD", "Other"),
    ),
    "Occupation": ({"customer"}, "c_mktsegment"),
    "Location": ({"customer", "nation"}, "n_name"),
    "Purchase_Category": ({"lines", "part"}, "ptype"),
    "Purchase_Amount": (set(), "o_totalprice"),
    "Frequency_of_Purchase": ({"frequency"}, "cast(freq as int)"),
    "Purchase_Channel": (
        set(),
        "case o_orderstatus when 'F' then 'Online' when 'O' then 'In-Store' when 'P' then 'Mixed' end",
    ),
    "Brand_Loyalty": ({"lines"}, "cast(case when n_lines > 5 then 5 else n_lines end as int)"),
    "Product_Rating": (set(), "cast(1 + (o_orderkey * 3) % 5 as int)"),
    "Research_Hours": ({"lines"}, "cast(qty as double) / (n_lines * 10)"),
    "Social_Media_Influence": (set(), _pick("(o_orderkey + o_custkey) % 4", "None", "Low", "Medium", "High")),
    "Discount_Sensitivity": (
        {"lines"},
        "case when disc_pct < n_lines * 4 then 'Not Sensitive' when disc_pct < n_lines * 6 then 'Somewhat Sensitive' "
        "when n_lines is not null then 'Very Sensitive' end",
    ),
    "Return_Rate": ({"lines"}, "cast(coalesce(n_ret, 0) as int)"),
    "Customer_Satisfaction": (set(), "cast(1 + (o_orderkey * 7 + o_custkey) % 10 as int)"),
    "Engagement_with_Ads": (
        set(),
        "case substr(o_orderpriority, 1, 1) when '1' then 'High' when '2' then 'High' when '3' then 'Medium' "
        "when '5' then 'Low' else 'None' end",
    ),
    "Device_Used_for_Shopping": (set(), _pick("o_custkey % 3", "Smartphone", "Tablet", "Desktop")),
    "Payment_Method": (
        {"customer"},
        _pick("(o_orderkey + c_nationkey) % 5", "Credit Card", "Debit Card", "PayPal", "Cash", "Other"),
    ),
    "Time_of_Purchase": (set(), "o_orderdate"),
    "Discount_Used": ({"lines"}, "case when max_disc >= 0.08 then 1 else 0 end"),
    "Customer_Loyalty_Program_Member": ({"customer"}, "case when c_acctbal > 5000 then 1 else 0 end"),
    "Purchase_Intent": (
        set(),
        _pick("(o_orderkey + 2 * o_custkey) % 4", "Planned", "Impulsive", "Need-based", "Wants-based"),
    ),
    "Shipping_Preference": (set(), _pick("o_orderkey % 3", "Standard", "Express", "No Preference")),
    "Time_to_Decision": (
        {"lines"},
        "case when n_lines is not null then cast(1 + (o_orderkey * 11 + o_custkey) % 20 as int) end",
    ),
}

# Derived columns and the source column each comes from.
DERIVED = {
    "Purchase_Month": "Time_of_Purchase",
    "Purchase_Quarter": "Time_of_Purchase",
    "Purchase_DayOfWeek": "Time_of_Purchase",
    "High_Satisfaction": "Customer_Satisfaction",
    "Is_Loyal": "Brand_Loyalty",
}


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


def _among(column: str, values: list[int] | None) -> Column:
    return F.lit(True) if values is None else F.col(column).isin(values)


def _with_customer(spark: SparkSession, path: str, orders: DataFrame, needs: set[str], keys: list[int] | None) -> DataFrame:
    whole, people = orders, None
    if keys is not None:
        orders = orders.where(_among("o_orderkey", keys))
        people = [r[0] for r in orders.select("o_custkey").where("o_custkey is not null").distinct().collect()]
    customer = None
    if needs & {"customer", "nation"}:
        customer = read_table(spark, path, "customer").where(_among("c_custkey", people)).select(
            F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal", "c_mktsegment"
        )
        if "nation" in needs:
            nation = read_table(spark, path, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
            customer = customer.join(nation, "c_nationkey", "left")
    if "frequency" not in needs:
        return orders.join(customer, "o_custkey", "left")
    counts = whole.where(_among("o_custkey", people)).groupBy("o_custkey").agg(F.count("*").alias("freq"))
    dim = counts if customer is None else counts.join(customer, "o_custkey", "left")
    return salted_left_join(orders, dim, counts, "o_custkey", "freq", F.col("o_orderkey"))


def _order_lines(spark: SparkSession, path: str, with_part: bool, keys: list[int] | None) -> DataFrame:
    lines = read_table(spark, path, "lineitem").where(_among("l_orderkey", keys))
    measures = [
        F.count("*").alias("n_lines"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
        F.sum(F.rint(F.col("l_discount") * 100).cast("bigint")).alias("disc_pct"),
        F.max("l_discount").alias("max_disc"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_ret"),
    ]
    if with_part:
        part = read_table(spark, path, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
        lines = lines.join(part, "l_partkey", "left")
        measures.append(F.min("p_type").alias("ptype"))
    return lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(*measures)


def retail_orders(spark: SparkSession, path: str, columns: Iterable[str] | None = None, keys: list[int] | None = None) -> DataFrame:
    """Typed orders with the five derived columns, or only the named columns.

    With ``keys``, a short list of order keys, only those orders; the list reaches the scans of every input, so that the joins see the few rows they need.
    """
    wanted = list(columns) if columns is not None else [*COLUMNS, *DERIVED]
    sources = {DERIVED.get(name, name) for name in wanted}
    needs = set().union(*(COLUMNS[name][0] for name in sources))
    orders = read_table(spark, path, "orders")
    if needs & {"customer", "nation", "frequency"}:
        orders = _with_customer(spark, path, orders, needs, keys)
    if needs & {"lines", "part"}:
        orders = orders.join(_order_lines(spark, path, "part" in needs, keys), "o_orderkey", "left")
    if keys is not None:
        orders = orders.where(_among("o_orderkey", keys))
    typed = orders.selectExpr(*[f"{sql} as {name}" for name, (_, sql) in COLUMNS.items() if name in sources])
    if "Time_of_Purchase" in sources:
        typed = add_calendar(typed)
    return add_flags(typed).select(*wanted)


def first_orders(spark: SparkSession, path: str, size: int) -> DataFrame:
    """The ``size`` orders with the smallest ``Customer_ID``: their keys from the order file first, then the wide rows of those alone."""
    keys = read_table(spark, path, "orders").select("o_orderkey").orderBy(F.col("o_orderkey").cast("string")).limit(size)
    return retail_orders(spark, path, keys=[r[0] for r in keys.collect()])

"""The retail orders as untidy text, the input the cleaning step expects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketlens.sources.retail import COLUMNS, retail_orders

# Headers as they arrive: one with parentheses, one with a trailing blank.
HEADERS = {"Research_Hours": "Time_Spent_on_Product_Research(hours)", "Purchase_Category": "Purchase_Category "}
RAW_NAMES = [HEADERS.get(name, name) for name in COLUMNS]


def raw_orders(spark: SparkSession, path: str) -> DataFrame:
    """Every order as 28 text columns, spoiled by rules on the order key."""
    typed = retail_orders(spark, path, list(COLUMNS))
    key = "cast(Customer_ID as bigint)"
    spoiled = []
    for name, data_type in typed.dtypes:
        text = f"cast({name} as string)"
        if name == "Purchase_Amount":
            text = f"if({key} % 17 = 0, '', concat('$', {text}, ' '))"
        elif name in ("Discount_Used", "Customer_Loyalty_Program_Member"):
            text = f"if({name} = 1, 'TRUE', 'false')"
        elif name == "Age":
            text = f"if({key} % 11 = 0, '', {text})"
        elif name == "Time_of_Purchase":
            text = f"if({key} % 13 = 0, 'not a date', date_format({name}, 'yyyy-MM-dd HH:mm:ss'))"
        elif data_type == "string":
            text = f"if({key} % 7 = 0, concat('  ', {name}, '  '), {name})"
        spoiled.append(f"{text} as `{HEADERS.get(name, name)}`")
    return typed.selectExpr(*spoiled)

"""Cleaning of raw text orders into the typed order table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.functions import text
from basketlens.operators.quantiles import exact_quantiles

# Header spelling after normalising, renamed to the short name.
RENAMES = {"Time_Spent_on_Product_Research_hours_": "Research_Hours"}

WHOLE = [
    "Frequency_of_Purchase", "Brand_Loyalty", "Product_Rating", "Return_Rate", "Customer_Satisfaction",
]
REAL = ["Age", "Research_Hours", "Time_to_Decision"]
FLAGS = ["Discount_Used", "Customer_Loyalty_Program_Member"]
REQUIRED = ["Customer_ID", "Purchase_Amount", "Customer_Satisfaction"]
MEDIAN_FILLED = ["Age", "Research_Hours", "Time_to_Decision"]
FILL_TEXT = "Unknown"


def normalise_names(raw: DataFrame) -> DataFrame:
    """Trim headers, turn blanks and parentheses into ``_``, apply the fixed rename."""
    names = [re.sub(r"[\s()]", "_", name.strip()) for name in raw.columns]
    return raw.toDF(*[RENAMES.get(name, name) for name in names])


def add_calendar(orders: DataFrame, column: str = "Time_of_Purchase") -> DataFrame:
    """Month, quarter and weekday (Monday is 0); null where the time is null."""
    return orders.withColumns(
        {
            "Purchase_Month": F.month(column),
            "Purchase_Quarter": F.quarter(column),
            "Purchase_DayOfWeek": F.weekday(column),
        }
    )


def at_least(column: str, limit: int) -> Column:
    """1 when the value reaches the limit; 0 otherwise, null included."""
    return F.coalesce(F.col(column) >= limit, F.lit(False)).cast("int")


def add_flags(orders: DataFrame) -> DataFrame:
    """High satisfaction (7 or more) and loyalty (4 or more), for the columns present."""
    flags = {}
    if "Customer_Satisfaction" in orders.columns:
        flags["High_Satisfaction"] = at_least("Customer_Satisfaction", 7)
    if "Brand_Loyalty" in orders.columns:
        flags["Is_Loyal"] = at_least("Brand_Loyalty", 4)
    return orders.withColumns(flags)


def parse(
    raw: DataFrame, na_tokens: list[str] = text.NA_TOKENS, date_formats: list[str] = text.DATE_FORMATS
) -> DataFrame:
    """Text columns to typed columns: one projection trims and takes out missing tokens, the next types.  Other columns pass."""
    other = {f.name for f in raw.schema if not isinstance(f.dataType, T.StringType)}
    trimmed = raw.selectExpr(*[f"`{n}`" if n in other else f"{text.missing_to_null(f'`{n}`', na_tokens)} as `{n}`" for n in raw.columns])
    typed = []
    for name in raw.columns:
        column = f"`{name}`"
        if name in other:
            pass
        elif name == "Purchase_Amount":
            column = text.money(column)
        elif name == "Time_of_Purchase":
            column = text.timestamp(column, date_formats)
        elif name in FLAGS:
            column = text.flag(column)
        elif name in WHOLE:
            column = text.whole_number(column)
        elif name in REAL:
            column = text.number(column)
        else:
            column = f"trim({column})"
        typed.append(f"{column} as `{name}`")
    return trimmed.selectExpr(*typed)


def drop_incomplete(orders: DataFrame) -> DataFrame:
    return orders.dropna(subset=REQUIRED)


def fill_medians(orders: DataFrame, columns: list[str] = MEDIAN_FILLED) -> DataFrame:
    """Fill nulls with the exact median."""
    found = exact_quantiles(orders, columns, [0.5])
    medians = {q.variable: F.lit(q.values[0]) for q in found}
    return orders.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), medians.get(c, F.lit(None))) for c in columns}
    )


def fill_text(orders: DataFrame, value: str = FILL_TEXT) -> DataFrame:
    strings = [f.name for f in orders.schema if isinstance(f.dataType, T.StringType)]
    return orders.fillna(value, subset=strings)


def clean_orders(raw: DataFrame, na_tokens: list[str] = text.NA_TOKENS) -> DataFrame:
    """Raw text orders to the clean table: parse, drop, fill, derive."""
    complete = drop_incomplete(add_calendar(parse(normalise_names(raw), na_tokens)))
    return add_flags(fill_text(fill_medians(complete)))

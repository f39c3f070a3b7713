"""Aggregate expressions shared by the reports.

Money is summed in whole cents as ``bigint``: exact, independent of task order
and inside whole-stage codegen, while a sum of doubles would change with the
partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(column: str) -> Column:
    return F.rint(F.col(column) * 100).cast("bigint")


def money_total(column: str = "Purchase_Amount") -> Column:
    return F.sum(cents(column)) / F.lit(100.0)


def money_mean(column: str = "Purchase_Amount") -> Column:
    return F.try_divide(F.sum(cents(column)) / F.lit(100.0), F.count(column))


def percent(flag: str) -> Column:
    """Share of all rows with the 0/1 flag set, in percent (null flags count as rows)."""
    return F.lit(100.0) * F.sum(flag) / F.count("*")


def share_where(condition: Column) -> Column:
    """Fraction of all rows that satisfy ``condition``; null is not satisfied."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


# Report measures by output name: (expression, decimals or None).
MEASURES = {
    "total_orders": (lambda: F.count("*"), None),
    "num_orders": (lambda: F.count("*"), None),
    "num_customers": (lambda: F.count("*"), None),
    "avg_order_value": (money_mean, 2),
    "aov": (money_mean, 2),
    "total_revenue": (money_total, 2),
    "monthly_revenue": (money_total, 2),
    "avg_satisfaction": (lambda: F.avg("Customer_Satisfaction"), 2),
    "avg_return_rate": (lambda: F.avg("Return_Rate"), 2),
    "avg_frequency": (lambda: F.avg("Frequency_of_Purchase"), 1),
    "avg_brand_loyalty": (lambda: F.avg("Brand_Loyalty"), 2),
    "avg_research_hours": (lambda: F.avg("Research_Hours"), 2),
    "avg_decision_time": (lambda: F.avg("Time_to_Decision"), 1),
    "total_discount_used": (lambda: F.sum("Discount_Used"), None),
    "discount_usage_pct": (lambda: percent("Discount_Used"), 1),
    "discount_pct": (lambda: percent("Discount_Used"), 1),
    "loyalty_member_pct": (lambda: percent("Customer_Loyalty_Program_Member"), 1),
}


def measure(name: str, decimals: int | None = None) -> Column:
    """The named measure, rounded as reports print it unless ``decimals`` overrides."""
    build, default = MEASURES[name]
    places = default if decimals is None else decimals
    column = build() if places is None else F.round(build(), places)
    return column.alias(name)

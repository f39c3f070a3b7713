"""The KPI views and the catalogue of business reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions import bands
from basketlens.operators.report import Report, run_report

VIEWS = {
    "vw_kpi_overview": Report(
        measures=[
            "total_orders", "avg_order_value", "total_revenue", "avg_return_rate", "avg_satisfaction",
            "total_discount_used", "discount_usage_pct",
        ],
        decimals={"avg_return_rate": 3},
    ),
    "vw_revenue_by_channel": Report(
        keys=["Purchase_Channel"],
        measures=["num_orders", "aov", "total_revenue", "avg_satisfaction"],
        order=["-total_revenue"],
    ),
    "vw_demographics": Report(
        keys=["Income_Level", "Gender", "Education_Level"],
        measures=["num_customers", "aov", "avg_frequency", "avg_brand_loyalty"],
        order=["-num_customers"],
    ),
}

REPORTS = {
    "kpis": Report(
        measures=[
            "total_orders", "avg_order_value", "total_revenue", "avg_return_rate", "avg_satisfaction",
            "discount_usage_pct", "loyalty_member_pct",
        ],
        decimals={"avg_return_rate": 3},
    ),
    "revenue_by_channel": Report(
        keys=["Purchase_Channel"],
        measures=["num_orders", "total_revenue", "aov", "avg_satisfaction", "avg_return_rate"],
        order=["-total_revenue"],
    ),
    "top_categories": Report(
        keys=["Purchase_Category"],
        measures=["num_orders", "total_revenue", "aov", "avg_return_rate"],
        order=["-total_revenue"],
        limit=10,
    ),
    "income_gender": Report(
        keys=["Income_Level", "Gender"],
        measures=["num_customers", "aov", "avg_frequency", "avg_brand_loyalty", "avg_satisfaction"],
        order=["Income_Level", "Gender"],
    ),
    "discount_effect": Report(
        keys=[
            "Discount_Sensitivity",
            ("Discount_Group", lambda: bands.either("Discount_Used", "Used Discount", "No Discount")),
        ],
        measures=["num_orders", "aov", "avg_satisfaction", "avg_return_rate"],
        order=["Discount_Sensitivity", "Discount_Group"],
        needs=["Discount_Used"],
    ),
    "monthly_trend": Report(
        keys=["Purchase_Month"],
        measures=[("Purchase_Quarter", lambda: F.min("Purchase_Quarter")), "num_orders", "monthly_revenue",
                  "avg_satisfaction"],
        order=["Purchase_Month"],
        where="Purchase_Month is not null",
        needs=["Purchase_Quarter"],
    ),
    "payment_method": Report(
        keys=["Payment_Method"],
        measures=["num_orders", "aov", "avg_satisfaction", "discount_usage_pct"],
        order=["-num_orders"],
    ),
    "loyalty_program": Report(
        keys=[("Loyalty_Status", lambda: bands.either("Customer_Loyalty_Program_Member", "Member", "Non-Member"))],
        measures=["num_customers", "aov", "avg_frequency", "avg_satisfaction", "avg_return_rate",
                  "avg_brand_loyalty"],
        needs=["Customer_Loyalty_Program_Member"],
    ),
    "social_intent": Report(
        keys=["Social_Media_Influence", "Purchase_Intent"],
        measures=["num_orders", "aov", "avg_satisfaction"],
        order=["Social_Media_Influence", "-num_orders"],
    ),
    "shipping": Report(
        keys=["Shipping_Preference"],
        measures=["num_orders", "avg_decision_time", "avg_satisfaction", "avg_return_rate"],
        order=["-avg_satisfaction"],
    ),
    "device_channel": Report(
        keys=["Device_Used_for_Shopping", "Purchase_Channel"],
        measures=["num_orders", "aov"],
        order=["Device_Used_for_Shopping", "-num_orders"],
    ),
    "top_locations": Report(
        keys=["Location"],
        measures=["num_orders", "total_revenue", "avg_satisfaction"],
        order=["-total_revenue"],
        limit=10,
    ),
    "marital_status": Report(
        keys=["Marital_Status"],
        measures=["num_customers", "aov", "avg_frequency", "avg_satisfaction", "avg_return_rate"],
        order=["-aov"],
    ),
    "education": Report(
        keys=["Education_Level"],
        measures=["num_customers", "aov", "avg_frequency", "avg_research_hours", "avg_satisfaction",
                  "avg_brand_loyalty"],
        order=["-aov"],
    ),
    "occupation": Report(
        keys=["Occupation"],
        measures=["num_customers", "total_revenue", "aov", "avg_brand_loyalty", "avg_satisfaction"],
        order=["-total_revenue"],
    ),
    "product_rating": Report(
        keys=["Product_Rating"],
        measures=["num_orders", "aov", "avg_satisfaction", "avg_return_rate", "avg_brand_loyalty"],
        order=["Product_Rating"],
    ),
    "decision_speed": Report(
        keys=[("Decision_Speed", bands.decision_band)],
        measures=["num_orders", "aov", "avg_satisfaction", "avg_return_rate", "discount_pct"],
        order=["mean_time"],
        hidden={"mean_time": lambda: F.avg("Time_to_Decision")},
        needs=["Time_to_Decision"],
    ),
    "ads_intent": Report(
        keys=["Engagement_with_Ads", "Purchase_Intent"],
        measures=["num_orders", "aov", "avg_satisfaction", "avg_brand_loyalty"],
        order=["Engagement_with_Ads", "-num_orders"],
    ),
    "quarter": Report(
        keys=["Purchase_Quarter"],
        measures=["num_orders", "total_revenue", "aov", "avg_satisfaction"],
        order=["Purchase_Quarter"],
        where="Purchase_Quarter is not null",
    ),
    "weekday": Report(
        keys=["Purchase_DayOfWeek"],
        measures=["num_orders", "total_revenue", "aov"],
        order=["Purchase_DayOfWeek"],
        where="Purchase_DayOfWeek is not null",
    ),
}

# Source column of each measure, for narrow scans.
_INPUT = {
    "avg_order_value": "Purchase_Amount", "aov": "Purchase_Amount", "total_revenue": "Purchase_Amount",
    "monthly_revenue": "Purchase_Amount", "avg_satisfaction": "Customer_Satisfaction",
    "avg_return_rate": "Return_Rate", "avg_frequency": "Frequency_of_Purchase",
    "avg_brand_loyalty": "Brand_Loyalty", "avg_research_hours": "Research_Hours",
    "avg_decision_time": "Time_to_Decision", "total_discount_used": "Discount_Used",
    "discount_usage_pct": "Discount_Used", "discount_pct": "Discount_Used",
    "loyalty_member_pct": "Customer_Loyalty_Program_Member",
}


def inputs(spec: Report) -> list[str]:
    """The order columns a report reads (at least one, to count rows)."""
    names = [k for k in spec.keys if isinstance(k, str)]
    names += [_INPUT[m] for m in spec.measures if isinstance(m, str) and m in _INPUT]
    return list(dict.fromkeys([*names, *spec.needs])) or ["Customer_ID"]


def view(orders: DataFrame, name: str) -> DataFrame:
    return run_report(orders, VIEWS[name])


def report(orders: DataFrame, name: str) -> DataFrame:
    result = run_report(orders, REPORTS[name])
    if name == "weekday":
        day = bands.weekday_name()
        return result.select(day.alias("Day_Name"), "num_orders", "total_revenue", "aov")
    return result


def publish_views(orders: DataFrame, table: str = "orders") -> list[str]:
    """Register the table and the three KPI views in the session."""
    orders.createOrReplaceTempView(table)
    for name in VIEWS:
        view(orders, name).createOrReplaceTempView(name)
    return list(VIEWS)

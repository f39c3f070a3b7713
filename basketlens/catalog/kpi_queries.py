"""KPI views and business reports."""

from __future__ import annotations

from basketlens.catalog.oracle_base import grouped, listed, stepped
from basketlens.functions import bands
from basketlens.plans import kpi
from basketlens.sources.retail import retail_orders

NAMES = {
    "q01_kpis": "kpis",
    "q02_revenue_by_channel": "revenue_by_channel",
    "q03_top_categories": "top_categories",
    "q04_income_gender": "income_gender",
    "q05_discount_effect": "discount_effect",
    "q06_monthly_trend": "monthly_trend",
    "q07_payment_method": "payment_method",
    "q08_loyalty_program": "loyalty_program",
    "q09_social_intent": "social_intent",
    "q10_shipping": "shipping",
    "q11_device_channel": "device_channel",
    "q12_top_locations": "top_locations",
    "q13_marital_status": "marital_status",
    "q14_education": "education",
    "q15_occupation": "occupation",
    "q16_product_rating": "product_rating",
    "q17_decision_speed": "decision_speed",
    "q18_ads_intent": "ads_intent",
    "q19a_quarter": "quarter",
    "q19b_weekday": "weekday",
}

VIEW_NAMES = {
    "v1_kpi_overview": "vw_kpi_overview",
    "v2_revenue_by_channel": "vw_revenue_by_channel",
    "v3_demographics": "vw_demographics",
}


def _report(name):
    def run(spark, path):
        return kpi.report(retail_orders(spark, path, kpi.inputs(kpi.REPORTS[name])), name)

    return run


def _view(name):
    def run(spark, path):
        return kpi.view(retail_orders(spark, path, kpi.inputs(kpi.VIEWS[name])), name)

    return run


QUERIES = {key: _view(name) for key, name in VIEW_NAMES.items()}
QUERIES |= {key: _report(name) for key, name in NAMES.items()}

DAY = "Day_Name=" + listed("Purchase_DayOfWeek", bands.WEEKDAYS)
SPEED = "Decision_Speed=" + stepped("Time_to_Decision", bands.DECISION_BANDS, bands.DECISION_REST)

ORACLE = {
    "v1_kpi_overview": grouped(
        "", "total_orders avg_order_value total_revenue avg_return_rate_3 avg_satisfaction "
        "total_discount_used discount_usage_pct"),
    "v2_revenue_by_channel": grouped("Purchase_Channel", "num_orders aov total_revenue avg_satisfaction"),
    "v3_demographics": grouped(
        "Income_Level; Gender; Education_Level", "num_customers aov avg_frequency avg_brand_loyalty"),
    "q01_kpis": grouped(
        "", "total_orders avg_order_value total_revenue avg_return_rate_3 avg_satisfaction "
        "discount_usage_pct loyalty_member_pct"),
    "q02_revenue_by_channel": grouped(
        "Purchase_Channel", "num_orders total_revenue aov avg_satisfaction avg_return_rate"),
    "q03_top_categories": grouped(
        "Purchase_Category", "num_orders total_revenue aov avg_return_rate",
        "ORDER BY total_revenue DESC, Purchase_Category LIMIT 10"),
    "q04_income_gender": grouped(
        "Income_Level; Gender", "num_customers aov avg_frequency avg_brand_loyalty avg_satisfaction"),
    "q05_discount_effect": grouped(
        "Discount_Sensitivity; Discount_Group=CASE WHEN Discount_Used = 1 THEN 'Used Discount' "
        "ELSE 'No Discount' END", "num_orders aov avg_satisfaction avg_return_rate"),
    "q06_monthly_trend": grouped(
        "Purchase_Month", "Purchase_Quarter num_orders monthly_revenue avg_satisfaction",
        where="Purchase_Month IS NOT NULL"),
    "q07_payment_method": grouped("Payment_Method", "num_orders aov avg_satisfaction discount_usage_pct"),
    "q08_loyalty_program": grouped(
        "Loyalty_Status=CASE WHEN Customer_Loyalty_Program_Member = 1 THEN 'Member' ELSE 'Non-Member' END",
        "num_customers aov avg_frequency avg_satisfaction avg_return_rate avg_brand_loyalty"),
    "q09_social_intent": grouped("Social_Media_Influence; Purchase_Intent", "num_orders aov avg_satisfaction"),
    "q10_shipping": grouped("Shipping_Preference", "num_orders avg_decision_time avg_satisfaction avg_return_rate"),
    "q11_device_channel": grouped("Device_Used_for_Shopping; Purchase_Channel", "num_orders aov"),
    "q12_top_locations": grouped(
        "Location", "num_orders total_revenue avg_satisfaction", "ORDER BY total_revenue DESC, Location LIMIT 10"),
    "q13_marital_status": grouped(
        "Marital_Status", "num_customers aov avg_frequency avg_satisfaction avg_return_rate"),
    "q14_education": grouped(
        "Education_Level",
        "num_customers aov avg_frequency avg_research_hours avg_satisfaction avg_brand_loyalty"),
    "q15_occupation": grouped("Occupation", "num_customers total_revenue aov avg_brand_loyalty avg_satisfaction"),
    "q16_product_rating": grouped(
        "Product_Rating", "num_orders aov avg_satisfaction avg_return_rate avg_brand_loyalty"),
    "q17_decision_speed": grouped(SPEED, "num_orders aov avg_satisfaction avg_return_rate discount_pct"),
    "q18_ads_intent": grouped(
        "Engagement_with_Ads; Purchase_Intent", "num_orders aov avg_satisfaction avg_brand_loyalty"),
    "q19a_quarter": grouped("Purchase_Quarter", "num_orders total_revenue aov avg_satisfaction"),
    "q19b_weekday": grouped(DAY, "num_orders total_revenue aov"),
}

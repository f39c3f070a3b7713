"""One dataset per exploratory chart, over the order table.

Exploration drops rows whose group key is null; reports keep them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions import bands
from basketlens.functions.measures import money_mean, money_total
from basketlens.operators import explore, quality

# The columns of the correlation chart.
CORRELATED = [
    "Age", "Purchase_Amount", "Frequency_of_Purchase", "Brand_Loyalty", "Product_Rating", "Research_Hours",
    "Return_Rate", "Customer_Satisfaction", "Time_to_Decision",
]

# Output name -> aggregate.
_AGGREGATES = {
    "total_revenue": money_total,
    "total_rev": money_total,
    "revenue": money_total,
    "aov": money_mean,
    "avg_amount": money_mean,
    "num_orders": lambda: F.count("Customer_ID"),
    "orders": lambda: F.count("Customer_ID"),
    "count": lambda: F.count("Customer_ID"),
    "avg_satisfaction": lambda: F.avg("Customer_Satisfaction"),
    "avg_sat": lambda: F.avg("Customer_Satisfaction"),
    "avg_freq": lambda: F.avg("Frequency_of_Purchase"),
    "avg_research": lambda: F.avg("Research_Hours"),
    "avg_loyalty": lambda: F.avg("Brand_Loyalty"),
    "sd_loyalty": lambda: F.stddev_samp("Brand_Loyalty"),
    "avg_ret": lambda: F.avg("Return_Rate"),
    "avg_dec": lambda: F.avg("Time_to_Decision"),
    "discount_rate": lambda: F.avg("Discount_Used"),
    "loyalty_mem_rate": lambda: F.avg("Customer_Loyalty_Program_Member"),
    "avg_intent_imp": lambda: F.avg(F.expr("if(Purchase_Intent = 'Impulsive', 1, 0)")) * 100,
}


def summary(df: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Named aggregates per non-null key."""
    return df.dropna(subset=[key]).groupBy(key).agg(*[_AGGREGATES[n]().alias(n) for n in names])


def kpi_texts(orders: DataFrame) -> DataFrame:
    """The KPI dictionary, formatted as printed."""
    facts = orders.agg(
        F.count("*").alias("n"),
        money_total().alias("revenue"),
        money_mean().alias("aov"),
        F.avg("Customer_Satisfaction").alias("sat"),
        F.avg("Return_Rate").alias("ret"),
        (F.avg("Discount_Used") * 100).alias("disc"),
        (F.avg("Customer_Loyalty_Program_Member") * 100).alias("member"),
    )
    # Names and number formats of the printed figures.
    rows = {
        "Total Orders": "cast(n as string)",
        "Total Revenue ($)": "format_number(revenue, 2)",
        "AOV ($)": "format_number(aov, 2)",
        "Avg Satisfaction": "concat(format_number(sat, '0.00'), '/10')",
        "Avg Return Rate": "format_number(ret, '0.000')",
        "Discount Usage %": "concat(format_number(disc, '0.0'), '%')",
        "Loyalty Members %": "concat(format_number(member, '0.0'), '%')",
    }
    cells = ", ".join(f"struct('{k}' as kpi, {v} as value)" for k, v in rows.items())
    return facts.selectExpr(f"inline(array({cells}))")


def amount_histogram(orders):
    return explore.histogram(orders, "Purchase_Amount", 30)


def amount_box(orders):
    return explore.box_stats(orders, "Purchase_Amount")


def channel(orders):
    return summary(orders, "Purchase_Channel", ["total_revenue", "num_orders", "avg_satisfaction"]).orderBy(
        F.desc("total_revenue")
    )


def top_categories(orders):
    return explore.top_by_sum(orders, "Purchase_Category", 8)


def age_frequency(orders):
    return summary(orders.withColumn("Age_Group", bands.age_band()), "Age_Group", ["avg_freq"]).orderBy("Age_Group")


def income_gender_pivot(orders):
    return explore.pivot_mean(orders, "Income_Level", "Gender", money_mean())


def sensitivity_box(orders):
    kept = orders.where(F.col("Discount_Sensitivity").isin(bands.SENSITIVITY))
    box = explore.box_stats(kept, "Customer_Satisfaction", by="Discount_Sensitivity")
    return bands.in_level_order(box, "Discount_Sensitivity", bands.SENSITIVITY)


def intent_shares(orders):
    return explore.value_shares(orders, "Purchase_Intent")


def correlation_matrix(orders):
    return explore.correlations(orders, CORRELATED)


def influence_loyalty(orders):
    grouped = summary(orders, "Social_Media_Influence", ["avg_loyalty", "sd_loyalty"])
    return bands.in_level_order(grouped, "Social_Media_Influence", bands.INFLUENCE)


def monthly(orders):
    return summary(orders, "Purchase_Month", ["revenue", "orders"]).orderBy("Purchase_Month")


def marital(orders):
    return summary(orders, "Marital_Status", ["aov", "avg_sat", "count"]).orderBy(F.desc("aov"))


def education(orders):
    kept = orders.where(F.col("Education_Level").isin(bands.EDUCATION))
    grouped = summary(kept, "Education_Level", ["aov", "avg_freq", "avg_sat", "avg_research", "count"])
    return bands.in_level_order(grouped, "Education_Level", bands.EDUCATION)


def occupation(orders):
    return summary(orders, "Occupation", ["total_rev", "aov", "avg_freq", "avg_loyalty"]).orderBy("total_rev")


def top_locations(orders):
    extra = [F.count("Customer_ID").alias("num_orders"), F.avg("Customer_Satisfaction").alias("avg_sat")]
    return explore.top_by_sum(orders, "Location", 15, extra)


def rating(orders):
    return summary(orders, "Product_Rating", ["count", "avg_sat", "avg_ret"]).orderBy("Product_Rating")


def decision_histogram(orders):
    return explore.histogram(orders, "Time_to_Decision", 20)


def decision_line(orders):
    return explore.fitted_line(orders, "Time_to_Decision", "Customer_Satisfaction")


def decision_by(orders, key):
    return summary(orders, key, ["avg_dec"]).orderBy("avg_dec")


def weekday(orders):
    grouped = summary(orders, "Purchase_DayOfWeek", ["revenue", "orders", "avg_amount"])
    label: Column = bands.weekday_name(names=bands.WEEKDAYS_SHORT)
    return grouped.withColumn("label", label).orderBy("Purchase_DayOfWeek")


def quarter(orders):
    grouped = summary(orders, "Purchase_Quarter", ["revenue", "orders"])
    return grouped.withColumn("label", F.expr("concat('Q', Purchase_Quarter)")).orderBy("Purchase_Quarter")


def device_channel_pivot(orders):
    return explore.pivot_mean(orders, "Device_Used_for_Shopping", "Purchase_Channel", money_mean())


def engagement(orders):
    kept = orders.where(F.col("Engagement_with_Ads").isin(bands.ENGAGEMENT))
    grouped = summary(kept, "Engagement_with_Ads", ["aov", "avg_freq", "avg_intent_imp", "avg_sat"])
    return bands.in_level_order(grouped, "Engagement_with_Ads", bands.ENGAGEMENT)


def shipping(orders):
    return summary(orders, "Shipping_Preference", ["avg_sat", "avg_ret", "avg_dec", "count"]).orderBy(
        F.desc("avg_sat")
    )


def education_channel_pivot(orders):
    return explore.pivot_mean(
        orders, "Education_Level", "Purchase_Channel", F.avg("Customer_Satisfaction")
    )


def loyalty_bands(orders):
    names = ["aov", "avg_freq", "avg_sat", "avg_ret", "discount_rate", "loyalty_mem_rate"]
    return summary(orders.withColumn("Loyalty_Group", bands.loyalty_band()), "Loyalty_Group", names)


def data_quality(orders):
    """Missing values by column and number of columns by type, as one list."""
    missing = quality.missing_by_column(orders).selectExpr("'missing' as kind", "column_name as name", "missing as value")
    types = quality.column_types(orders).selectExpr("'type' as kind", "data_type as name", "columns as value")
    return missing.unionByName(types)

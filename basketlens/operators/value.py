"""Lifetime value and written insights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions import bands
from basketlens.functions.measures import money_mean, money_total
from basketlens.operators.explore import box_stats
from basketlens.operators.quantiles import exact_quantiles

LEAST_CHURN = 0.05

# The five insight sentences as printed.
CHANNEL_TEXT = "1. Kênh '%s' có AOV cao nhất ($%.2f). Ưu tiên tối ưu ROI Marketing."
LOYALTY_TEXT = "2. Loyalty Program tăng Hài Lòng thêm %.2f điểm. Cần mở rộng quy mô thẻ thành viên."
SOCIAL_TEXT = "3. Social Media ảnh hưởng trực tiếp đến AOV ($%.2f). Đẩy mạnh Influencer Campaigns."
EFFECT_TEXT = "4. Theo Causal Inference (PSM), ATE của Discount lên Return Rate là %.4f. %s"
EFFECT_UP = "Cần xem lại chính sách giảm giá."
EFFECT_DOWN = "Khuyến mãi đang phát huy tốt."
VALUE_TEXT = (
    "5. Khách hàng 'High CLV' chiếm %d người với chi tiêu cao. Phát triển dịch vụ VIP Care cho nhóm này."
)


def lifetime_value(orders: DataFrame) -> DataFrame:
    """Add ``Churn_Rate`` (1 - satisfaction/10, never 0) and ``CLV``."""
    churn = "1.0D - Customer_Satisfaction / 10.0D"
    return orders.withColumn(
        "Churn_Rate", F.expr(f"if({churn} = 0, {LEAST_CHURN}D, {churn})")
    ).withColumn("CLV", F.expr("Purchase_Amount * Frequency_of_Purchase / Churn_Rate"))


def value_segments(valued: DataFrame) -> DataFrame:
    """Add ``CLV_Segment``: terciles at interpolated quantiles, closed above; ties share a segment."""
    found = exact_quantiles(valued, ["CLV"], [1 / 3, 2 / 3])
    low, high = found[0].values if found else (None, None)
    value, (small, middle, large) = F.col("CLV"), bands.VALUE_SEGMENTS
    segment = F.when(value <= F.lit(low), small).when(value <= F.lit(high), middle).when(value.isNotNull(), large)
    return valued.withColumn("CLV_Segment", segment)


def mean_value(valued: DataFrame) -> DataFrame:
    return valued.agg(F.avg("CLV").alias("mean_clv"))


def segment_box(segmented: DataFrame) -> DataFrame:
    box = box_stats(segmented, "Purchase_Amount", by="CLV_Segment")
    return bands.in_level_order(box, "CLV_Segment", bands.VALUE_SEGMENTS)


def high_value_size(segmented: DataFrame) -> DataFrame:
    return segmented.where(F.col("CLV_Segment") == bands.VALUE_SEGMENTS[-1]).agg(F.count("*").alias("customers"))


def best_by_amount(orders: DataFrame, key: str) -> DataFrame:
    """The key with the highest mean amount."""
    return (
        orders.dropna(subset=[key]).groupBy(key).agg(money_mean().alias("aov")).orderBy(F.desc("aov"), key).limit(1)
    )


def loyalty_effect(orders: DataFrame) -> DataFrame:
    """Mean satisfaction of members minus non-members; an absent group counts as 0."""
    def mean(code: int) -> str:
        return f"coalesce(avg(if(Customer_Loyalty_Program_Member = {code}, Customer_Satisfaction, null)), 0.0D)"

    return orders.agg(F.expr(f"{mean(1)} - {mean(0)}").alias("effect"))


def research_correlation(orders: DataFrame) -> DataFrame:
    return orders.agg(F.corr("Research_Hours", F.col("Customer_Satisfaction").cast("double")).alias("r"))


def best_category(orders: DataFrame) -> DataFrame:
    totals = orders.dropna(subset=["Purchase_Category"]).groupBy("Purchase_Category")
    return totals.agg(money_total().alias("total_revenue")).orderBy(F.desc("total_revenue"), "Purchase_Category").limit(1)


def insights(orders: DataFrame, effect: DataFrame, segmented: DataFrame) -> DataFrame:
    """Five sentences from the one-row results; ``effect`` is the matched effect of the discount."""
    lines = [
        best_by_amount(orders, "Purchase_Channel").select(
            F.lit(1).alias("position"), F.format_string(CHANNEL_TEXT, "Purchase_Channel", "aov").alias("insight")
        ),
        loyalty_effect(orders).select(F.lit(2), F.format_string(LOYALTY_TEXT, "effect")),
        best_by_amount(orders, "Social_Media_Influence").select(F.lit(3), F.format_string(SOCIAL_TEXT, "aov")),
        effect.select(
            F.lit(4),
            F.format_string(EFFECT_TEXT, "effect", F.when(F.col("effect") > 0, EFFECT_UP).otherwise(EFFECT_DOWN)),
        ),
        high_value_size(segmented).select(F.lit(5), F.format_string(VALUE_TEXT, "customers")),
    ]
    result = lines[0]
    for line in lines[1:]:
        result = result.union(line)
    return result.orderBy("position")

"""Bands, labels and ordered level lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Level order of each ordered category.
EDUCATION = ["High School", "Bachelor's", "Master's", "PhD"]
SENSITIVITY = ["Not Sensitive", "Somewhat Sensitive", "Very Sensitive"]
INFLUENCE = ["None", "Low", "Medium", "High"]
ENGAGEMENT = ["None", "Low", "Medium", "High"]
VALUE_SEGMENTS = ["Low", "Medium", "High"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
WEEKDAYS_SHORT = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]

# Band edges (open below, closed above) and labels.
AGE_BANDS = [(18, 25, "18-25"), (25, 35, "26-35"), (35, 45, "36-45"), (45, 55, "46-55"), (55, 70, "55+")]
LOYALTY_BANDS = [(0, 2, "Low (1-2)"), (2, 3, "Medium (3)"), (3, 5, "High (4-5)")]
DECISION_BANDS = [(3, "Quick (<=3 min)"), (7, "Normal (4-7 min)"), (14, "Deliberate (8-14 min)")]
DECISION_REST = "Slow (>14 min)"


def right_closed(value: Column, bands: list[tuple[float, float, str]]) -> Column:
    """Label of the band with low < value <= high; null outside every band."""
    label = F.lit(None).cast("string")
    for low, high, name in reversed(bands):
        label = F.when((value > low) & (value <= high), F.lit(name)).otherwise(label)
    return label


def age_band(column: str = "Age") -> Column:
    return right_closed(F.col(column), AGE_BANDS)


def loyalty_band(column: str = "Brand_Loyalty") -> Column:
    return right_closed(F.col(column), LOYALTY_BANDS)


def decision_band(column: str = "Time_to_Decision") -> Column:
    """Decision speed; null times fall into the last band."""
    label = F.lit(DECISION_REST)
    for limit, name in reversed(DECISION_BANDS):
        label = F.when(F.col(column) <= limit, F.lit(name)).otherwise(label)
    return label


def either(flag: str, yes: str, no: str) -> Column:
    """``yes`` when the flag is 1; ``no`` otherwise, null included."""
    return F.when(F.col(flag) == 1, F.lit(yes)).otherwise(F.lit(no))


def weekday_name(column: str = "Purchase_DayOfWeek", names: list[str] = WEEKDAYS) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.col(column).cast("int") + 1)


def levels(spark: SparkSession, column: str, names: list[str]) -> DataFrame:
    """Inline table of levels and their position."""
    return spark.createDataFrame(list(zip(names, range(len(names)))), f"{column} string, position int")


def in_level_order(grouped: DataFrame, column: str, names: list[str]) -> DataFrame:
    """One row per level in the given order; levels without data get null measures."""
    order = F.broadcast(levels(grouped.sparkSession, column, names))
    return order.join(grouped, column, "left").orderBy("position").drop("position")

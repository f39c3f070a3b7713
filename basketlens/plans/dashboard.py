"""Datasets of the interactive dashboard and of the BI pages."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions import bands
from basketlens.functions.hashing import key_hash
from basketlens.functions.measures import cents, money_mean, money_total
from basketlens.operators import explore
from basketlens.session import Scratch

FILTERS = ["Purchase_Channel", "Income_Level", "Gender"]
SCATTER_ROWS = 150
PREVIEW_ROWS = 50


def filter_options(orders: DataFrame) -> DataFrame:
    """Sorted distinct values of the three filter columns, in one pass and one shuffle."""
    cells = ", ".join(f"struct('{c}' as filter, {c} as option)" for c in FILTERS)
    return orders.selectExpr(f"inline(array({cells}))").where("option is not null").distinct().orderBy(
        "filter", "option"
    )


def select_rows(orders: DataFrame, **chosen: list[str]) -> DataFrame:
    """Rows matching every non-empty selection; an empty selection means all."""
    for column, values in chosen.items():
        if values:
            orders = orders.where(F.col(column).isin(list(values)))
    return orders


def kpi_row(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count("*").alias("n"),
        money_total().alias("revenue"),
        money_mean().alias("aov"),
        F.avg("Customer_Satisfaction").alias("csat"),
    )


def by_month(orders: DataFrame) -> DataFrame:
    """Revenue and mean satisfaction per calendar month."""
    month = F.expr("cast(trunc(cast(Time_of_Purchase as date), 'MM') as timestamp_ntz)")
    return (
        orders.dropna(subset=["Time_of_Purchase"])
        .groupBy(month.alias("Time_of_Purchase"))
        .agg(money_total().alias("Purchase_Amount"), F.avg("Customer_Satisfaction").alias("CSAT"))
        .orderBy("Time_of_Purchase")
    )


def top_categories(orders: DataFrame, size: int = 5) -> DataFrame:
    return explore.top_by_sum(orders, "Purchase_Category", size).withColumnRenamed("total_revenue", "Purchase_Amount")


def revenue_by(orders: DataFrame, key: str, **means: str) -> DataFrame:
    """Revenue per key with optional means, ``name=column``."""
    extra = [F.avg(column).alias(name) for name, column in means.items()]
    return orders.dropna(subset=[key]).groupBy(key).agg(money_total().alias("Purchase_Amount"), *extra).orderBy(key)


def scatter_sample(orders: DataFrame, columns: list[str], size: int = SCATTER_ROWS) -> DataFrame:
    return explore.sample_rows(orders, "Customer_ID", size).select(*columns)


def preview(orders: DataFrame, size: int = PREVIEW_ROWS) -> DataFrame:
    return orders.orderBy("Customer_ID").limit(size)


@contextmanager
def dashboard(orders: DataFrame, channels=(), incomes=(), genders=()):
    """All datasets of one filter choice over one persisted, column-pruned frame."""
    needed = [
        *FILTERS, "Customer_ID", "Age", "Purchase_Amount", "Customer_Satisfaction", "Time_of_Purchase",
        "Purchase_Category", "Payment_Method", "Frequency_of_Purchase",
    ]
    chosen = select_rows(
        orders, Purchase_Channel=list(channels), Income_Level=list(incomes), Gender=list(genders)
    ).select(*needed)
    chosen.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield {
            "kpi": kpi_row(chosen),
            "monthly": by_month(chosen),
            "top_categories": top_categories(chosen),
            "channels": revenue_by(chosen, "Purchase_Channel"),
            "scatter": scatter_sample(chosen, ["Age", "Purchase_Amount"]),
            "payments": revenue_by(chosen, "Payment_Method"),
            "categories": revenue_by(chosen, "Purchase_Category", Freq="Frequency_of_Purchase"),
            "incomes": revenue_by(chosen, "Income_Level", CSAT="Customer_Satisfaction"),
        }
    finally:
        chosen.unpersist()


class DashboardCube:
    """The datasets of every filter choice from partial sums that merge.

    The orders are read once, for a cube of counts and sums per filter cell (channel, income, gender) and level of each dimension, and for
    the rows of each cell with the smallest key hashes, of which the smallest of any choice are some.  Both are written and
    small: levels times cells, and 150 rows a cell.  A choice adds up cells; its datasets are kept, so a choice that comes again
    reads nothing.  ``refresh`` takes new orders and forgets what was kept.
    """

    DIMENSIONS = ["Purchase_Channel", "Income_Level", "Purchase_Category", "Payment_Method", "Month"]

    def __init__(self, orders: DataFrame, sample: int = SCATTER_ROWS) -> None:
        self.sample = sample
        self.refresh(orders)

    def refresh(self, orders: DataFrame) -> None:
        spark = orders.sparkSession
        if hasattr(self, "scratch"):
            self.scratch.drop()
        self.scratch, self.kept = Scratch(spark, "cube"), {}
        month = F.date_format(F.trunc(F.col("Time_of_Purchase").cast("date"), "MM"), "yyyy-MM-dd")
        base = self.scratch.write(
            orders.select(*FILTERS, "Purchase_Category", "Payment_Method", month.alias("Month"), "Customer_ID", "Age", "Purchase_Amount",
                          "Customer_Satisfaction", "Frequency_of_Purchase"), "base")
        levels = ", ".join(["struct('All' as dimension, cast(null as string) as level)", *[f"struct('{d}' as dimension, {d} as level)" for d in self.DIMENSIONS]])
        self.cells = self.scratch.write(
            base.withColumns({f"of_{c}": F.col(c) for c in FILTERS}).selectExpr(*[f"of_{c}" for c in FILTERS], "Purchase_Amount", "Customer_Satisfaction",
                                                                               "Frequency_of_Purchase", f"inline(array({levels}))")
            .groupBy(*[f"of_{c}" for c in FILTERS], "dimension", "level").agg(
                F.count("*").alias("n"), F.count("Purchase_Amount").alias("amounts"), F.sum(cents("Purchase_Amount")).alias("cents"),
                F.count("Customer_Satisfaction").alias("rated"), F.sum("Customer_Satisfaction").alias("rating"),
                F.count("Frequency_of_Purchase").alias("counted"), F.sum("Frequency_of_Purchase").alias("frequency")), "cells")
        first = Window.partitionBy(*FILTERS).orderBy("h", "Customer_ID")
        rows = base.select(*FILTERS, "Customer_ID", "Age", "Purchase_Amount", key_hash(F.col("Customer_ID"), 42).alias("h"))
        self.samples = self.scratch.write(rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= self.sample), "samples")
        self.scratch.drop("base")

    def datasets(self, channels=(), incomes=(), genders=()) -> dict[str, DataFrame]:
        """The eight datasets of a choice; nothing chosen means all."""
        choice = tuple(tuple(sorted(set(c))) for c in (channels, incomes, genders))
        if choice not in self.kept:
            self.kept[choice] = self._added_up(choice)
        return self.kept[choice]

    def _added_up(self, choice: tuple) -> dict[str, DataFrame]:
        spark = self.cells.sparkSession
        sums = ["n", "amounts", "cents", "rated", "rating", "counted", "frequency"]
        chosen = select_rows(self.cells, **{f"of_{f}": list(c) for f, c in zip(FILTERS, choice)})
        # One row per level of a dimension.
        rows = chosen.groupBy("dimension", "level").agg(*[F.sum(c).alias(c) for c in sums]).orderBy("dimension", "level").collect()

        def ratio(top, bottom):
            return None if not bottom else top / bottom

        def money(r):
            return None if r["cents"] is None else r["cents"] / 100.0

        whole = next((r for r in rows if r["dimension"] == "All"), None)
        kpi = (0, None, None, None) if whole is None else (
            whole["n"], money(whole), ratio(money(whole) or 0.0, whole["amounts"]), ratio(whole["rating"], whole["rated"]))

        def levels(dimension, *more):
            return [(r["level"], money(r), *[ratio(r[a], r[b]) for a, b in more]) for r in rows if r["dimension"] == dimension and r["level"] is not None]

        def table(key, found, *names):
            return spark.createDataFrame(found, ", ".join([f"{key} string", "Purchase_Amount double", *[f"{n} double" for n in names]]))

        categories = levels("Purchase_Category", ("frequency", "counted"))
        best = sorted(categories, key=lambda r: (-(r[1] or 0.0), r[0]))[:5]
        scatter = select_rows(self.samples, **dict(zip(FILTERS, map(list, choice)))).orderBy("h", "Customer_ID").limit(self.sample)
        return {
            "kpi": spark.createDataFrame([kpi], "n bigint, revenue double, aov double, csat double"),
            "monthly": table("month", levels("Month", ("rating", "rated")), "CSAT").selectExpr(
                "cast(month as timestamp_ntz) as Time_of_Purchase", "Purchase_Amount", "CSAT"),
            "top_categories": table("Purchase_Category", [r[:2] for r in reversed(best)]),
            "channels": table("Purchase_Channel", levels("Purchase_Channel")),
            "scatter": spark.createDataFrame(scatter.select("Customer_ID", "Age", "Purchase_Amount").collect(), "Customer_ID string, Age int, Purchase_Amount double"),
            "payments": table("Payment_Method", levels("Payment_Method")),
            "categories": table("Purchase_Category", categories, "Freq"),
            "incomes": table("Income_Level", levels("Income_Level", ("rating", "rated")), "CSAT"),
        }


# BI measures: name -> SQL; ratios are null over no rows.
BI_MEASURES = {
    "return_rate_pct": "try_divide(sum(Return_Rate), count(Customer_ID))",
    "high_satisfaction_pct": "try_divide(count(if(High_Satisfaction = 1, Customer_ID, null)), count(Customer_ID))",
    "discount_usage_pct": "try_divide(count(if(Discount_Used = 1, Customer_ID, null)), count(Customer_ID)) * 100",
    "loyalty_member_pct": "try_divide(count(if(Customer_Loyalty_Program_Member = 1, Customer_ID, null)),"
    " count(Customer_ID)) * 100",
}


def bi_measures(orders: DataFrame) -> DataFrame:
    return orders.agg(
        money_total().alias("total_revenue"),
        money_mean().alias("aov"),
        *[F.expr(sql).alias(name) for name, sql in BI_MEASURES.items()],
    )


def bi_cards(orders: DataFrame) -> DataFrame:
    """The six KPI cards in one row."""
    return orders.agg(
        F.count("Customer_ID").alias("total_orders"),
        money_total().alias("total_revenue"),
        money_mean().alias("aov"),
        F.avg("Customer_Satisfaction").alias("avg_satisfaction"),
        F.avg("Return_Rate").alias("avg_return_rate"),
        F.expr(BI_MEASURES["discount_usage_pct"]).alias("discount_usage_pct"),
    )


def count_by(orders: DataFrame, key: str) -> DataFrame:
    return orders.groupBy(key).agg(F.count("Customer_ID").alias("count")).orderBy(F.desc("count"), key)


def mean_by(orders: DataFrame, key: str, column: str, name: str) -> DataFrame:
    return orders.groupBy(key).agg(F.avg(column).alias(name)).orderBy(key)


def age_gender_frequency(orders: DataFrame) -> DataFrame:
    banded = orders.withColumn("Age_Group", bands.age_band()).dropna(subset=["Age_Group", "Gender"])
    return banded.groupBy("Age_Group", "Gender").agg(F.avg("Frequency_of_Purchase").alias("avg_frequency")).orderBy(
        "Age_Group", "Gender"
    )


def sensitivity_intent_matrix(orders: DataFrame) -> DataFrame:
    return explore.pivot_mean(orders, "Discount_Sensitivity", "Purchase_Intent", F.avg("Customer_Satisfaction"))


def member_split(orders: DataFrame) -> DataFrame:
    label = bands.either("Customer_Loyalty_Program_Member", "Member", "Non-Member").alias("Loyalty_Status")
    return orders.groupBy(label).agg(F.count("Customer_ID").alias("count")).orderBy("Loyalty_Status")


def channel_drill(orders: DataFrame, channel: str) -> DataFrame:
    """Categories of one channel: a cross-filter followed by a group."""
    return (
        select_rows(orders, Purchase_Channel=[channel])
        .groupBy("Purchase_Category")
        .agg(F.count("Customer_ID").alias("count"), money_total().alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "Purchase_Category")
    )

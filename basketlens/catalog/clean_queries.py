"""Cleaning, data quality, sources and sinks."""

from __future__ import annotations

from dataclasses import asdict

import pyarrow as pa
from pyspark.sql import functions as F

from basketlens.catalog.oracle_base import CALENDAR, FLAGS, FREQ, LINES, SQL, TYPED, over_orders
from basketlens.catalog.rounding import rounded
from basketlens.functions.shipping import by_value
from basketlens.operators import clean, quality
from basketlens.plans import etl, kpi
from basketlens.session import scratch_path
from basketlens.sources import files
from basketlens.sources.raw_text import raw_orders
from basketlens.sources.retail import COLUMNS, DERIVED, retail_orders

by_value(__name__)


def c_clean_orders(spark, path):
    return clean.clean_orders(raw_orders(spark, path))


def c_outliers(spark, path):
    return rounded(quality.outliers(retail_orders(spark, path, ["Purchase_Amount"])))


def c_missing_by_column(spark, path):
    return quality.missing_by_column(retail_orders(spark, path))


def c_describe(spark, path):
    return rounded(quality.describe(retail_orders(spark, path)))


def c_shape(spark, path):
    """Rows from the order file alone, as no join of the view adds or drops any; columns from the view's names."""
    return quality.shape(retail_orders(spark, path, ["Customer_ID"]), len(COLUMNS) + len(DERIVED))


def _raw_csv(spark, path):
    """The spoiled text written as a CSV with header, and its path."""
    target = scratch_path(spark, "raw-csv")
    files.write_csv(raw_orders(spark, path), target)
    return target


def io_raw_scan(spark, path):
    """CSV scan, header normalising and typing; no rows dropped or filled."""
    raw = files.read_raw_csv(spark, _raw_csv(spark, path))
    parsed = clean.parse(clean.normalise_names(raw))
    return parsed.select(
        "Customer_ID", "Age", "Purchase_Amount", "Time_of_Purchase", "Research_Hours", "Discount_Used",
        "Purchase_Category", "Social_Media_Influence",
    )


def io_csv_roundtrip(spark, path):
    """Clean rows through the CSV sink and back."""
    cleaned = c_clean_orders(spark, path)
    target = scratch_path(spark, "clean-csv")
    files.write_csv(cleaned, target)
    return files.read_clean_csv(spark, target, cleaned.schema)


def io_table_roundtrip(spark, path):
    """Clean rows through the table sink; a published view over the table, by SQL."""
    target = scratch_path(spark, "orders-table")
    files.write_table(c_clean_orders(spark, path), target)
    kpi.publish_views(files.read_table(spark, target), "consumer_orders")
    return spark.sql("SELECT * FROM vw_demographics")


def io_load_metrics(spark, path):
    """Counts reported by the whole load."""
    _, metrics = etl.run_etl(
        spark, _raw_csv(spark, path), scratch_path(spark, "orders-table"), scratch_path(spark, "orders-csv")
    )
    return spark.createDataFrame(
        [tuple(asdict(metrics).values())], ", ".join(f"{name} bigint" for name in asdict(metrics))
    )


def io_quarantine(spark, path):
    """A raw file with short and long lines through the load: rows taken, and what the quarantine table holds."""
    source, target = scratch_path(spark, "broken-csv"), scratch_path(spark, "orders-table")
    columns, key = raw_orders(spark, path), "cast(Customer_ID as bigint)"
    fields = ", ".join(f"concat('\"', replace(coalesce(`{c}`, ''), '\"', '\"\"'), '\"')" for c in columns.columns)
    lines = columns.selectExpr(f"array({fields}) as f", f"{key} % 19 = 0 as short", f"{key} % 23 = 0 as long").selectExpr(
        "concat_ws(',', case when long then concat(f, array('more')) when short then slice(f, 1, size(f) - 1) else f end) as value")
    # A header in every file, as the CSV writer does it.
    header = ",".join(columns.columns)
    lines.mapInArrow(_with_header(header), "value string").write.text(source)
    metrics = etl.load_orders(spark, files.read_raw_records(spark, source), target)
    held = files.read_table(spark, f"{target}-quarantine")
    width = len(columns.columns)
    sizes = held.selectExpr("size(split(record, '\",\"|\",m')) as fields")
    return sizes.agg(
        F.lit(metrics.rows_in).cast("bigint").alias("rows_in"), F.lit(metrics.quarantined_rows).cast("bigint").alias("quarantined_rows"),
        F.count_if(F.col("fields") < width).alias("short_records"), F.count_if(F.col("fields") > width).alias("long_records"))


def _with_header(header):
    def run(batches):
        first = True
        for batch in batches:
            if first:
                yield pa.RecordBatch.from_arrays([pa.array([header], batch.schema.field(0).type)], schema=batch.schema)
                first = False
            yield batch

    return run


def io_nonempty_check(spark, path):
    """Row count of the table that the load wrote; the load fails when it is 0."""
    target = scratch_path(spark, "orders-table")
    etl.load_orders(spark, raw_orders(spark, path), target)
    return files.read_table(spark, target).agg(F.count("*").alias("rows"))


QUERIES = {
    f.__name__: f
    for f in [
        c_clean_orders, c_outliers, c_missing_by_column, c_describe, c_shape, io_raw_scan,
        io_csv_roundtrip, io_table_roundtrip, io_load_metrics, io_quarantine, io_nonempty_check,
    ]
}

NUMERIC = [
    "Age", "Purchase_Amount", "Frequency_of_Purchase", "Brand_Loyalty", "Product_Rating", "Research_Hours",
    "Return_Rate", "Customer_Satisfaction", "Discount_Used", "Customer_Loyalty_Program_Member", "Time_to_Decision",
    "Purchase_Month", "Purchase_Quarter", "Purchase_DayOfWeek", "High_Satisfaction", "Is_Loyal",
]
TEXTS = [
    "Customer_ID", "Gender", "Income_Level", "Marital_Status", "Education_Level", "Occupation", "Location",
    "Purchase_Category", "Purchase_Channel", "Social_Media_Influence", "Discount_Sensitivity",
    "Engagement_with_Ads", "Device_Used_for_Shopping", "Payment_Method", "Purchase_Intent", "Shipping_Preference",
]
OTHERS = [
    "Frequency_of_Purchase", "Brand_Loyalty", "Product_Rating", "Return_Rate", "Customer_Satisfaction",
    "Discount_Used", "Customer_Loyalty_Program_Member",
]

# What parsing the spoiled text must give.
PARSED = f"""parsed AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 11 <> 0 THEN CAST(Age AS DOUBLE) END AS Age,
    CASE WHEN o_orderkey % 17 <> 0 THEN Purchase_Amount END AS Purchase_Amount,
    CASE WHEN o_orderkey % 13 <> 0 THEN Time_of_Purchase END AS Time_of_Purchase,
    Research_Hours, CAST(Time_to_Decision AS DOUBLE) AS Time_to_Decision,
    {", ".join(f"nullif({c}, 'None') AS {c}" for c in TEXTS)}, {", ".join(OTHERS)}
  FROM typed)"""
PARSED_DATED = f"dated AS (SELECT *, {CALENDAR} FROM parsed)"
KEPT = "kept AS (SELECT * FROM dated WHERE Purchase_Amount IS NOT NULL)"
MEDIANS = """medians AS (SELECT quantile_cont(Age, 0.5) AS m_age, quantile_cont(Research_Hours, 0.5) AS m_hours,
  quantile_cont(Time_to_Decision, 0.5) AS m_time FROM kept)"""
FILLED = f"""filled AS (SELECT coalesce(Age, m_age) AS Age, coalesce(Research_Hours, m_hours) AS Research_Hours,
  coalesce(Time_to_Decision, m_time) AS Time_to_Decision, Purchase_Amount, Time_of_Purchase, Purchase_Month,
  Purchase_Quarter, Purchase_DayOfWeek, {", ".join(f"coalesce({c}, 'Unknown') AS {c}" for c in TEXTS)},
  {", ".join(OTHERS)} FROM kept, medians)"""


def _over_clean(body: str) -> str:
    ctes = [LINES, FREQ, TYPED, PARSED, PARSED_DATED, KEPT, MEDIANS, FILLED, f"o AS (SELECT *, {FLAGS} FROM filled)"]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _nulls(columns: list[str]) -> str:
    return " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in columns)


_ALL = [*NUMERIC, *TEXTS, "Time_of_Purchase"]
_BEFORE = [c for c in _ALL if c not in ("High_Satisfaction", "Is_Loyal")]

ORACLE = {
    "c_clean_orders": _over_clean("SELECT * FROM o"),
    "io_csv_roundtrip": _over_clean("SELECT * FROM o"),
    "io_raw_scan": "WITH " + ",\n".join([LINES, FREQ, TYPED, PARSED]) + """
        SELECT Customer_ID, Age, Purchase_Amount, Time_of_Purchase, Research_Hours, Discount_Used,
               Purchase_Category, Social_Media_Influence FROM parsed""",
    "io_table_roundtrip": _over_clean(
        f"""SELECT Income_Level, Gender, Education_Level, count(*) AS num_customers, {SQL['aov']} AS aov,
        {SQL['avg_frequency']} AS avg_frequency, {SQL['avg_brand_loyalty']} AS avg_brand_loyalty
        FROM o GROUP BY 1, 2, 3"""),
    "io_load_metrics": _over_clean(
        f"""SELECT (SELECT count(*) FROM parsed) AS rows_in, CAST(28 AS BIGINT) AS columns_in,
        (SELECT count(*) FROM o) AS rows_out, CAST(33 AS BIGINT) AS columns_out,
        (SELECT {_nulls(_BEFORE)} FROM dated) AS missing_before, (SELECT {_nulls(_ALL)} FROM o) AS missing_after,
        (SELECT count(*) FROM o WHERE Purchase_Amount < (SELECT quantile_cont(Purchase_Amount, 0.01) FROM o)
           OR Purchase_Amount > (SELECT quantile_cont(Purchase_Amount, 0.99) FROM o)) AS outlier_rows,
        (SELECT count(*) FROM typed WHERE o_orderkey % 13 = 0) AS unparsed_times, CAST(0 AS BIGINT) AS quarantined_rows"""),
    # Every 19th line of the raw file has lost its last field, every 23rd has one more.
    "io_quarantine": _over_clean(
        """SELECT count(*) FILTER (WHERE o_orderkey % 19 <> 0 AND o_orderkey % 23 <> 0) AS rows_in,
        count(*) FILTER (WHERE o_orderkey % 19 = 0 OR o_orderkey % 23 = 0) AS quarantined_rows,
        count(*) FILTER (WHERE o_orderkey % 19 = 0 AND o_orderkey % 23 <> 0) AS short_records,
        count(*) FILTER (WHERE o_orderkey % 23 = 0) AS long_records FROM typed"""),
    "io_nonempty_check": _over_clean("SELECT count(*) AS rows FROM o"),
    "c_outliers": over_orders(
        """SELECT round(low, 6) AS low_bound, round(high, 6) AS high_bound,
        count(*) FILTER (WHERE Purchase_Amount < low OR Purchase_Amount > high) AS outlier_rows, count(*) AS rows
        FROM o, (SELECT quantile_cont(Purchase_Amount, 0.01) AS low, quantile_cont(Purchase_Amount, 0.99) AS high
                 FROM o) GROUP BY low, high"""),
    "c_missing_by_column": over_orders(
        "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing FROM o" for c in _ALL)
        + ") WHERE missing > 0"),
    "c_describe": over_orders(" UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
        round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
        round(quantile_cont({c}, 0.75), 6) AS q75 FROM o""" for c in NUMERIC)),
    "c_shape": over_orders("SELECT count(*) AS rows, 33 AS columns FROM o"),
}

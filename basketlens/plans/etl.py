"""The whole load: raw CSV to clean table, clean CSV and KPI views."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.functions import text
from basketlens.operators import clean, quality
from basketlens.plans.kpi import publish_views
from basketlens.session import Scratch
from basketlens.sources import files


class EmptyLoad(ValueError):
    """The load wrote no rows."""


@dataclass(frozen=True)
class LoadMetrics:
    rows_in: int
    columns_in: int
    rows_out: int
    columns_out: int
    missing_before: int
    missing_after: int
    outlier_rows: int
    unparsed_times: int
    quarantined_rows: int


def require_rows(rows: int) -> int:
    if rows == 0:
        raise EmptyLoad("validation failed: 0 rows loaded")
    return rows


def load_orders(
    spark: SparkSession, raw: DataFrame, table_path: str, na_tokens: list[str] = text.NA_TOKENS,
    date_formats: list[str] = text.DATE_FORMATS,
) -> LoadMetrics:
    """Clean ``raw`` into the table and count rows, nulls, unreadable times and malformed records.

    The text is parsed once, into a written table that the counts, the medians and the result read.  The result is
    written once, as a version of the table that no reader sees; it is checked, and then the table points to it.  A load that fails or is
    empty leaves the old table as it was.  Records with too few or too many fields are kept apart, in the table
    ``<table>-quarantine``, and take no part in anything else.
    The counts are plain aggregates over written tables: metrics observed on a write would count retried work twice.
    """
    scratch = Scratch(spark, "load")
    bad = F.col(files.MALFORMED) if files.MALFORMED in raw.columns else F.lit(None).cast("string")
    # In a struct, the record is not a text column: it is not cleaned.
    record = F.when(bad.isNotNull(), F.struct(bad.alias("record")))
    named = clean.normalise_names(raw.withColumn("_bad", record).drop(files.MALFORMED))
    time = "Time_of_Purchase"
    given = F.lit(False)
    if time in named.columns:
        given = F.expr(text.missing_to_null(time, na_tokens)).isNotNull()
    marked = named.withColumn("_time_given", given.cast("string"))
    parsed = scratch.write(clean.add_calendar(clean.parse(marked, na_tokens, date_formats)), "parsed")
    quarantine = f"{table_path.rstrip('/')}-quarantine"
    files.write_table(parsed.where("_bad is not null").select("_bad.record"), quarantine)
    orders = parsed.where("_bad is null").drop("_time_given", "_bad")
    before = parsed.where("_bad is null").agg(
        F.count("*").alias("rows"), quality.missing_cells(orders).alias("missing"),
        F.count_if((F.col("_time_given") == "true") & F.col(time).isNull()).alias("unparsed"),
    ).first()
    filled = clean.fill_text(clean.fill_medians(clean.drop_incomplete(orders)))
    version = files.stage_table(clean.add_flags(filled), table_path)
    loaded = files.read_version(spark, table_path, version)
    try:
        after = loaded.agg(F.count("*").alias("rows"), quality.missing_cells(loaded).alias("missing")).first()
        require_rows(after["rows"])
        outlier_rows = quality.outliers(loaded).first()["outlier_rows"]
    except Exception:
        files.drop_version(spark, table_path, version)
        raise
    files.publish_version(spark, table_path, version)
    scratch.drop()
    return LoadMetrics(
        rows_in=before["rows"],
        columns_in=len(named.columns) - 1,
        rows_out=after["rows"],
        columns_out=len(loaded.columns),
        missing_before=before["missing"],
        missing_after=after["missing"],
        outlier_rows=outlier_rows,
        unparsed_times=before["unparsed"],
        quarantined_rows=files.read_table(spark, quarantine).count(),
    )


def run_etl(
    spark: SparkSession, raw_path: str, table_path: str, csv_path: str, na_tokens: list[str] = text.NA_TOKENS,
    date_formats: list[str] = text.DATE_FORMATS, multi_line: bool = False,
) -> tuple[DataFrame, LoadMetrics]:
    """Extract, clean, load the table, export the CSV from it, publish the views and, beside the table, their rows.

    ``LoadMetrics.rows_in`` counts well-formed records; ``quarantined_rows`` the others.
    """
    raw = files.read_raw_records(spark, raw_path, multi_line=multi_line)
    metrics = load_orders(spark, raw, table_path, na_tokens, date_formats)
    table = files.read_table(spark, table_path)
    files.write_csv(table, csv_path)
    for name in publish_views(table):
        files.write_table(spark.table(name), f"{table_path.rstrip('/')}-{name}")
    return table, metrics

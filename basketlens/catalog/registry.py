"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketlens.catalog import chart_queries, clean_queries, dashboard_queries, kpi_queries, model_queries, residual_queries, study_queries

SECTIONS = [kpi_queries, clean_queries, chart_queries, dashboard_queries, study_queries, model_queries, residual_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    merged: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for section in SECTIONS:
        merged |= section.QUERIES
    return merged


def oracle_sql() -> dict[str, str]:
    merged: dict[str, str] = {}
    for section in SECTIONS:
        merged |= section.ORACLE
    return merged

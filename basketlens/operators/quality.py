"""Data-quality figures: missing values, types, shape, describe, outliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.operators.quantiles import exact_quantiles, narrowed, ranked


def missing_cells(df: DataFrame) -> Column:
    """Aggregate: null cells over all columns."""
    total = F.lit(0).cast("bigint")
    for name in df.columns:
        total = total + F.count_if(F.col(f"`{name}`").isNull())
    return total


def missing_by_column(df: DataFrame) -> DataFrame:
    """Columns with nulls and their number, ascending; one notice row when there are none."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column_name", "missing").where("missing > 0")
    none = counts.unpivot([], df.columns, "column_name", "missing").agg(F.sum("missing").alias("missing")).where(
        "missing = 0"
    )
    notice = none.select(F.lit("No missing values").alias("column_name"), "missing")
    return long.unionByName(notice).orderBy("missing", "column_name")


def column_types(df: DataFrame) -> DataFrame:
    """Number of columns per data type, from the schema alone."""
    rows = [(t, n) for n, t in df.dtypes]
    table = df.sparkSession.createDataFrame(rows, "data_type string, column_name string")
    return table.groupBy("data_type").agg(F.count("*").alias("columns")).orderBy(F.desc("columns"), "data_type")


def shape(df: DataFrame, columns: int | None = None) -> DataFrame:
    """Rows and columns; ``columns`` where ``df`` has the rows of a wider view."""
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(columns or len(df.columns)))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of every numeric column.

    The columns are computed once; moments and ranks read the persisted copy.
    """
    columns = columns or numeric_columns(df)
    names = ["count", "mean", "std", "min", "max"]
    with narrowed(df, columns) as narrow:
        # One wide global aggregate: partial sums in each task, a single row shuffled.
        made = narrow.agg(*[
            f(f"c{k}").alias(f"{name}{k}")
            for k in range(len(columns))
            for name, f in zip(names, (F.count, F.avg, F.stddev_samp, F.min, F.max))
        ]).first()
        quartiles = {int(q.variable): q.values for q in ranked(narrow, len(columns), [0.25, 0.5, 0.75])}
    rows = [(c, *[made[f"{name}{k}"] for name in names], *quartiles.get(k, [None] * 3)) for k, c in enumerate(columns)]
    schema = "column_name string, count bigint, mean double, std double, min double, max double, q25 double, q50 double, q75 double"
    return df.sparkSession.createDataFrame(sorted(rows), schema)


def outliers(df: DataFrame, column: str = "Purchase_Amount", low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Bounds at two quantiles and the number of rows outside; the rows stay."""
    with narrowed(df, [column]) as narrow:
        found = ranked(narrow, 1, [low, high])
        below, above = (F.lit(v) for v in (found[0].values if found else (None, None)))
        row = narrow.agg(F.count_if((F.col("c0") < below) | (F.col("c0") > above)), F.count("*")).first()
    values = (*(found[0].values if found else (None, None)), *row)
    return df.sparkSession.createDataFrame([values], "low_bound double, high_bound double, outlier_rows bigint, rows bigint")

"""Data behind exploratory charts: histograms, box statistics, pivots, shares, correlations, fitted lines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.hashing import key_hash
from basketlens.functions.measures import money_total
from basketlens.functions.shipping import by_value
from basketlens.operators.quantiles import exact_quantiles, quantile_table
from basketlens.session import materialise

by_value(__name__)


def histogram(df: DataFrame, column: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width bins between the extremes of each group; the last bin is closed.

    ``by`` is a label from a short list.  Empty bins are kept with count 0.
    """
    group = by or "all_rows"
    values = df.select((F.col(by) if by else F.lit("all")).alias(group), F.col(column).cast("double").alias("x"))
    values = values.where(f"x is not null and {group} is not null")
    edges = (
        values.groupBy(group)
        .agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
        .selectExpr(group, "if(lo = hi, lo - 0.5, lo) as lo", "if(lo = hi, hi + 0.5, hi) as hi")
        .selectExpr(group, "lo", f"(hi - lo) / {bins} as width")
    )
    if by:
        placed = values.join(F.broadcast(edges), group)
    else:
        edge = edges.select(F.struct("lo", "width")).scalar()
        placed = values.withColumn("edge", edge).selectExpr(group, "x", "edge.lo as lo", "edge.width as width")
    counts = (
        placed.selectExpr(group, f"cast(least(floor((x - lo) / width), {bins - 1}) as int) as bin")
        .groupBy(group, "bin")
        .agg(F.count("*").alias("count"))
    )
    frame = edges.selectExpr("*", f"explode(sequence(0, {bins - 1})) as bin")
    result = (
        frame.join(counts, [group, "bin"], "left")
        .selectExpr(
            group, "bin", "lo + bin * width as bin_start", "lo + (bin + 1) * width as bin_end",
            "coalesce(count, 0) as count",
        )
        .orderBy(group, "bin")
    )
    return result if by else result.drop(group)


def box_stats(df: DataFrame, column: str, by: str | None = None) -> DataFrame:
    """Quartiles, whiskers at the last data points within 1.5 IQR, and outliers, per group."""
    group = by or "all_rows"
    values = df.select((F.col(by) if by else F.lit("all")).alias(group), F.col(column).cast("double").alias("x"))
    values = values.where("x is not null")
    if by:
        quartiles = quantile_table(values, ["x"], [0.25, 0.5, 0.75], ["q1", "median", "q3"], by=group)
        fenced = values.join(F.broadcast(quartiles.selectExpr(f"by as {group}", "q1", "median", "q3")), group)
    else:
        found = exact_quantiles(values, ["x"], [0.25, 0.5, 0.75])
        numbers = found[0].values if found else [None] * 3
        fenced = values.withColumns(
            {n: F.lit(v).cast("double") for n, v in zip(("q1", "median", "q3"), numbers)}
        )
    result = (
        fenced.selectExpr("*", "q1 - 1.5D * (q3 - q1) as low", "q3 + 1.5D * (q3 - q1) as high")
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.count("*").alias("n"),
            F.min(F.expr("if(x >= low, x, null)")).alias("whisker_low"),
            F.max(F.expr("if(x <= high, x, null)")).alias("whisker_high"),
            F.count_if(F.expr("x < low or x > high")).alias("outliers"),
        )
    )
    return result if by else result.drop(group)


def pivot_mean(df: DataFrame, row: str, column: str, mean: Column) -> DataFrame:
    """Mean per row key and column level; rows with a null key are left out.

    The columns are the levels in the data, whatever they are, in alphabetical order; finding them is a small job.
    """
    return df.dropna(subset=[row, column]).groupBy(row).pivot(column).agg(mean).orderBy(row)


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and percent of all counted rows, largest first."""
    counts = df.dropna(subset=[column]).groupBy(column).agg(F.count("*").alias("count"))
    # The window runs over one row per distinct value.
    return counts.selectExpr(column, "count", "100.0D * count / sum(count) over () as percent").orderBy(
        F.desc("count"), column
    )


def co_moments(df: DataFrame, columns: list[str]) -> tuple[np.ndarray, ...]:
    """Over the rows where both columns of a pair are present: rows, sums and sums of squares of the first, sums of products.

    Square matrices by pair, of values less their column's mean.  One pass over one written table of these columns; what a task adds up is of
    fixed size and merges by addition.
    """
    narrow = materialise(df.select(*[F.col(c).cast("double") for c in columns]), "moments")
    width = len(columns)
    means = np.array([m or 0.0 for m in narrow.agg(*[F.avg(c) for c in columns]).first()], dtype=np.float64)

    def run(batches):
        total = np.zeros((4, width, width))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1) - means
            here = ~np.stack([c.is_null().to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            x, here = np.where(here, x, 0.0), here.astype(np.float64)
            total += np.stack([here.T @ here, x.T @ here, (x * x).T @ here, x.T @ x])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["at", "value"])

    parts = narrow.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    total = np.zeros(4 * width * width)
    for r in parts.collect():
        total[r["at"]] = r["value"]
    return tuple(total.reshape(4, width, width))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair over the rows where both are present; 1 for a column with itself.

    Null where there is no row with both; NaN where one does not vary over them.
    """
    n, sums, squares, products = co_moments(df, columns)
    rows = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            r = None
            if n[i, j] and i == j:
                r = 1.0
            elif n[i, j]:
                both = products[i, j] - sums[i, j] * sums[j, i] / n[i, j]
                spread = (squares[i, j] - sums[i, j] ** 2 / n[i, j]) * (squares[j, i] - sums[j, i] ** 2 / n[i, j])
                r = float(both / np.sqrt(spread)) if spread > 0 else float("nan")
            rows.append((a, b, r))
    return df.sparkSession.createDataFrame(rows, "column_a string, column_b string, r double")


def fitted_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of y on x, evaluated at the sorted distinct x."""
    pairs = df.selectExpr(f"cast({x} as double) as x", f"cast({y} as double) as y").where("x is not null and y is not null")
    line = pairs.agg(F.struct(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept")))
    points = pairs.select("x").distinct().select(F.col("x").alias(x), line.scalar().alias("line"))
    return points.selectExpr(
        x, "line.slope as slope", "line.intercept as intercept", f"line.intercept + line.slope * {x} as fitted"
    ).orderBy(x)


def sample_rows(df: DataFrame, key: str, size: int, seed: int = 42) -> DataFrame:
    """At most ``size`` rows in the order of a seeded hash of the key; the same rows on any partitioning."""
    return df.orderBy(key_hash(F.col(key), seed), key).limit(size)


def top_by_sum(df: DataFrame, key: str, size: int, extra: list[Column] | None = None) -> DataFrame:
    """The ``size`` keys with the largest revenue, shown in ascending order."""
    totals = df.dropna(subset=[key]).groupBy(key).agg(money_total().alias("total_revenue"), *(extra or []))
    top = totals.orderBy(F.desc("total_revenue"), key).limit(size)
    return top.orderBy("total_revenue", F.desc(key))

"""Range buckets: ordered work on a column without one task seeing all rows.

Split points come from a bounded sketch, rows get the bucket of their value,
windows run inside a bucket, and what must cross bucket borders is carried in a
table of one row per bucket.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BUCKETS = 4096


def bucket_count(df: DataFrame) -> int:
    """Twice the session's shuffle partitions, within 8 and ``MOST_BUCKETS``."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(8, min(MOST_BUCKETS, 2 * partitions))


def split_points(df: DataFrame, columns: list[str], buckets: int | None = None) -> list[list[float]]:
    """Increasing split values per column, all in one job; fewer than ``buckets`` numbers each reach the driver."""
    buckets = buckets or bucket_count(df)
    ranks = [i / buckets for i in range(1, buckets)]
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), ranks, 10_000) for c in columns]).first()
    return [sorted(set(values or [])) for values in found]


def with_buckets(df: DataFrame, columns: list[str], splits: list[list[float]], outputs: list[str]) -> DataFrame:
    """Add bucket numbers that grow with the value; equal values share a bucket."""
    edges = [[-float("inf"), *(s or [0.0]), float("inf")] for s in splits]
    return Bucketizer(splitsArray=edges, inputCols=columns, outputCols=outputs).transform(df)


def with_bucket(df: DataFrame, column: str, buckets: int | None = None) -> DataFrame:
    """Add ``_bucket`` for one column."""
    return with_buckets(df, [column], split_points(df, [column], buckets), ["_bucket"])


def running_totals(
    df: DataFrame, order: str, columns: list[str], descending: bool = False, buckets: int | None = None
) -> DataFrame:
    """Add ``<column>_to``: the total over all rows up to this one in the order of ``order``.

    ``df`` has one row per value of ``order``.
    """
    placed = with_bucket(df, order, buckets)
    direction = "desc" if descending else "asc"
    sums = placed.groupBy("_bucket").agg(*[F.sum(c).alias(f"{c}_all") for c in columns])
    # One row per bucket.
    before = sums.selectExpr(
        "_bucket",
        *[
            f"coalesce(sum({c}_all) over (order by _bucket {direction} rows between unbounded preceding"
            f" and 1 preceding), 0) as {c}_before"
            for c in columns
        ],
    )
    return (
        placed.join(F.broadcast(before), "_bucket")
        .selectExpr(
            *df.columns,
            *[
                f"{c}_before + sum({c}) over (partition by _bucket order by {order} {direction}"
                f" rows between unbounded preceding and current row) as {c}_to"
                for c in columns
            ],
        )
    )

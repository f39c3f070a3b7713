"""Left join that spreads hot keys.

Adaptive execution splits a skewed partition only when both join inputs are
plain shuffles; a dimension that was just aggregated on the join key is not.
Here the keys that hold a large share of the rows are found from their counts
and salted: the rows of such a key spread over several partitions, the one
dimension row is copied to each of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 500_000
LONE_PARTS = 4096


def salted_left_join(
    rows: DataFrame,
    dim: DataFrame,
    counts: DataFrame,
    key: str,
    count_column: str,
    spread_by: Column,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``rows`` left join ``dim`` (one row per ``key``).

    ``counts`` has the number of rows of every key.  A key with more than ``rows_per_task`` rows is split into pieces of
    about that size, so the broadcast list has fewer entries than the rows over ``rows_per_task``: at a hundred billion
    rows, two megabytes.  Null keys match nothing and are spread over ``LONE_PARTS`` pieces.
    ``spread_by`` must be deterministic (a row id), so that retried tasks agree.
    """
    hot = counts.where((F.col(count_column) > rows_per_task) & F.col(key).isNotNull()).select(
        F.col(key), F.ceil(F.col(count_column) / rows_per_task).cast("int").alias("_parts")
    )
    parts = F.when(F.col(key).isNull(), LONE_PARTS).otherwise(F.coalesce(F.col("_parts"), F.lit(1)))
    salted = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(spread_by), parts).cast("int")
    ).drop("_parts")
    copies = (
        dim.where(F.col(key).isNotNull()).join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)))
        .drop("_parts")
    )
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")

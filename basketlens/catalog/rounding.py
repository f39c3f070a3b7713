"""Rounding of registered results, so that engines agree on the last digits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, decimals: int = 6) -> DataFrame:
    return df.select(
        *[F.round(F.col(f"`{n}`"), decimals).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes]
    )

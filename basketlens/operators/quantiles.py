"""Exact interpolated quantiles by radix selection.

``percentile`` keeps every distinct value of a group in one buffer.  Here a value is its 64 bits in the order of the values, and a
rank is found digit by digit: rows are counted by the first 16 bits, the count that holds the rank tells its
prefix, and the rows of that prefix are counted by the next 16 bits, four times at most.  A task never orders values: it counts prefixes,
and a running total goes over at most 65,536 of them, however the values are distributed.  A prefix of
which all rows are equal ends the search early.  The result equals linear interpolation between order statistics.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT = 16
MOST_GROUPS = 1_000
SIGN = (1 << 63) - 1


class Quantiles(NamedTuple):
    variable: str
    by: str | None
    n: int
    values: list[float]


def sort_key(value: Column) -> Column:
    """A bigint that orders as the doubles do, NaN last; both zeros are one value."""
    bits = F.call_function("java_method", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0)).cast("bigint")
    return F.when(value.isNull(), F.lit(None)).otherwise(bits)


def ordered_bits(bits: str) -> str:
    # A negative value's bits grow as it falls.
    return f"if({bits} < 0, {bits} ^ {SIGN}L, {bits})"


def from_key(key: int) -> float:
    return struct.unpack("<d", struct.pack("<q", key if key >= 0 else key ^ SIGN))[0]


@contextmanager
def narrowed(df: DataFrame, columns: list[str], by: str | None = None) -> Iterator[DataFrame]:
    """``by``, ``c0``, ``c1``, … as doubles, persisted for several passes and released after."""
    group = F.lit("") if by is None else F.col(by).cast("string")
    narrow = df.select(group.alias("by"), *[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    narrow = narrow.where("by is not null").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield narrow
    finally:
        narrow.unpersist()


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float], by: str | None = None) -> list[Quantiles]:
    """Quantiles of each column, one entry per column and group of ``by``.

    Like ``approxQuantile`` it runs at once and returns plain numbers: a few rows per group reach the driver, so ``by``
    must be a label from a short list (a band, a segment); more than ``MOST_GROUPS`` groups are refused.
    """
    with narrowed(df, columns, by) as narrow:
        return [q._replace(variable=columns[int(q.variable)], by=None if by is None else q.by) for q in ranked(narrow, len(columns), probabilities)]


def ranked(narrow: DataFrame, width: int, probabilities: list[float]) -> list[Quantiles]:
    """Quantiles of ``c0``, ``c1``, … of a narrowed table, named by their numbers."""
    keys = narrow.select("by", *[sort_key(F.col(f"c{k}")).alias(f"b{k}") for k in range(width)]).selectExpr(
        "by", *[f"{ordered_bits(f'b{k}')} as key{k}" for k in range(width)])
    totals: dict[tuple[str, int], int] = {}
    found: dict[tuple, int] = {}
    wanted = None  # rows of (group, column, prefix, probability, side, rank within the prefix)
    for shift in range(64 - DIGIT, -1, -DIGIT):
        rows = _counted(keys, width, shift, wanted, probabilities)
        if wanted is None:
            totals = {(r["by"], r["k"]): r["total"] for r in rows}
            if len({g for g, _ in totals}) > MOST_GROUPS:
                raise ValueError(f"more than {MOST_GROUPS} groups: quantiles are for a short list of labels")
        wanted = []
        for r in rows:
            if r["low"] == r["high"] or not shift:
                found[r["by"], r["k"], r["i"], r["side"]] = r["low"]
            else:
                wanted.append((r["by"], r["k"], r["prefix"], r["i"], r["side"], r["rank"] - r["before"]))
        if not wanted:
            break
    out = []
    for (group, k), n in totals.items():
        values = []
        for i, p in enumerate(probabilities):
            low, high = (from_key(found[group, k, i, side]) for side in (0, 1))
            part = p * (n - 1) - math.floor(p * (n - 1))
            values.append(low + (high - low) * part if part else low)
        out.append(Quantiles(str(k), group, n, values))
    return sorted(out, key=lambda q: (int(q.variable), q.by))


def _counted(keys: DataFrame, width: int, shift: int, wanted: list[tuple] | None, probabilities: list[float]) -> list:
    """The prefixes of ``64 - shift`` bits that hold a wanted rank, with the least and largest key of each."""
    spark = keys.sparkSession
    columns = range(width) if wanted is None else sorted({w[1] for w in wanted})
    prefixes = {k: sorted({w[2] for w in wanted or [] if w[1] == k}) for k in columns}
    kept = {k: f"key{k} is not null" if wanted is None else f"shiftright(key{k}, {shift + DIGIT}) in ({', '.join(f'{p}L' for p in prefixes[k])})" for k in columns}
    cells = ", ".join(f"if({kept[k]}, named_struct('k', {k}, 'key', key{k}), null)" for k in columns)
    long = keys.selectExpr("by", f"explode(array({cells})) as cell").where("cell is not null").selectExpr("by", "cell.k", "cell.key")
    counts = long.groupBy("by", "k", F.expr(f"shiftright(key, {shift})").alias("prefix")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
    # At most 65,536 prefixes in a partition.
    if wanted is None:
        whole = Window.partitionBy("by", "k")
        sides = ", ".join(
            f"named_struct('i', {i}, 'side', {side}, 'rank', cast({name}({p!r}D * (total - 1)) as bigint))"
            for i, p in enumerate(probabilities) for side, name in enumerate(("floor", "ceil")))
        counts = counts.withColumn("total", F.sum("n").over(whole)).withColumn("before", F.sum("n").over(whole.orderBy("prefix")) - F.col("n"))
        hit = counts.selectExpr("*", f"inline(filter(array({sides}), x -> x.rank >= before and x.rank < before + n))")
    else:
        asked = spark.createDataFrame(wanted, "by string, k int, above bigint, i int, side int, rank bigint")
        counts = counts.withColumn("above", F.expr(f"shiftright(prefix, {DIGIT})"))
        counts = counts.withColumn("before", F.sum("n").over(Window.partitionBy("by", "k", "above").orderBy("prefix")) - F.col("n"))
        # A few rows for each group and column.
        hit = counts.join(F.broadcast(asked), ["by", "k", "above"]).where("rank >= before and rank < before + n").withColumn("total", F.lit(0))
    return hit.select("by", "k", "total", "i", "side", "rank", "before", "prefix", "low", "high").limit(MOST_GROUPS * 2 * width * len(probabilities) + 1).collect()


def quantile_table(df: DataFrame, columns: list[str], probabilities: list[float], names: list[str], **options):
    """The quantiles as a small DataFrame (variable, by, n, <names>)."""
    rows = [(q.variable, q.by, q.n, *q.values) for q in exact_quantiles(df, columns, probabilities, **options)]
    schema = "variable string, by string, n bigint, " + ", ".join(f"{n} double" for n in names)
    return df.sparkSession.createDataFrame(rows, schema)

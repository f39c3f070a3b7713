"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.session import Scratch

WORD = "[^\\x20\\x09-\\x0D]+"
BITS = 52  # of a document's random number
FAN = 8  # bits by which the order is refined at each level of the running totals


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_bits(doc_id: Column, seed: str) -> Column:
    """52 bits from the MD5 of the seed and the document's number: the same in every run and on every executor."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13), 16, 10).cast("long")


def source_targets(sizes: DataFrame, cycle: int = 3, most: int = 3) -> DataFrame:
    """Per source: ``source``, ``source_size``, ``target``.

    Sources in code point order, null last, weigh 1 to ``cycle``, repeating.  The total of all sizes is shared by weight; a source that
    would get more than ``most`` times its size gets just that, and the rest is shared again.  Filled in the order of
    size by weight, one pass finds all such sources.  One row per source, so the ranking over all sources is small.
    """
    return (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .selectExpr("source", "source_size", f"(row_number() over (order by source asc nulls last) - 1) % {cycle} + 1 as weight")
        .selectExpr("*", f"row_number() over (order by cast({most} * source_size as double) / weight, source asc nulls last) as place",
                    "sum(source_size) over () as everything")
        .selectExpr("*", f"coalesce(sum({most} * source_size) over (order by place rows between unbounded preceding and 1 preceding), 0) as filled",
                    "sum(weight) over (order by place rows between current row and unbounded following) as shares")
        .selectExpr("*", "cast(everything - filled as double) / shares as level")
        .selectExpr("*", f"cast({most} * source_size as double) / weight <= level as full")
        .selectExpr("*", "min(case when not full then place end) over () as open_at")
        .selectExpr("*", "max(case when place = open_at then level end) over () as open_level")
        .selectExpr("source", "source_size",
                    f"case when open_at is null or place < open_at then cast({most} * source_size as double) else weight * open_level end as target")
    )


def mix(docs: DataFrame, scratch: Scratch, seed: str = "mix", cycle: int = 3, most: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, ``copies``.

    Every document of a source is wanted ``target / source_size`` times: the whole part is certain, the rest is its
    inclusion probability.  Documents are ranked by their random odds divided by their inclusion odds, and those
    first in the rank get one more copy until the words taken are as near to the target as they come.

    Null texts have size 0; null is a source of its own.  Rows that repeat a ``doc_id`` share its random number and are ranked
    by size, so equal rows are interchangeable.  ``source`` follows if named in ``carry``; no other column is read.  An empty table gives an empty table.
    """
    sizes = scratch.write(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), random_bits(F.col("doc_id"), seed).alias("bits")), "sizes"
    )
    targets = scratch.write(
        source_targets(sizes, cycle, most)
        .selectExpr("source", "source_size", "target",
                    "case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole")
        .selectExpr("*", "target - whole * source_size as rest", "case when source_size > 0 then target / source_size - whole else 0.0D end as chance"),
        "targets",
    )
    # Within a source the inclusion odds are equal, so the rank follows the random bits.  Words before a document come
    # from totals per 1/256 of the bits, per 1/65536, and the rows within: no task orders a whole source.
    top, low = f"shiftright(bits, {BITS - FAN})", f"shiftright(bits, {BITS - 2 * FAN})"
    fine = sizes.selectExpr("source", f"{top} as top", f"{low} as low", "size").groupBy("source", "top", "low").agg(F.sum("size").alias("words"))
    coarse = fine.groupBy("source", "top").agg(F.sum("words").alias("words")).selectExpr(
        "source as coarse_source", "top as coarse_top",
        "coalesce(sum(words) over (partition by source order by top rows between unbounded preceding and 1 preceding), 0) as words_before",
    )
    fine = fine.selectExpr(
        "source", "top", "low",
        "coalesce(sum(words) over (partition by source, top order by low rows between unbounded preceding and 1 preceding), 0) as words_within",
    )
    starts = fine.join(coarse, F.expr("source <=> coarse_source and top = coarse_top")).selectExpr(
        "source as start_source", "low as start_low", "words_before + words_within as start")
    placed = sizes.selectExpr("*", f"{low} as low").selectExpr(
        "*", "coalesce(sum(size) over (partition by source, low order by bits, doc_id, size rows between unbounded preceding and 1 preceding), 0) as before")
    placed = placed.join(starts, F.expr("source <=> start_source and low = start_low")).withColumn("before", F.col("before") + F.col("start"))
    per_source = targets.withColumnRenamed("source", "target_source")
    odds = f"((bits + 0.5D) / {1 << BITS}D) / (1 - (bits + 0.5D) / {1 << BITS}D)"
    return placed.join(per_source, F.expr("source <=> target_source")).selectExpr(
        "doc_id", "size", "source_size", "target",
        "size * (whole + case when before + size / 2.0D <= rest and rest > 0 then 1 else 0 end) as taken",
        "whole + case when before + size / 2.0D <= rest and rest > 0 then 1 else 0 end as copies",
        f"case when chance > 0 then ({odds}) * ((1 - chance) / chance) end as rank_value", *carry,
    )


def op8_source_mix(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "mix")).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS bits
  FROM documents
), w AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source
), p AS (
  SELECT *, row_number() OVER (ORDER BY CAST(3 * s AS DOUBLE) / weight, source ASC NULLS LAST) AS place, CAST(sum(s) OVER () AS BIGINT) AS everything FROM w
), f AS (
  SELECT *, CAST(coalesce(sum(3 * s) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS filled,
         CAST(sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS shares FROM p
), l AS (
  SELECT *, CAST(everything - filled AS DOUBLE) / shares AS level FROM f
), o AS (
  SELECT min(place) AS open_at, arg_min(level, place) AS open_level FROM l WHERE CAST(3 * s AS DOUBLE) / weight > level
), t AS (
  SELECT source, s, CASE WHEN open_at IS NULL OR place < open_at THEN CAST(3 * s AS DOUBLE) ELSE weight * open_level END AS target FROM l, o
), t2 AS (
  SELECT *, CASE WHEN s > 0 THEN CAST(floor(target / s) AS BIGINT) ELSE 0 END AS whole FROM t
), b AS (
  SELECT d.doc_id, d.size, t2.s AS source_size, t2.target, t2.whole, t2.target - t2.whole * t2.s AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY bits, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t2 ON d.source IS NOT DISTINCT FROM t2.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN before + size / 2.0 <= rest AND rest > 0 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM b
"""

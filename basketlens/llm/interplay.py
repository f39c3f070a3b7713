"""Filter interaction audit: what every order of a set of filters removes, step by step.

A document is reduced to the set of filters that it fails, a mask of bits.  Whatever an order of the filters does to a
document follows from its mask, so documents are counted once in cells of (part, mask), and a recursive query extends
every prefix of an order by each unused letter, over the masks, with the bits applied so far.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketlens.session import Scratch

WORD = "[^\\x20\\x09-\\x0D]+"
LETTERS = "ABCDE"
UNKNOWN_PARTS = 4096  # rows without number match no label and are spread over so many join keys


def own_mask(text: Column, least_words: int = 200, distinct_share: int = 50, capitals_share: int = 3) -> Column:
    """Bits 1, 2, 4 and 8: the filters A to D that a text fails by itself."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def bits(w: Column) -> Column:
        few = F.size(w) < least_words
        repetitive = F.size(F.array_distinct(w)).cast("long") * 100 < F.size(w).cast("long") * distinct_share
        capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.char_length(text).cast("long") * capitals_share
        signs = F.regexp_like(text, F.lit("[#$%&*|]"))
        return sum((F.when(fails, 1 << at).otherwise(0) for at, fails in enumerate((few, repetitive, capitals, signs))), F.lit(0))

    # The words are made once: a lambda's argument is not computed again where it is used again.
    return F.transform(F.array(words), bits)[0]


def mask_cells(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """``part``, ``mask``, ``docs``, ``good``, ``toxic``: documents per part and set of failed filters.

    Filter E (bit 16) is failed by all rows of a text but those of its smallest ``doc_id``.  Rows with one text share
    all other bits, so each text is aggregated by part and label, and the smallest number is split off afterwards: the copies of
    one text never meet in a task.
    """
    digest = F.unhex(F.sha2(F.col("text"), 256))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(UNKNOWN_PARTS))).otherwise(F.lit(0))
    rows = rows.select("doc_id", "part", digest.alias("digest"), own_mask(F.col("text")).alias("own"), spread.alias("spread"))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = known.select("doc_id", F.lit(0).cast("long").alias("spread"), "good", "toxic")
    # One row for each number and text, then for each text, part and label: partial sums go before every exchange.
    numbers = (
        rows.join(known, ["doc_id", "spread"], "left")
        .groupBy("doc_id", "spread", "digest", "part", "own", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
        .agg(F.count("*").alias("n"))
    )
    texts = numbers.groupBy("digest", "part", "own", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnumbered"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
    )
    # At most four rows of a text in each part.
    texts = texts.withColumn("least", F.min("first.doc_id").over(Window.partitionBy("digest")))
    free = F.col("unnumbered") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = F.array(F.struct(F.col("own").alias("mask"), free.alias("n")), F.struct((F.col("own") + 16).alias("mask"), (F.col("n") - free).alias("n")))
    cells = (
        texts.select("part", "good", "toxic", F.inline(split)).where("n > 0")
        .groupBy("part", "mask").agg(
            F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    )
    return scratch.write(cells, "cells")


def filter_steps(cells: DataFrame, scratch: Scratch, letters: str = LETTERS) -> DataFrame:
    """``part``, ``prefix``, and the counts of the last step of every prefix of an order.

    The recursion starts from the masks that occur (32 at most for five letters) and adds a level for each step: a prefix with its applied
    bits takes an unused letter, and the level says what that step does to every mask.  It has 326 prefixes of five
    letters whatever the data; the documents come in by a join on the mask.
    """
    levels = cells.sparkSession.sql(
        f"""
        WITH RECURSIVE filters AS (
          SELECT letter, shiftleft(1, at) AS bit FROM (SELECT posexplode(split('{letters}', '')) AS (at, letter))
        ), steps(step, prefix, applied, before, bit, mask) AS (
          SELECT 0, '', 0, 0, 0, mask FROM {{masks}}
          UNION ALL
          SELECT s.step + 1, concat(s.prefix, f.letter), s.applied | f.bit, s.applied, f.bit, s.mask
          FROM steps s JOIN filters f ON (s.applied & f.bit) = 0
        )
        SELECT prefix, mask, bit,
               CAST((mask & applied) = 0 AS BIGINT) AS keeps,
               CAST((mask & before) = 0 AND (mask & bit) <> 0 AS BIGINT) AS removes,
               CAST((mask & before) <> 0 AND (mask & bit) <> 0 AS BIGINT) AS repeats,
               CAST(mask = bit AS BIGINT) AS alone
        FROM steps WHERE step > 0
        """,
        masks=cells.select("mask").distinct(),
    )
    levels = scratch.write(levels, "levels")
    return cells.join(levels, "mask").groupBy("part", "prefix").agg(
        F.sum(F.col("docs") * F.col("keeps")).alias("kept"),
        F.sum(F.col("docs") * F.col("removes")).alias("removed"),
        F.sum(F.col("docs") * F.col("repeats")).alias("redundant"),
        F.sum(F.col("docs") * F.col("alone")).alias("unique_fails"),
        F.sum(F.col("good") * F.col("removes")).alias("good_lost"),
        F.sum(F.col("toxic") * F.col("removes")).alias("toxic_lost"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """Per ``part``, ``filter_order`` and ``step``: what the filters A to E, applied in that order, keep and remove.

    Parts are the values of ``lang``; null and empty are one part, the empty string.  Null texts count as empty.  Rows without ``doc_id`` are in
    no order: E lets them pass and they make no other row fail.  Rows that repeat a ``doc_id`` are documents of their
    own that fail E together or not at all.  A document with several labels has the larger of each; without labels it is neither good nor toxic.
    Only ``doc_id``, ``text``, ``lang`` and the labels are read.  No documents, no parts: an empty table.
    """
    steps = scratch.write(filter_steps(mask_cells(docs, labels, scratch), scratch), "steps")
    whole = steps.where(F.length("prefix") == len(LETTERS)).select("part", F.col("prefix").alias("filter_order"))
    orders = whole.select("part", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step"))
    orders = orders.withColumn("prefix", F.expr("left(filter_order, step)")).withColumn("letter", F.expr("right(prefix, 1)"))
    out = orders.join(steps, ["part", "prefix"])
    # 120 rows of a part for each letter.
    out = out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter")))
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return audit_filters(docs, labels, Scratch(spark, "audit"))


_ORDERS = ", ".join(f"('{''.join(order)}')" for order in permutations(LETTERS))

OP11_SQL = rf"""
WITH words AS (
  SELECT d.doc_id, coalesce(d.lang, '') AS part, coalesce(d.text, '') AS text,
         regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents d
), least AS (
  SELECT text, min(doc_id) AS first_id FROM words GROUP BY text
), known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), failed AS (
  SELECT w.part, len(w.w) < 200 AS a, 100 * len(list_distinct(w.w)) < 50 * len(w.w) AS b,
         100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 3 * length(w.text) AS c,
         regexp_matches(w.text, '[#$%&*|]') AS d, coalesce(w.doc_id > l.first_id, FALSE) AS e,
         coalesce(k.good, 0) AS good, coalesce(k.toxic, 0) AS toxic
  FROM words w JOIN least l ON w.text = l.text LEFT JOIN known k ON w.doc_id = k.doc_id
), cells AS (
  SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
                      CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS fails,
         count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM failed GROUP BY ALL
), orders AS (
  SELECT o.filter_order, s.step, o.filter_order[s.step] AS letter, o.filter_order[1 : s.step - 1] AS earlier
  FROM (VALUES {_ORDERS}) o(filter_order), (VALUES (1), (2), (3), (4), (5)) s(step)
), said AS (
  SELECT c.part, o.filter_order, o.step, o.letter, c.n, c.good, c.toxic,
         contains(c.fails, o.letter) AS here, translate(c.fails, o.earlier, '') <> c.fails AS gone, c.fails = o.letter AS alone
  FROM cells c, orders o
), counted AS (
  SELECT part, filter_order, step, letter,
         CAST(sum(CASE WHEN NOT here AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN here AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN here AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN alone THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN here AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN here AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM said GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""

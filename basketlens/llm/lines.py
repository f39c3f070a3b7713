"""Line dedup: drop lines that many documents share, keeping them in one document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.session import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased."""
    return F.translate(F.trim(line, F.expr(BLANKS)), UPPER, LOWER)


def text_lines(text: Column) -> Column:
    """Lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hash(key: Column) -> Column:
    # Two hashes with different seeds: 128 bits.
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


def shared_line_positions(docs: DataFrame, scratch: Scratch, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Positions of the lines to drop: ``doc_id``, ``row`` (hash of the text), ``gone`` (array of positions).

    A key of at least ``min_chars`` characters in at least ``min_docs`` distinct ``doc_id`` is dropped everywhere but
    in the largest of them.
    """
    keys = F.transform(text_lines(F.col("text")), lambda line, at: F.struct(line_key(line).alias("key"), at.alias("at")))
    long_keys = F.filter(keys, lambda line: F.char_length(line["key"]) >= min_chars)
    lines = (
        docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
        .select("doc_id", F.xxhash64("text").alias("row"),
                F.explode(F.transform(long_keys, lambda k: F.struct(k["at"].alias("at"), _hash(k["key"]).alias("h")))).alias("line"))
        .select("doc_id", "row", "line.at", "line.h.a", "line.h.b")
    )
    # Each (key, document) once, spread by both; then a partial count per key: a key found everywhere stays even.
    shared = (
        lines.select("a", "b", "doc_id").distinct()
        .groupBy("a", "b").agg(F.count("*").alias("holders"), F.max("doc_id").alias("keeper"))
        .where(F.col("holders") >= min_docs).select("a", "b", "keeper")
    )
    # Written, so that both inputs of the join are plain shuffles and a very common line can be split between tasks.
    shared = scratch.write(shared, "shared")
    return (
        lines.join(shared, ["a", "b"]).where("doc_id != keeper")
        .groupBy("doc_id", "row").agg(F.collect_set("at").alias("gone"))
    )


def drop_shared_lines(
    docs: DataFrame, scratch: Scratch, min_chars: int = 40, min_docs: int = 5, carry: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id``, ``text`` (what stays, joined by line feeds), ``n_lines`` (before), ``n_dropped``; one row per input row.

    Columns named in ``carry`` follow unchanged; no other column is read.  They travel in one struct, so their names cannot clash.  Null and empty
    texts: one empty line, kept.  Rows without ``doc_id`` hold no line and lose none.  Rows that repeat a ``doc_id``
    count as one document, and each loses the lines that document loses.  An empty table gives an empty table.
    """
    docs = docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *carry).alias("carried"))
    gone = shared_line_positions(docs, scratch, min_chars, min_docs)
    lines = text_lines(F.col("text"))
    # array_except is hashed: linear in the lines however many are dropped.
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    return (
        docs.withColumn("row", F.xxhash64("text")).join(gone, ["doc_id", "row"], "left")
        .select("doc_id", "carried", "gone", lines.alias("lines"))
        .select("doc_id", "carried", "lines", stay.alias("stay"))
        .select(
            "doc_id",
            F.array_join(F.transform("stay", lambda at: F.get("lines", at)), "\n").alias("text"),
            F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size("stay")).cast("long").alias("n_dropped"),
            *[F.col("carried")[name].alias(name) for name in carry],
        )
    )


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "lines")
    kept = drop_shared_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(list_zip(l, range(len(l)))) AS z
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT doc_id, z[2] AS at, z[1] AS line,
         translate(trim(z[1], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE k.doc_id <> s.keeper) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.at) FILTER (WHERE s.keeper IS NULL OR k.doc_id = s.keeper), ''))
         AS kept_sha256
FROM keyed k LEFT JOIN shared s ON k.key = s.key
GROUP BY k.doc_id
"""

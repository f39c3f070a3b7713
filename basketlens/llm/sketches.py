"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is a set of paragraph digests, a repeated paragraph counted anew each time.  Each digest goes into three cells of a table;
a cell holds how many it has, and the exclusive or of the digests and of their checks.  Two tables of one size subtract cell
by cell: what both texts hold cancels out, whatever its amount.  A cell left with a single digest shows it, and taking that
digest out of its other cells frees further ones: the peeling.  If cells remain, the difference was too large for
the table, and the two are sketched and subtracted again in tables four times as large.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.shipping import by_value
from basketlens.llm.learning import mixed
from basketlens.operators.ranges import with_buckets
from basketlens.session import Scratch

by_value(__name__)

HASHES = 3
WIDTH = 8  # cells for each of the hashes in a fingerprint
GROWTH = 4  # of a table, from try to try
ROWS_PER_RANGE, MOST_RANGES = 20_000, 16_384
UNNUMBERED_RANGES = 4096
PAIRS, DIGESTS = 500, 200_000  # compared at once, about
CUT = b"\xff"  # stands in no UTF-8 text


def digests(text: str) -> np.ndarray:
    """Digests of the text's paragraphs: they end at line feeds, and after ``.``, ``!`` or ``?`` and a blank.  Equal ones are numbered."""
    data = text.encode()
    for end in (b"\n", b". ", b"! ", b"? "):
        data = data.replace(end, end + CUT)
    seen: dict[bytes, int] = {}
    out, times = [], []
    for p in data.split(CUT):
        if p:
            out.append(xxhash.xxh3_64_intdigest(p))
            times.append(seen.get(p, 0))
            seen[p] = times[-1] + 1
    # A digest that came twice would cancel itself out in every table, whatever its size.
    return np.unique(mixed(np.array(out, dtype=np.uint64), np.array(times, dtype=np.uint64)))


class Tables:
    """Sketches of many sets at once, a row of ``HASHES * width`` cells for each."""

    def __init__(self, rows: int, width: int) -> None:
        self.width, self.rows = width, rows
        cells = rows * HASHES * width
        self.count, self.key, self.check = np.zeros(cells, dtype=np.int32), np.zeros(cells, dtype=np.uint64), np.zeros(cells, dtype=np.uint32)

    def cells(self, row: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The flat numbers of the cells of each digest, by hash."""
        at = [mixed(keys, np.uint64(1000 * self.width + h)) % np.uint64(self.width) + np.uint64(h * self.width) for h in range(HASHES)]
        return row.astype(np.int64) * (HASHES * self.width) + np.array(at, dtype=np.int64)

    @staticmethod
    def checks(keys: np.ndarray) -> np.ndarray:
        return (mixed(keys, np.uint64(99)) >> np.uint64(32)).astype(np.uint32)

    def put(self, row: np.ndarray, keys: np.ndarray, sign: np.ndarray | int) -> None:
        checks = self.checks(keys)
        for at in self.cells(row, keys):
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, keys)
            np.bitwise_xor.at(self.check, at, checks)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What single cells show, round by round: rows, digests, signs; and which rows have nothing left."""
        found = []
        while True:
            single = np.flatnonzero(np.abs(self.count) == 1)
            single = single[self.checks(self.key[single]) == self.check[single]]
            if not len(single):
                break
            row = single // (HASHES * self.width)
            _, first = np.unique(np.stack([row.astype(np.uint64), self.key[single]]), axis=1, return_index=True)
            row, key, sign = row[first], self.key[single[first]], self.count[single[first]]
            found.append((row, key, sign))
            self.put(row, key, -sign)
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        parts = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, dtype=k) for k in (np.int64, np.uint64, np.int32)]
        return *parts, ~left.reshape(self.rows, -1).any(axis=1)

    def texts(self) -> list[str]:
        """Each row as text: counts, exclusive ors of digests, exclusive ors of checks; base64."""
        parts = [x.reshape(self.rows, -1) for x in (self.count.astype("<i4"), self.key.astype("<u8"), self.check.astype("<u4"))]
        return [base64.b64encode(b"".join(p[k].tobytes() for p in parts)).decode() for k in range(self.rows)]


def sketch(sets: list[np.ndarray], width: int = WIDTH) -> Tables:
    out = Tables(len(sets), width)
    if sets:
        out.put(np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets), 1)
    return out


def difference(a: Tables, b: Tables, left: np.ndarray, right: np.ndarray) -> Tables:
    """Rows ``left`` of ``a`` less rows ``right`` of ``b``."""
    out = Tables(len(left), a.width)
    pick = lambda x, rows: x.reshape(-1, HASHES * a.width)[rows].ravel()
    out.count = pick(a.count, left) - pick(b.count, right)
    out.key = pick(a.key, left) ^ pick(b.key, right)
    out.check = pick(a.check, left) ^ pick(b.check, right)
    return out


def differing(sets: list[np.ndarray], pairs: np.ndarray, width: int = WIDTH) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pair of sets: the digests of the first alone, and of the second alone, by sketches alone."""
    out: list = [None] * len(pairs)
    todo, at_first = np.arange(len(pairs)), sketch(sets, width)
    while len(todo):
        which, place = np.unique(pairs[todo], return_inverse=True)
        place = place.reshape(-1, 2)
        tables = at_first if width == at_first.width else sketch([sets[k] for k in which], width)
        ends = pairs[todo] if width == at_first.width else place
        row, key, sign, whole = difference(tables, tables, ends[:, 0], ends[:, 1]).peel()
        order = np.argsort(row, kind="stable")
        row, key, sign = row[order], key[order], sign[order]
        edges = np.searchsorted(row, np.arange(len(todo) + 1))
        for k in np.flatnonzero(whole):
            here = slice(edges[k], edges[k + 1])
            out[todo[k]] = (key[here][sign[here] > 0], key[here][sign[here] < 0])
        todo, width = todo[~whole], width * GROWTH
    return out


def likeness(sizes: tuple[int, int], apart: int) -> float:
    """Shared digests among all digests of two sets that differ in ``apart``; 1 for two empty sets."""
    return (sum(sizes) - apart) / (sum(sizes) + apart) if sum(sizes) else 1.0


def _fingerprinted(texts: list[str], edited: list[str]) -> tuple[list, ...]:
    """For documents in order (``texts`` has one more, the next of the last): fingerprints, edited fingerprints, likenesses."""
    n = len(edited)
    sets = [digests(t) for t in texts + edited]
    base = sketch(sets).texts()
    at = np.arange(n)
    pairs = np.concatenate([np.stack([at, n + 1 + at], axis=1), np.stack([at, at + 1], axis=1)])
    near = [likeness((len(sets[a]), len(sets[b])), len(x) + len(y)) for (a, b), (x, y) in zip(pairs, differing(sets, pairs))]
    return base[:n], base[n + 1 :], near[:n], near[n:]


def followed(docs: DataFrame) -> DataFrame:
    """``place``, ``guest``, ``doc_id``, ``mark``, ``text``: documents dealt by ranges of their order, each range followed by the document after it.

    The order is descending ``doc_id``, rows without number last; equal numbers by a hash of the text.  Bounds of the
    ranges and the first document of each, ``MOST_RANGES`` and ``UNNUMBERED_RANGES`` at most, are found on the driver.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    numbers = texts.select("doc_id").where("doc_id is not null")
    ranges = max(1, min(MOST_RANGES, -(-numbers.count() // ROWS_PER_RANGE)))
    ranks = [k / ranges for k in range(1, ranges)]
    bounds = numbers.agg(F.percentile_approx(F.col("doc_id").cast("double"), ranks, max(10_000, 8 * ranges))).first()[0] if ranks else []
    mark = F.xxhash64("text")
    # The upper bits of a hash keep its order.
    unnumbered = F.lit(MOST_RANGES) + F.shiftright(mark, 52) + UNNUMBERED_RANGES // 2
    placed = with_buckets(texts.where("doc_id is not null").withColumn("number", F.col("doc_id").cast("double")), ["number"], [sorted(set(bounds or []))], ["range"])
    placed = placed.select((F.lit(MOST_RANGES) - F.col("range").cast("long") - 1).alias("place"), F.col("doc_id"), mark.alias("mark"), "text")
    rest = texts.where("doc_id is null").select(unnumbered.cast("long").alias("place"), "doc_id", mark.alias("mark"), "text")
    firsts = [(r[0], True, r[1]) for r in placed.groupBy("place").agg(F.max("doc_id")).collect()]
    firsts = sorted(firsts + [(r[0], False, r[1]) for r in rest.groupBy("place").agg(F.min("mark")).collect()])
    # The first document of a range also goes to the range before it, that of the first range to the last.
    also = [(numbered, first, firsts[k - 1][0]) for k, (_, numbered, first) in enumerate(firsts)]
    also = spark.createDataFrame(also, "numbered boolean, first long, before long")
    rows = placed.unionByName(rest).withColumns({"numbered": F.col("doc_id").isNotNull(), "first": F.coalesce("doc_id", "mark")})
    own, ahead = F.struct("place", F.lit(False).alias("guest")), F.struct(F.col("before").alias("place"), F.lit(True).alias("guest"))
    return rows.join(F.broadcast(also), ["numbered", "first"], "left").select(
        F.inline(F.filter(F.array(own, ahead), lambda x: x["place"].isNotNull())), "doc_id", "mark", "text")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The edited text has its last ``n_chars // 2`` code points replaced by the first as many of the next document, or all it has.  Next is the next
    smaller ``doc_id``; rows of one number follow each other by a hash of their texts, rows without number come last by that
    hash, and the first document follows the last.  A single document is its own next.  Null texts count as empty; two empty
    texts are alike.  Likeness is the share of paragraphs in common, recovered exactly by the sketches.  Only
    ``doc_id`` and ``text`` are read; an empty table gives an empty table.
    """
    dealt = followed(docs).repartition("place").sortWithinPartitions("place", "guest", F.desc("doc_id"), "mark", "text")

    def run(batches):
        for ids, texts in _runs(batches):
            edited = [t[: len(t) - len(t) // 2] + follow[: len(t) // 2] for t, follow in zip(texts, texts[1:])]
            prints, edited_prints, near_edited, near_next = _fingerprinted(texts, edited)
            out = [ids, [len(t) for t in texts[:-1]], [hashlib.sha256(t.encode()).hexdigest() for t in edited], prints, edited_prints, near_edited, near_next]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, (_, kind) in zip(out, FIELDS)], [name for name, _ in FIELDS])

    return dealt.select("place", "guest", "doc_id", "text").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
          ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]


def _runs(batches) -> Iterator[tuple[list, list]]:
    """Numbers of consecutive documents, and their texts with that of the document after the last, in bounded pieces."""
    ids: list = []
    texts: list[str] = []
    here, size = None, 0
    for batch in batches:
        for place, guest, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
            if place != here:
                here, ids, texts, size = place, [], [], 0
            elif len(texts) > len(ids):  # the range is closed: other documents with the number of the first guest
                continue
            texts.append(text)
            if guest or len(ids) == PAIRS or size > 40 * DIGESTS:
                yield ids, texts
                ids, texts, size = [], [text], 0
            if guest:
                continue
            ids.append(doc)
            size += len(text)


def op13_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprint_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))

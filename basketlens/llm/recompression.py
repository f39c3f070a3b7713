"""Substring dedup by recompression.

The words of a text are rewritten in rounds: every run of one symbol becomes a symbol, then every pair of a left and a right
symbol (each symbol is one or the other, by a random bit of its name and the round) becomes a symbol.  Names are hashes of what they stand for, so
equal runs and pairs get equal names everywhere without being looked up, and equal passages turn into equal symbols but for a
few at their ends, which may have joined with what stands outside.

A window of words is thus told by what is popped from its ends in each round, as it would join with the outside, and the
core that is left: equal windows, and only they, have equal pops and cores.  Two Spark exchanges use this:

1. Which high-level symbols occur twice anywhere?  A window whose core holds any other symbol is unique.
2. Which of the remaining windows, named by pops and core, occur twice anywhere?
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.shipping import by_value
from basketlens.llm.blocks import BUCKET_BYTES, FAN, REQUEST, answered, distinct, each_block, exchange, pack, requests, route, unpacked
from basketlens.llm.learning import mixed
from basketlens.session import Scratch

by_value(__name__)

WINDOW = 35
ROUNDS = 4  # of runs and pairs: symbols then stand for three words on average, sixteen at most but for runs
STEP = np.uint64(0x5851F42D4C957F2D)
BACK = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
SECOND = np.uint64(0xDA942042E4DD58B5)
SECOND_BACK = np.uint64(pow(0xDA942042E4DD58B5, -1, 1 << 64))


class Round:
    """One round on the symbols of a block; 0 stands between documents and never joins."""

    def __init__(self, symbols: np.ndarray, number: int) -> None:
        self.before = symbols
        first = np.ones(len(symbols), dtype=bool)
        first[1:] = (symbols[1:] != symbols[:-1]) | (symbols[1:] == 0)
        begin = np.flatnonzero(first)
        end = np.append(begin[1:], len(symbols))
        self.run_of = np.cumsum(first, dtype=np.int32) - 1
        self.run_begin, self.run_end = begin.astype(np.int32), end.astype(np.int32)
        length = end - begin
        runs = symbols[begin]
        long = length > 1
        runs[long] = mixed(runs[long], length[long].astype(np.uint64) + np.uint64(2 << 40)) | np.uint64(1)
        self.runs = runs
        self.right = (mixed(runs, np.uint64(77 + number)) & np.uint64(1)).astype(bool)
        joins = ~self.right[:-1] & self.right[1:] & (runs[:-1] != 0) & (runs[1:] != 0)
        keep = np.ones(len(runs), dtype=bool)
        keep[1:] = ~joins
        self.new_of = np.cumsum(keep, dtype=np.int32) - 1
        kept = np.flatnonzero(keep)
        self.after = runs[kept]
        pairs = np.flatnonzero(np.append(joins, False)[kept])
        self.after[pairs] = mixed(mixed(runs[kept[pairs]], np.uint64(3 << 40)), runs[kept[pairs] + 1]) | np.uint64(1)

    def narrow(self, left: np.ndarray, right: np.ndarray, seen: list[np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
        """Windows (first symbol, one past the last) of the old symbols as windows of the new; what is popped goes into the two hashes ``seen``."""
        # The first and last runs may go on outside: pop them, with the length that is inside.
        live = left < right
        a = np.minimum(self.run_end[self.run_of[left]], right)
        if seen is not None:
            pop = mixed(mixed(seen[0], self.before[left]), (a - left).astype(np.uint64))
            seen[0] = np.where(live, pop, seen[0])
        left = np.where(live, a, left)
        live = left < right
        last = np.maximum(right - 1, 0)
        b = np.maximum(self.run_begin[self.run_of[last]], left)
        if seen is not None:
            pop = mixed(mixed(seen[1], self.before[last]), (right - b).astype(np.uint64))
            seen[1] = np.where(live, pop, seen[1])
        right = np.where(live, b, right)
        live = left < right
        # Whole runs are left.  A right symbol in front or a left symbol at the end may join with the outside: pop it too.
        l = self.run_of[np.minimum(left, len(self.run_of) - 1)]
        r = np.where(live, self.run_of[np.maximum(right - 1, 0)] + 1, l)
        pop_l = live & self.right[l]
        if seen is not None:
            seen[0] = np.where(pop_l, mixed(seen[0], self.runs[l]), seen[0] ^ np.uint64(1))
        l = l + pop_l
        live = l < r
        last = np.maximum(r - 1, 0)
        pop_r = live & ~self.right[last]
        if seen is not None:
            seen[1] = np.where(pop_r, mixed(seen[1], self.runs[last]), seen[1] ^ np.uint64(1))
        r = r - pop_r
        live = l < r
        new_l = self.new_of[np.minimum(l, len(self.new_of) - 1)]
        return new_l, np.where(live, self.new_of[np.maximum(r - 1, 0)] + 1, new_l)


class Recompressed:
    """The words of a block, its rounds, and its windows."""

    def __init__(self, row: dict, window: int = WINDOW, rounds: int = ROUNDS) -> None:
        self.ids, sizes, text = unpacked(row)
        self.window = window
        self.words: list[list[bytes]] = []
        at = 0
        for size in sizes.tolist():
            self.words.append(text[at : at + size].split())  # bytes: exactly the blanks 0x20 and 0x09-0x0D
            at += size
        counts = np.array([len(w) for w in self.words], dtype=np.int64)
        self.begin = np.cumsum(counts + 1) - counts  # a separator stands before each document
        symbols = np.zeros(int(counts.sum()) + len(counts) + 1, dtype=np.uint64)
        for b, words in zip(self.begin.tolist(), self.words):
            symbols[b : b + len(words)] = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64) | np.uint64(1)
        self.rounds: list[Round] = []
        for k in range(rounds):
            self.rounds.append(Round(symbols, k))
            symbols = self.rounds[-1].after
        self.top = symbols
        has = np.maximum(counts - window + 1, 0)
        self.starts = np.repeat(self.begin - np.cumsum(has) + has, has) + np.arange(int(has.sum()))

    def symbols(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct top symbols and how often the block holds each."""
        return np.unique(self.top[self.top != 0], return_counts=True)

    def cores(self, starts: np.ndarray, seen: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        left, right = starts.astype(np.int64), starts.astype(np.int64) + self.window
        for r in self.rounds:
            left, right = r.narrow(left, right, seen)
        return left, right

    def repeated_cores(self, shared: np.ndarray) -> np.ndarray:
        """Starts of the windows whose core holds only symbols that occur elsewhere; ``shared`` is by distinct top symbol."""
        names, _ = self.symbols()
        lone = np.zeros(len(self.top) + 1, dtype=np.int64)
        if len(names):
            lone[1:] = np.cumsum((self.top != 0) & ~shared[np.minimum(np.searchsorted(names, self.top), len(names) - 1)])
        left, right = self.cores(self.starts)
        return self.starts[lone[right] == lone[left]]

    def names(self, starts: np.ndarray) -> np.ndarray:
        """Names of windows from pops and core: two hashes of 64 bits that share nothing but the symbols."""
        halves = []
        for step, back, salt in ((STEP, BACK, 5), (SECOND, SECOND_BACK, 7)):
            seen = [np.full(len(starts), salt, dtype=np.uint64), np.full(len(starts), salt + 1, dtype=np.uint64)]
            left, right = self.cores(starts, seen)
            core = spans(self.top, left, right, step, back)
            halves.append(mixed(mixed(mixed(seen[0], seen[1]), core), (right - left).astype(np.uint64)))
        return np.stack(halves, axis=1)


def spans(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, step: np.uint64 = STEP, back: np.uint64 = BACK) -> np.ndarray:
    """Hashes of the symbols (hashes themselves) from ``left`` to before ``right``: a polynomial, which division brings to the span's own start."""
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(symbols), step)]))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(symbols * power[:-1])])
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(symbols), back)]))
        return (sums[right] - sums[left]) * power[left]


def drop_repeated_windows(
    docs: DataFrame, scratch: Scratch, window: int = WINDOW, rounds: int = ROUNDS, bucket_bytes: int = BUCKET_BYTES, fan: int = FAN
) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``n_removed``, ``text`` (kept words joined by one blank).

    A word goes if it lies in a window of ``window`` words that starts at two or more places in all of ``docs``, the same
    document included.  Null, empty and blank texts have no words; texts shorter than a window lose none; rows that repeat are
    documents of their own, so both lose what they share; null ids stay null.  An empty table gives an empty table.  Only ``doc_id`` and
    ``text`` are read.  Names of windows have 128 bits: among n different ones, n squared / 2^129 pairs are expected to share a name.
    """
    blocks = pack(docs, scratch)
    path = route(blocks, bucket_bytes, fan)

    def many(totals):
        return totals > 1

    def ask_symbols(row):
        names, times = Recompressed(row, window, rounds).symbols()
        return requests(row["block"], names[:, None], times, path, path.width)

    shared = exchange(each_block(blocks, ask_symbols, REQUEST), path, path.width, many, scratch, "symbols")
    joined = blocks.join(shared, "block", "left")

    def candidates(row):
        r = Recompressed(row, window, rounds)
        starts = r.repeated_cores(answered(r.symbols()[0][:, None], row["replies"], path).astype(bool))
        return r, starts, *distinct(r.names(starts))

    def ask_windows(row):
        _, _, known, where = candidates(row)
        return requests(row["block"], known, np.bincount(where, minlength=len(known)), path, 16)

    windows = exchange(each_block(joined, ask_windows, REQUEST), path, 16, many, scratch, "windows").withColumnRenamed("replies", "found")

    def finish(row):
        r, starts, known, where = candidates(row)
        hit = starts[answered(known, row["found"], path).astype(bool)[where]]
        edge = np.zeros(len(r.rounds[0].before) + window + 1 if r.rounds else window + 1, dtype=np.int32)
        edge[hit] += 1
        edge[hit + window] -= 1
        gone = np.cumsum(edge) > 0
        texts, removed = [], []
        for b, words in zip(r.begin.tolist(), r.words):
            out = gone[b : b + len(words)]
            removed.append(int(out.sum()))
            texts.append(b" ".join([w for w, g in zip(words, out.tolist()) if not g] if removed[-1] else words))
        return pa.RecordBatch.from_arrays(
            [pa.array(r.ids, pa.int64()), pa.array([len(w) for w in r.words], pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.binary())],
            ["doc_id", "n_words", "n_removed", "text"],
        )

    both = joined.join(windows, "block", "left")
    return each_block(both, finish, "doc_id long, n_words long, n_removed long, text binary").withColumn("text", F.col("text").cast("string"))


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    kept = drop_repeated_windows(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "recompression"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (
  SELECT r, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos, len(w) AS n FROM d
), s AS (
  SELECT r, pos, md5(array_to_string(list_slice(w, pos, pos + 34), ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS pos FROM d)
), hit AS (
  SELECT r, pos FROM (SELECT r, pos, count(*) OVER (PARTITION BY h) AS c FROM s) WHERE c > 1
), g AS (
  SELECT p.*, max(hit.pos) OVER (PARTITION BY p.r ORDER BY p.pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM p LEFT JOIN hit ON hit.r = p.r AND hit.pos = p.pos
), k AS (
  SELECT r, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS kept FROM g GROUP BY r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""

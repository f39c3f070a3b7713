"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

A document window is compared with a benchmark item of about its size, by edit distance in words.  The CGK random walk maps
both to strings in which a small edit distance becomes a small Hamming distance; hash tables that each sample a few of
those positions find the close pairs; an edit distance decides.  The strings drift apart with every edit, so an item is embedded
in parts of bounded length: one of them has at most its share of the edits, and recall does not fall with the length.

A window is embedded only where runs of words allow a match: an edit breaks at most ``q`` of an item's runs of ``q``
words, so the window must hold the rest.  That count loses nothing and leaves the walk to few windows.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.shipping import by_value
from basketlens.llm.learning import mixed

by_value(__name__)

SIMILARITY = 0.8
RUN_WORDS = 3  # in a run that is looked up, at most
WALKS, TABLES, SAMPLED = 6, 8, 3  # random walks, tables for each, positions that a table samples
PART = 16  # words of an item that are embedded together, at least, if it has as many
BLOCK_ITEMS = 20_000  # benchmark items that are sent to the executors at once, at most
BLOCK_BYTES = 32 << 20
PAD = np.uint64(0)


def tokens(text: bytes | None) -> np.ndarray:
    """64-bit names of the words, A-Z lower-cased."""
    words = (text or b"").lower().split()
    return np.array([xxhash.xxh3_64_intdigest(w) | 1 for w in words], dtype=np.uint64)


def allowed(words: int, similarity: float = SIMILARITY) -> int:
    """Most edits between an item of ``words`` words and a window that are still similar.

    The similarity is 1 less the distance over the longer of the two, and the longer has at most
    ``words / similarity`` words.
    """
    return int(words * (1 - similarity) / similarity + 1e-9)


def embed(windows: np.ndarray, walks: int, steps: int) -> np.ndarray:
    """First ``steps`` words of the CGK embeddings of word windows (rows, padded with ``PAD``): walk, window, step.

    Each step writes the word under the pointer, then moves the pointer on or not by a random bit of walk, step and word.
    """
    rows, width = windows.shape
    padded = np.tile(np.concatenate([windows, np.full((rows, 1), PAD)], axis=1), (walks, 1))
    line, at = np.arange(len(padded)), np.zeros(len(padded), dtype=np.int64)
    walk = np.repeat(np.arange(walks, dtype=np.uint64) << np.uint64(32), rows)
    out = np.empty((steps, len(padded)), dtype=np.uint64)
    for step in range(steps):
        out[step] = word = padded[line, at]
        at = np.minimum(at + (mixed(word, walk + np.uint64(1 + step)) & np.uint64(1)).astype(np.int64), width)
    return out.T.reshape(walks, rows, steps)


def signatures(windows: np.ndarray) -> np.ndarray:
    """``WALKS * TABLES`` hashes of each window, each of ``SAMPLED`` positions of an embedding.

    The walk advances at half of its steps, so the words lie within the first two thirds of the string of three times
    the length; the rest is padding and is not sampled.
    """
    reach = 2 * windows.shape[1]
    strings = embed(windows, WALKS, reach)
    made = []
    for table in range(TABLES):
        h = np.full(strings.shape[:2], np.uint64(table))
        for spot in np.sort(np.random.default_rng((table, reach)).choice(reach, SAMPLED, replace=reach < SAMPLED)):
            h = mixed(h, strings[:, :, spot])
        made.append(h)
    return np.concatenate(made).T


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Distances from all of ``a`` to every prefix of each row of ``b``; values above ``most`` are only known to be above it."""
    steps = np.arange(b.shape[1] + 1, dtype=np.int64)
    out = np.full((len(b), len(steps)), most + 1)
    live, above = np.arange(len(b)), np.tile(steps, (len(b), 1))
    for i, word in enumerate(a, 1):
        row = above + 1
        row[:, 1:] = np.minimum(row[:, 1:], above[:, :-1] + (b[live] != word))
        row[:, 0] = i
        row = np.minimum.accumulate(row - steps, axis=1) + steps
        stays = row.min(axis=1) <= most
        live, above = live[stays], row[stays]
        if not len(live):
            return out
    out[live] = above
    return out


def least_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each start in ``b`` the distance from ``a`` to the nearest stretch of words that begins there."""
    b = b[::-1]
    steps = np.arange(len(b) + 1, dtype=np.int64)
    above = np.zeros(len(b) + 1, dtype=np.int64)
    for i, word in enumerate(a[::-1], 1):
        row = above + 1
        row[1:] = np.minimum(row[1:], above[:-1] + (b != word))
        row[0] = i
        above = np.minimum.accumulate(row - steps) + steps
    return above[::-1]


def parts(words: int) -> list[tuple[int, int]]:
    """First word and length of the parts in which an item is embedded: equal ones of ``PART`` words or up to twice as many."""
    ends = np.linspace(0, words, max(1, words // PART) + 1).astype(int).tolist()
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


class Items:
    """A bounded block of benchmark items, prepared for look-up."""

    def __init__(self, items: list[tuple[int, bytes]], similarity: float = SIMILARITY) -> None:
        self.similarity = similarity
        self.words = {item: w for item, text in items if len(w := tokens(text))}
        self.runs: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        self.size: dict[int, int] = {}
        self.signed: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
        for item, w in self.words.items():
            size = next(q for q in range(RUN_WORDS, 0, -1) if self.least(item, q) >= 1 and self.least_of_parts(item, q) >= 1)
            self.size[item] = size
            for at, h in enumerate(_runs(w, size).tolist()):
                self.runs[size][h].append((item, at))
            self.signed[item] = [(o, w[o : o + n], signatures(w[None, o : o + n])[0]) for o, n in parts(len(w))]
        self.sorted = {size: np.array(sorted(table), dtype=np.uint64) for size, table in self.runs.items()}
        self.runs = {size: dict(table) for size, table in self.runs.items()}

    def least(self, item: int, size: int) -> int:
        """Runs of ``size`` words that a similar window shares with the item, at least."""
        n = len(self.words[item])
        return n - size + 1 - allowed(n, self.similarity) * size

    def least_of_parts(self, item: int, size: int) -> int:
        """Runs of ``size`` words that the part with at most its share of the edits keeps, at least."""
        n = len(self.words[item])
        return min(part - size + 1 - allowed(n, self.similarity) * part // n * size for _, part in parts(n))

    def starts(self, item: int, words: np.ndarray, hits: list[tuple[int, int]]) -> np.ndarray:
        """First words of the windows to verify: those about each place where a part of the item agrees in a table.

        Some part has at most its share of the item's edits, and so some of its runs unbroken.
        """
        n, size = len(self.words[item]), self.size[item]
        most = allowed(n, self.similarity)
        agreed = []
        for offset, part, signed in self.signed[item]:
            share = most * len(part) // n
            # An edit before a run shifts the part's start by at most its number.
            begins = {p - o for p, o in hits if offset <= o <= offset + len(part) - size}
            tried = np.unique(np.array(sorted(begins), dtype=np.int64)[:, None] + np.arange(-share, share + 1)) + offset
            tried = np.unique(np.clip(tried, 0, len(words) - 1))
            for begin in range(0, len(tried), 4096):
                some = tried[begin : begin + 4096]
                alike = (signatures(_windows(words, some, len(part))) == signed).any(axis=1)
                agreed.append(some[alike] - offset)
        if not agreed:
            return np.zeros(0, dtype=np.int64)
        # Edits before the part shift the window's start against the part's.
        starts = np.unique(np.concatenate(agreed)[:, None] + np.arange(-most, most + 1))
        return np.unique(np.clip(starts, 0, len(words) - 1))

    def verified(self, item: int, words: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int]]:
        """The best windows among neighbouring starts, one where they overlap."""
        w, found = self.words[item], []
        most = allowed(len(w), self.similarity)
        if not len(starts):
            return found
        least = least_distance(w, words[starts[0] : starts[-1] + len(w) + most])[: len(starts)]
        keep = least <= most
        starts, least = starts[keep], least[keep]
        for place in np.split(np.arange(len(starts)), np.flatnonzero(np.diff(starts) > 1) + 1):
            # In a short place all windows overlap: the best is found once no other start can be nearer.
            short = len(place) <= 2 * most + 1
            if short:
                place = place[np.argsort(least[place], kind="stable")]
            best = None
            for begin in range(0, len(place), 16):
                some = place[begin : begin + 16]
                if short and best and least[some[0]] > best[3]:
                    break
                rows = edit_distance(w, _windows(words, starts[some], len(w) + most), most)
                for s, row in zip(starts[some].tolist(), rows):
                    row = row[: len(words) - s + 1]
                    share = 1 - row / np.maximum(len(w), np.arange(len(row)))
                    end = int(share.argmax())
                    if row[end] > most or share[end] < self.similarity - 1e-9:
                        continue
                    hit = (item, s, end, int(row[end]))
                    if best and (short or hit[1] < best[1] + best[2]):
                        best = min(best, hit, key=lambda h: (h[3], h[1]))  # overlapping windows of one place
                    else:
                        found += [best] if best else []
                        best = hit
            found += [best] if best else []
        return found

    def find(self, words: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item, first word, words, distance): the best window for every place where an item is found."""
        places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for size, known in self.sorted.items():
            if len(words) < size:
                continue
            runs = _runs(words, size)
            spot = np.minimum(np.searchsorted(known, runs), len(known) - 1)
            for p in np.flatnonzero(known[spot] == runs).tolist():
                for item, at in self.runs[size][int(runs[p])]:
                    places[item].append((p, at))
        found = []
        for item, hits in places.items():
            w, size = self.words[item], self.size[item]
            most, least = allowed(len(w), self.similarity), self.least(item, size)
            at = np.unique(np.array([p for p, _ in hits]))
            if len(at) < least:
                continue
            first = np.flatnonzero(at[least - 1 :] - at[: len(at) - least + 1] <= len(w) + most - size)
            near = {int(p) for k in first for p in at[k : k + least]}
            starts = self.starts(item, words, [(p, o) for p, o in hits if p in near])
            for place in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                found += self.verified(item, words, place)
        return found


def _windows(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """``size`` words from each start, padded with ``PAD``."""
    spread = starts[:, None] + np.arange(size)
    return np.where(spread < len(words), words[np.minimum(spread, len(words) - 1)], PAD)


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    h = words[: len(words) - size + 1]
    for k in range(1, size):
        h = mixed(h, words[k : len(words) - size + 1 + k])
    return h


def benchmark_blocks(benchmark: DataFrame, most_items: int = BLOCK_ITEMS, most_bytes: int = BLOCK_BYTES):
    """Lists of (item, text), each within both bounds; a benchmark beyond them comes in several blocks.

    Items without number, null and blank items match nothing and are left out.  Items that share a number are told apart by their text:
    the first by text is taken.
    """
    items = benchmark.select("item_id", F.col("text").cast("binary").alias("text")).where("item_id is not null and text is not null")
    block, size = [], 0
    for row in items.groupBy("item_id").agg(F.min("text").alias("text")).orderBy("item_id").toLocalIterator():
        if block and (len(block) >= most_items or size + len(row.text) > most_bytes):
            yield block
            block, size = [], 0
        block.append((row.item_id, bytes(row.text)))
        size += len(row.text)
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id``, ``item_id``, ``start`` (word), ``n_words``, ``distance``, ``similarity`` of each benchmark passage in a document.

    The benchmark is the stated query set: it goes to the executors in blocks of bounded size, and every block meets all documents in
    one pass without a shuffle.  Null and empty texts hold nothing; rows without ``doc_id`` are searched and reported with null.
    Repeated rows are each reported.  Items shorter than a few words match when their words stand unchanged.
    Only ``doc_id`` and ``text`` are read.  An empty benchmark or table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, start int, n_words int, distance int, similarity double"
    texts = docs.select("doc_id", F.col("text").cast("binary"))
    result = None
    for block in benchmark_blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            items = Items(sent.value, similarity)
            for batch in batches:
                rows = []
                for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                    for item, start, n, distance in items.find(tokens(text)):
                        rows.append((doc, item, start, n, distance, 1 - distance / max(n, len(items.words[item]))))
                columns = list(zip(*rows)) if rows else [()] * 6
                types = [batch.schema.field(0).type, pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "item_id", "start", "n_words", "distance", "similarity"])

        part = texts.mapInArrow(run, schema)
        result = part if result is None else result.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if result is None else result


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    return find_leaks(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark")))

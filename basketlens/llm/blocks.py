"""Documents in packed blocks, and the exchange that tells each block which of its names others have too."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.shipping import by_value
from basketlens.session import Scratch

by_value(__name__)

BLOCK_BYTES = 4 << 20  # text in a block, unless one document is longer
BUCKET_BYTES = 16 << 20  # text for each bucket of an exchange
FAN = 256  # buckets that a block, or a fleet of so many blocks, sends to
MOST = 0xFFFF  # counts go no further


def pack(docs: DataFrame, scratch: Scratch, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``block``, ``ids``, ``sizes``, ``bytes``, ``data``: documents in blocks, compressed, written once.

    A block is numbered by the task and its place in it.  The committed files fix both, so later reads agree whatever is retried.
    Texts are whole; null texts have size 0.  Documents of a block are in the order of their ids.
    """

    def emit(task: int, serial: int, rows: list) -> pa.RecordBatch:
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        data = zstandard.ZstdCompressor(level=3).compress(b"".join(r[1] for r in rows))
        return pa.RecordBatch.from_arrays(
            [pa.array([(task << 32) + serial], pa.int64()), pa.array([[r[0] for r in rows]], pa.list_(pa.int64())),
             pa.array([[len(r[1]) for r in rows]], pa.list_(pa.int32())), pa.array([sum(len(r[1]) for r in rows)], pa.int64()), pa.array([data], pa.binary())],
            ["block", "ids", "sizes", "bytes", "data"],
        )

    def run(batches):
        task, serial, rows, size = TaskContext.get().partitionId(), itertools.count(), [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or b""
                if rows and size + len(text) > block_bytes:
                    yield emit(task, next(serial), rows)
                    rows, size = [], 0
                rows.append((doc, text))
                size += len(text)
        if rows:
            yield emit(task, next(serial), rows)

    packed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
        run, "block long, ids array<long>, sizes array<int>, bytes long, data binary")
    return scratch.write(packed, "blocks")


@dataclass(frozen=True)
class Route:
    """The buckets of each level of an exchange, and the groups in which blocks go from one level to the next."""

    fans: tuple[int, ...]
    fleets: tuple[int, ...]

    @property
    def width(self) -> int:
        """Bytes of a name that only has to differ from the others of its bucket: the bucket tells enough where there is one level."""
        return 4 if len(self.fans) == 1 else 8

    def digit(self, names: np.ndarray, level: int) -> np.ndarray:
        """The bucket of names (64 bits) among those of a level; one level tells nothing of another."""
        # Bits that the 32 low bits of a name do not determine.
        spread = (names * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return (spread // np.uint64(math.prod(self.fans[:level])) % np.uint64(self.fans[level])).astype(np.uint16)


def route(blocks: DataFrame, bucket_bytes: int, fan: int = FAN) -> Route:
    """Buckets in proportion to the text, reached in steps of at most ``fan``.

    A block sends ``fan`` rows whatever the number of buckets.  Beyond one level, ``fan`` blocks that sent to one bucket are a fleet; it
    sends on what they sent, ``fan`` rows again.  So rows grow with the text, by ``fan`` a block and level, and not with blocks times buckets.
    """
    count, size = blocks.agg(F.count("*"), F.sum("bytes")).first()
    buckets, fans, fleets = -(-(size or 0) // bucket_bytes), [fan], []
    while (left := -(-buckets // math.prod(fans))) > 1:
        fans.append(min(left, fan))
        fleets.append(max(1, -(-count // fan ** len(fleets) // fan)))
    return Route(tuple(fans), tuple(fleets))


def unpacked(row: dict) -> tuple[list, np.ndarray, bytes]:
    """Ids, sizes and joined texts of a block."""
    sizes = np.asarray(row["sizes"], dtype=np.int64)
    return row["ids"], sizes, zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=int(sizes.sum()) + 1)


def each_block(blocks: DataFrame, work: Callable[[dict], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``work`` on every block by itself: one is in memory at a time."""

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                out = work(batch.slice(at, 1).to_pylist()[0])
                if out is not None:
                    yield out

    return blocks.mapInArrow(run, schema)


def by_bucket(names: np.ndarray, path: Route, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Names in the order of their buckets, and where each bucket begins."""
    place = path.digit(names[:, 0], level)
    order = np.argsort(place, kind="stable")
    return order, np.searchsorted(place[order], np.arange(path.fans[level] + 1))


def distinct(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different names in their order, and which of them each row is."""
    order = np.argsort(names[:, 0])
    turned = names[order]
    if names.shape[1] > 1 and ((turned[1:, 0] == turned[:-1, 0]) & (turned[1:] != turned[:-1]).any(axis=1)).any():  # halves that collide
        order = np.lexsort(names.T[::-1])
        turned = names[order]
    fresh = np.ones(len(turned), dtype=bool)
    fresh[1:] = (turned[1:] != turned[:-1]).any(axis=1)
    where = np.empty(len(turned), dtype=np.int64)
    where[order] = np.cumsum(fresh) - 1
    return turned[fresh], where


def small(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def large(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=kind)


REQUEST = "bucket long, block long, names binary, counts binary"
REPLY = "bucket long, block long, reply binary"


def requests(block: int, names: np.ndarray, counts: np.ndarray, path: Route, width: int, level: int = 0, bucket: int = 0) -> pa.RecordBatch:
    """One row per bucket: distinct names (rows of one or two 64-bit words, of which ``width`` bytes go out) and a count for each."""
    order, edges = by_bucket(names, path, level)
    kept, counts = names[order].astype("<u4" if width == 4 else "<u8"), np.minimum(counts[order], MOST).astype("<u2")
    full = np.flatnonzero(np.diff(edges))
    return pa.RecordBatch.from_arrays(
        [pa.array(full + bucket * path.fans[level], pa.int64()), pa.array(np.full(len(full), block), pa.int64()),
         pa.array([kept[edges[b] : edges[b + 1]].tobytes() for b in full], pa.binary()),
         pa.array([small(counts[edges[b] : edges[b + 1]]) for b in full], pa.binary())],
        ["bucket", "block", "names", "counts"],
    )


def _totals(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different names of all rows, their totals, which one each asked name is, and where each row's names end."""
    rows = table.column("names").to_pylist()
    names = np.frombuffer(b"".join(rows), dtype="<u4" if width == 4 else "<u8").reshape(-1, max(1, width // 8))
    known, where = distinct(names)
    counts = np.concatenate([large(c, "<u2") for c in table.column("counts").to_pylist()])
    return known, np.bincount(where, weights=counts, minlength=len(known)).astype(np.int64), where, np.cumsum([len(r) // width for r in rows])


def _replies(table: pa.Table, told: np.ndarray, ends: np.ndarray) -> pa.Table:
    return pa.table({"bucket": table.column("bucket"), "block": table.column("block"),
                     "reply": pa.array([small(r) for r in np.split(told.astype(np.uint8), ends[:-1])], pa.binary())})


def exchange(asked: DataFrame, path: Route, width: int, told: Callable[[np.ndarray], np.ndarray], scratch: Scratch, name: str, level: int = 0) -> DataFrame:
    """``block``, ``replies`` (per bucket, a byte for each asked name): what ``told`` makes of the name's total over all blocks.

    A block sends each name once, however often it holds it, and so does a fleet, so a very common name is no hot key: at most one per
    block or fleet meets in its bucket.  Buckets are hash remainders whose number follows the input, so their size does not.
    Totals stop at 65,535.
    """
    if level + 1 == len(path.fans):

        def last(table: pa.Table) -> pa.Table:
            _, totals, where, ends = _totals(table, width)
            return _replies(table, told(np.minimum(totals, MOST))[where], ends)

        replies = asked.groupBy("bucket").applyInArrow(last, REPLY)
    else:
        fleets = path.fleets[level]
        fleet = F.pmod(F.xxhash64("block", F.lit(level)), F.lit(fleets))
        sent = scratch.write(asked.withColumn("fleet", F.col("bucket") * fleets + fleet), f"{name}-{level}")

        def merge(table: pa.Table) -> pa.Table:
            known, totals, _, _ = _totals(table, width)
            return pa.Table.from_batches([requests(table.column("fleet")[0].as_py(), known, totals, path, width, level + 1, table.column("bucket")[0].as_py())])

        answers = exchange(sent.groupBy("fleet").applyInArrow(merge, REQUEST), path, width, told, scratch, name, level + 1)

        def split(table: pa.Table, answer: pa.Table) -> pa.Table:
            known, _, where, ends = _totals(table, width)
            return _replies(table, answered(known, answer.column("replies")[0].as_py(), path, level + 1)[where], ends)

        replies = sent.groupBy("fleet").cogroup(answers.groupBy("block")).applyInArrow(split, REPLY)
    return scratch.write(replies.groupBy("block").agg(F.collect_list(F.struct("bucket", "reply")).alias("replies")), f"{name}-told-{level}")


def answered(names: np.ndarray, replies: list | None, path: Route, level: int = 0) -> np.ndarray:
    """The reply for each of the distinct names, in their order."""
    order, edges = by_bucket(names, path, level)
    out = np.zeros(len(names), dtype=np.uint8)
    for r in replies or []:
        bucket = r["bucket"] % path.fans[level]
        out[order[edges[bucket] : edges[bucket + 1]]] = large(r["reply"], "u1")
    return out

"""Suffix-array dedup: bytes covered by a long string that also starts earlier.

All occurrences of a string must meet in one shard.  So a text is cut into pieces by minimizers: every window of the
string's length takes the ``SEED``-byte string in it whose hash is least, and neighbouring windows with the same one form a piece (its windows'
bytes).  Equal windows have equal minimizers; a piece goes to its minimizer's shard, if any other piece has that
minimizer.  Each shard's different pieces are sorted by external induced sorting, and suffixes whose common prefix reaches the length are occurrences of
one string: all but the earliest are marked.

Equal pieces are sent once per block and sorted once: windows of a copy all start earlier elsewhere.  A minimizer with
very many different pieces (the border of a passage that countless documents hold) would make one shard grow with
the input: the windows of its pieces are named instead, by 128 bits, and meet by name, spread over all shards.

Beyond ``FAN`` shards, pieces and windows go there in steps (``blocks.route``); at each step, copies of one fleet are marked and only the earliest goes on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.shipping import by_value
from basketlens.llm.blocks import BUCKET_BYTES, FAN, REQUEST, Route, answered, distinct, each_block, exchange, pack, requests, route, unpacked
from basketlens.llm.induced import sorted_buckets
from basketlens.llm.learning import mixed
from basketlens.llm.recompression import BACK, SECOND, SECOND_BACK, STEP, spans
from basketlens.session import Scratch

by_value(__name__)

LENGTH = 100
SEED = 24  # bytes of a minimizer
BLOCK_BYTES = 2 << 20  # text in a block: a task needs some hundred bytes for each
SHARD_BYTES = 4 << 20  # text for each shard
CROWD = 512  # different pieces, summed over the blocks, beyond which a minimizer's windows are named
NOBODY = -(1 << 63)  # stands for a null id: before all others
LONE, SHARED, CROWDED = 0, 1, 2


def _zip(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(a.tobytes() for a in arrays))


def _unzip(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompressobj().decompress(data)


def _eights(text: bytes) -> np.ndarray:
    """The eight bytes from every position on as a number; zeros beyond the end."""
    n, padded = len(text), text + bytes(16)
    out = np.empty(n, dtype=np.uint64)
    for k in range(8):
        some = np.frombuffer(padded, dtype="<u8", offset=k, count=(n - k + 7) // 8)
        out[k::8] = some[: len(out[k::8])]
    return out


def _minimizers(eights: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of all seeds, and the place of each window's minimizer: the least hash, the leftmost of equal ones.

    Both depend on the window's content alone.
    """
    n = len(eights)
    seeds = mixed(mixed(eights[: n - seed + 1], eights[8 : n - seed + 9]), eights[16 : n - seed + 17])
    wide, count = length - seed + 1, n - length + 1
    rows = -(-len(seeds) // wide) + 1
    table = np.full(rows * wide, ~np.uint64(0))
    table[: len(seeds)] = (mixed(seeds, np.uint64(9)) & ~np.uint64(0xFFFFFFFF)) | np.arange(len(seeds), dtype=np.uint64)
    # Least values to the end of a row of ``wide`` seeds, and from its beginning: together those of any ``wide`` neighbours.
    back = np.minimum.accumulate(table.reshape(rows, wide)[:, ::-1], axis=1)[:, ::-1].ravel()[:count]
    ahead = np.minimum.accumulate(table.reshape(rows, wide), axis=1).ravel()
    del table
    return seeds, (np.minimum(back, ahead[wide - 1 : wide - 1 + count]) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


class Pieces:
    """The pieces of a block: first and last window start, name of the minimizer, document."""

    def __init__(self, row: dict, length: int = LENGTH, seed: int = SEED) -> None:
        self.ids, self.sizes, self.text = unpacked(row)
        self.begin = np.cumsum(self.sizes) - self.sizes
        n, self.length, self.eights = len(self.text), length, np.zeros(0, dtype=np.uint64)
        self.first = self.last = np.zeros(0, dtype=np.int64)
        self.names = np.zeros(0, dtype=np.uint64)
        self.doc = np.zeros(0, dtype=np.int64)
        if n < length:
            return
        self.eights = _eights(self.text)
        seeds, at = _minimizers(self.eights, length, seed)
        count = n - length + 1
        inside = np.zeros(count + 1, dtype=np.int8)
        long = np.flatnonzero(self.sizes >= length)
        inside[self.begin[long]] = 1
        ends = self.begin[long] + self.sizes[long] - length + 1
        np.add.at(inside, ends, -1)
        inside = np.cumsum(inside, dtype=np.int8)[:-1].astype(bool)
        edge = np.ones(count, dtype=bool)
        edge[1:] = (at[1:] != at[:-1]) | ~inside[:-1]
        # A new document's windows have minimizers of their own, so documents never share a piece.
        self.first = np.flatnonzero(edge & inside)
        close = np.ones(count, dtype=bool)
        close[:-1] = edge[1:] | ~inside[1:]
        self.last = np.flatnonzero(close & inside)
        self.names = seeds[at[self.first]]
        self.doc = np.searchsorted(self.begin, self.first, side="right") - 1

    def ids_of(self, which: np.ndarray) -> np.ndarray:
        ids = np.array([NOBODY if i is None else i for i in self.ids], dtype=np.int64)
        return ids[self.doc[which]]

    def contents(self, first: np.ndarray, last: np.ndarray, step: np.uint64 = STEP, back: np.uint64 = BACK) -> np.ndarray:
        """Hashes of the bytes from ``first`` to the end of the window at ``last``."""
        if not len(first):
            return np.zeros(0, dtype=np.uint64)
        end = last + self.length - 7
        return mixed(spans(mixed(self.eights, step), first, end, step, back), (end - first).astype(np.uint64))


def _asked(row: dict, path: Route, length: int) -> pa.RecordBatch:
    """The block's distinct minimizers, and for each the number of its different pieces, or 2 if there are equal ones only."""
    pieces = Pieces(row, length)
    names, where, total = np.unique(pieces.names, return_inverse=True, return_counts=True)
    content = pieces.contents(pieces.first, pieces.last)
    order = np.lexsort((content, where))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (content[order][1:] != content[order][:-1]) | (where[order][1:] != where[order][:-1])
    kinds = np.bincount(where[order][fresh], minlength=len(names))
    return requests(row["block"], names[:, None], np.where((total > 1) & (kinds == 1), 2, kinds), path, path.width)


WORK = "kind int, key long, block long, data binary, plain binary"
MARKS, SORT, NAME = 0, 1, 2


def _earliest(groups: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which entries are not the first of their group in the order of ``place``."""
    order = np.lexsort((place, groups))
    later = np.zeros(len(groups), dtype=bool)
    later[order[1:]] = groups[order][1:] == groups[order][:-1]
    return later


def _groups(sorted_keys: np.ndarray):
    if len(sorted_keys):
        edges = np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1]))
        yield from zip(sorted_keys[edges].tolist(), edges.tolist(), np.append(edges[1:], len(sorted_keys)).tolist())


def _dealt(kind: int, shards: Route, level: int, under: int, sender: int, entries: np.ndarray, texts: list[bytes]) -> list[tuple]:
    """Rows of work, one for each shard of a level.

    ``entries`` has five lines: id, name, start, block, bytes of a piece to sort; or id, both halves of the name, start, block of a window.
    """
    shard = shards.digit(entries[1].view(np.uint64), level).astype(np.int64)
    turn = np.argsort(shard, kind="stable")
    rows = []
    for s, a, b in _groups(shard[turn]):
        some = turn[a:b]
        plain = zstandard.ZstdCompressor(level=3).compress(b"".join([texts[k] for k in some.tolist()])) if texts else b""
        rows.append((kind, under * shards.fans[level] + s, sender, _zip(entries[:, some]), plain))
    return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 5
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["kind", "key", "block", "data", "plain"])


def _entries(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """The entries of all rows, and the bytes of the pieces."""
    parts, texts = [], []
    for data, plain in zip(table.column("data").to_pylist(), table.column("plain").to_pylist()):
        parts.append(np.frombuffer(_unzip(data), dtype=np.int64).reshape(5, -1))
        if plain:
            plain, sizes = _unzip(plain), parts[-1][4]
            texts += [plain[b - c : b] for b, c in zip(np.cumsum(sizes).tolist(), sizes.tolist())]
    return np.concatenate(parts, axis=1), texts


def _spread(row: dict, path: Route, shards: Route, length: int) -> pa.RecordBatch:
    """What a block sends on: marks of its own copies, pieces to sort, windows to name."""
    pieces = Pieces(row, length)
    block = row["block"]
    names, where = np.unique(pieces.names, return_inverse=True)
    state = answered(names[:, None], row["replies"], path)[where]

    # Pieces: ids rise within a block, so a lower place is an earlier start.
    live = np.flatnonzero(state == SHARED)
    content = pieces.contents(pieces.first[live], pieces.last[live])
    copy = _earliest(content ^ mixed(pieces.names[live], np.uint64(3)), live)
    marks = [np.stack([pieces.first[live[copy]], pieces.last[live[copy]]])]
    live = live[~copy]
    size = pieces.last[live] - pieces.first[live] + length
    entries = np.stack([pieces.ids_of(live), pieces.names[live].view(np.int64), pieces.first[live], np.full(len(live), block), size])
    out = _dealt(SORT, shards, 0, 0, block, entries, [pieces.text[f : f + k] for f, k in zip(pieces.first[live].tolist(), size.tolist())])

    # Windows of crowded minimizers, one by one.
    live = np.flatnonzero(state == CROWDED)
    if len(live):
        count = pieces.last[live] - pieces.first[live] + 1
        starts = np.repeat(pieces.first[live] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        window = np.stack([pieces.contents(starts, starts), pieces.contents(starts, starts, SECOND, SECOND_BACK)], axis=1)
        later = _earliest(distinct(window)[1], starts)
        marks.append(np.stack([starts[later], starts[later]]))
        keep = np.flatnonzero(~later)
        ids = pieces.ids_of(np.repeat(live, count)[keep])
        out += _dealt(NAME, shards, 0, 0, block, np.stack([ids, *window[keep].T.view(np.int64), starts[keep], np.full(len(keep), block)]), [])
    own = np.concatenate(marks, axis=1).astype(np.int32)
    return _batch(out + [(MARKS, 0, block, _zip(own), b"")] * bool(own.size))


def _places(ids: np.ndarray, block: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ranks in the order of id, block, start."""
    order = np.lexsort((starts, block, ids))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return rank


def _marks(block: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[tuple[int, bytes]]:
    order = np.argsort(block, kind="stable")
    return [(b, _zip(np.stack([first[order[x:y]], last[order[x:y]]]).astype(np.int32))) for b, x, y in _groups(block[order])]


def _told(marks: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table({"block": pa.array([m[0] for m in marks], pa.int64()), "marks": pa.array([m[1] for m in marks], pa.binary())})


def _copies(kind: int, entries: np.ndarray, texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Places of the entries, which of them are copies of an earlier one, and the windows of those: block, first, last."""
    if kind == NAME:
        ids, starts, blocks, more = entries[0], entries[3], entries[4], 0
        content = distinct(entries[1:3].T.view(np.uint64))[1]
    else:
        ids, starts, blocks, more = entries[0], entries[2], entries[3], entries[4] - length
        known: dict[bytes, int] = {}
        content = np.array([known.setdefault(t, len(known)) for t in texts], dtype=np.int64)
    place = _places(ids, blocks, starts)
    copy = _earliest(content, place)
    return place, copy, (blocks[copy], starts[copy], (starts + more)[copy])


def _resent(table: pa.Table, shards: Route, level: int, length: int) -> pa.Table:
    """What a fleet sends on to the shards of the next level: its copies are marked."""
    kind, under, sender = (table.column(c)[0].as_py() for c in ("kind", "key", "fleet"))
    entries, texts = _entries(table)
    _, copy, marked = _copies(kind, entries, texts, length)
    rows = [(MARKS, 0, block, data, b"") for block, data in _marks(*marked)]
    kept = [t for t, c in zip(texts, copy.tolist()) if not c]
    return pa.Table.from_batches([_batch(rows + _dealt(kind, shards, level, under, sender, np.ascontiguousarray(entries[:, ~copy]), kept))])


def _named(table: pa.Table, length: int) -> pa.Table:
    """Windows that are not the earliest of their name."""
    return _told(_marks(*_copies(NAME, *_entries(table), length)[2]))


def _sorted(table: pa.Table, length: int) -> pa.Table:
    """Windows of a shard's pieces that also start earlier."""
    entries, texts = _entries(table)
    # Equal pieces: the earliest stands for all, the others are marked whole.
    place, copy, marked = _copies(SORT, entries, texts, length)
    marked = [marked]
    _, names, starts, blocks, sizes = entries
    # A minimizer with one piece is told; the others' pieces are sorted.
    one = np.flatnonzero(~copy)
    _, where, times = np.unique(names[one], return_inverse=True, return_counts=True)
    one = one[times[where] > 1]
    if len(one):
        joined = np.frombuffer(b"".join(texts[k] + b"\0" for k in one.tolist()), dtype=np.uint8).astype(np.uint16) + 1
        end = np.cumsum(sizes[one] + 1)
        joined[end - 1] = 0
        begin = end - sizes[one] - 1
        owner = np.repeat(np.arange(len(one)), sizes[one] + 1)
        window = np.arange(len(joined)) + length <= (end - 1)[owner]
        rank = place[one][owner] * (int(sizes.max()) + 1) + np.arange(len(joined)) - begin[owner]
        for suffixes, common in sorted_buckets(joined, length):
            group = np.cumsum(common < length)
            keep = window[suffixes]
            suffixes, group = suffixes[keep], group[keep]
            later = suffixes[_earliest(group, rank[suffixes])]
            piece = one[owner[later]]
            at = starts[piece] + later - begin[owner[later]]
            marked.append((blocks[piece], at, at))
    return _told(_marks(*(np.concatenate(x) for x in zip(*marked))))


def drop_earlier_strings(
    docs: DataFrame, scratch: Scratch, length: int = LENGTH, crowd: int = CROWD, bucket_bytes: int = BUCKET_BYTES, shard_bytes: int = SHARD_BYTES, fan: int = FAN
) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (bytes).

    A byte of a text (UTF-8) goes if it lies in a string of ``length`` bytes that also starts earlier: in a document with a smaller
    ``doc_id``, or before in the same one.  Null and empty texts have no bytes.  Null ids come before all others.  Rows that
    share an id are told apart by the block they are in: one of them keeps the text.  An empty table gives an empty table.  Only ``doc_id`` and ``text`` are read.
    """
    if length < SEED + 8:
        raise ValueError(f"length must be {SEED + 8} or more")
    blocks = pack(docs, scratch, BLOCK_BYTES)
    path, shards = route(blocks, bucket_bytes, fan), route(blocks, shard_bytes, fan)

    def state(totals):
        return np.where(totals > crowd, CROWDED, np.where(totals > 1, SHARED, LONE))

    states = exchange(each_block(blocks, lambda row: _asked(row, path, length), REQUEST), path, path.width, state, scratch, "states")
    def resend(level):
        return lambda t: _resent(t, shards, level, length)

    work = scratch.write(each_block(blocks.join(states, "block"), lambda row: _spread(row, path, shards, length), WORK), "work-0")
    scratch.drop(*(f"states-{level}" for level in range(len(path.fleets))), *(f"states-told-{level}" for level in range(len(path.fans))))
    own = [work.where(f"kind = {MARKS}")]
    for level, fleets in enumerate(shards.fleets, 1):
        sent = work.where(f"kind <> {MARKS}").withColumn("fleet", F.col("key") * fleets + F.pmod(F.xxhash64("block", F.lit(level)), F.lit(fleets)))
        work = scratch.write(sent.groupBy("kind", "fleet").applyInArrow(resend(level), WORK), f"work-{level}")
        own.append(work.where(f"kind = {MARKS}"))
    marks = "block long, marks binary"
    told = (
        work.where(f"kind = {SORT}").groupBy("key").applyInArrow(lambda t: _sorted(t, length), marks)
        .unionByName(work.where(f"kind = {NAME}").groupBy("key").applyInArrow(lambda t: _named(t, length), marks))
    )
    for rows in own:
        told = told.unionByName(rows.selectExpr("block", "data as marks"))
    told = scratch.write(told.groupBy("block").agg(F.collect_list("marks").alias("marks")), "told")
    scratch.drop(*(f"work-{level}" for level in range(len(shards.fans))))

    def finish(row):
        ids, sizes, text = unpacked(row)
        edge = np.zeros(len(text) + 1, dtype=np.int32)
        for data in row["marks"] or []:
            first, last = np.frombuffer(_unzip(data), dtype=np.int32).reshape(2, -1)
            np.add.at(edge, first, 1)
            np.add.at(edge, last + length, -1)
        gone = np.cumsum(edge[:-1]) > 0
        data, removed, spans, kept, at = np.frombuffer(text, dtype=np.uint8), [], [], [], 0
        for size in sizes.tolist():
            mask = gone[at : at + size]
            removed.append(int(mask.sum()))
            spans.append(int((mask & ~np.append(False, mask[:-1])[:size]).sum()))
            kept.append(data[at : at + size][~mask].tobytes() if removed[-1] else text[at : at + size])
            at += size
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )

    return each_block(blocks.join(told, "block", "left"), finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    kept = drop_earlier_strings(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "suffixes"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, encode(coalesce(text, '')) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents
), s AS MATERIALIZED (
  SELECT r, pos, md5(array_slice(h, pos + 1, pos + 100)) AS k FROM (SELECT r, h, unnest(range(0, n - 99)) AS pos FROM d)
), hit AS MATERIALIZED (
  SELECT r, pos FROM (SELECT r, pos, row_number() OVER (PARTITION BY k ORDER BY r, pos) AS place FROM s) WHERE place > 1
), b AS MATERIALIZED (
  SELECT r, pos, hex(array_slice(h, pos + 1, pos + 1)) AS byte FROM (SELECT r, h, unnest(range(0, n)) AS pos FROM d)
), g AS MATERIALIZED (
  SELECT b.r, b.pos, b.byte,
         max(hit.pos) OVER (PARTITION BY b.r ORDER BY b.pos ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM b LEFT JOIN hit ON hit.r = b.r AND hit.pos = b.pos
), e AS MATERIALIZED (
  SELECT *, coalesce(lag(gone) OVER (PARTITION BY r ORDER BY pos), false) AS before FROM g
), k AS MATERIALIZED (
  SELECT r, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE gone AND NOT before) AS n_spans,
         string_agg(byte, '' ORDER BY pos) FILTER (WHERE NOT gone) AS kept
  FROM e GROUP BY r
)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(k.n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(k.kept, ''))) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""

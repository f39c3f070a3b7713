"""SimHash near-dedup with BK-trees.

Fingerprints within three bits of each other agree on at least two of five blocks of bits, so every pair of blocks is
a way of cutting the fingerprints into shards, and each close pair meets in a shard.  A shard's fingerprints form a BK-tree: children hang
at their Hamming distance from the parent, and a search follows only edges within the radius of its own distance.
A large shard becomes several trees of bounded size.  The trees grow with the data in number, so they are not broadcast to
every executor: each is sent, by a join on the shard, to the blocks of fingerprints that may match it.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.shipping import by_value
from basketlens.llm.components import connected_components
from basketlens.session import Scratch

by_value(__name__)

RADIUS = 3
BLOCKS = (13, 13, 13, 13, 12)  # bits; any two blocks that agree make a shard
TREE = 4096  # fingerprints in one tree


def fingerprint(text: bytes | None, width: int = 3, seed: int = 42) -> int:
    """Bits set in over half of the hashes of the text's ``width``-word shingles; 0 without words."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and exactly the blanks 0x20 and 0x09-0x0D
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[k:] for k in range(width)))) if len(words) >= width else [b" ".join(words)]
    hashes = np.array([xxhash.xxh64_intdigest(s, seed) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``print`` (signed 64 bits)."""

    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "print"])

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, print long")


def grow_tree(values: np.ndarray) -> list[dict[int, int]]:
    """Children of each value: {distance: index}.  The first value of every subtree is its root."""
    children: list[dict[int, int]] = [{} for _ in values]
    todo = [(0, np.arange(1, len(values)))]
    while todo:
        root, rest = todo.pop()
        far = np.bitwise_count(values[rest] ^ values[root])
        for d in np.unique(far):
            below = rest[far == d]
            children[root][int(d)] = int(below[0])
            if len(below) > 1:
                todo.append((int(below[0]), below[1:]))
    return children


def search_tree(values: np.ndarray, children: list[dict[int, int]], queries: np.ndarray, radius: int = RADIUS) -> list[tuple[np.ndarray, int]]:
    """(queries within the radius, index of the value): all queries walk the tree together."""
    found, todo = [], [(0, np.arange(len(queries)))]
    while todo:
        node, here = todo.pop()
        far = np.bitwise_count(queries[here] ^ values[node]).astype(np.int64)
        if len(near := here[far <= radius]):
            found.append((near, node))
        for d, child in children[node].items():
            on = here[np.abs(far - d) <= radius]
            if len(on):
                todo.append((child, on))
    return found


def _spanning(tree_prints, tree_ids, block_prints, block_ids) -> tuple[list[int], list[int]]:
    """Links that join what is connected between a tree and a block: at most one per fingerprint, whatever the number of close pairs."""
    values = np.asarray(tree_prints, dtype="<i8").view("<u8")
    found = search_tree(values, grow_tree(values), np.asarray(block_prints, dtype="<i8").view("<u8"))
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    for near, node in found:
        for q in near:
            a, b = root(int(tree_ids[node])), root(int(block_ids[q]))
            if a != b:
                up[max(a, b)] = min(a, b)
    return list(up), [root(x) for x in up]


def near_links(prints: DataFrame, scratch: Scratch, tree: int = TREE) -> DataFrame:
    """``a``, ``b``: links between the ``id`` of close ``print`` values; enough to connect all that are connected.

    ``prints`` has distinct, non-null ``print`` and ``id``.
    """
    edges = np.cumsum((0, *BLOCKS))
    spans = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edges, edges[1:])]
    masks = [s | t for s, t in combinations(spans, 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = prints.select(
        "id", "print", F.posexplode(F.array(*[F.col("print").bitwiseAND(F.lit(m)) for m in signed])).alias("way", "key")
    )
    sizes = scratch.write(
        keys.groupBy("way", "key").count().where("count > 1").selectExpr("way", "key", f"cast(ceil(count / {tree}) as int) as parts"), "shards"
    )
    blocks = scratch.write(
        keys.join(sizes, ["way", "key"])
        .withColumn("part", F.pmod(F.xxhash64("print"), "parts"))
        .groupBy("way", "key", "part").agg(F.collect_list("print").alias("prints"), F.collect_list("id").alias("ids")),
        "blocks",
    )
    tasks = blocks.alias("t").join(blocks.alias("q"), F.expr("t.way = q.way and t.key = q.key and t.part <= q.part")).selectExpr(
        "t.prints as tree_prints", "t.ids as tree_ids", "q.prints as block_prints", "q.ids as block_ids")

    def run(batches):
        for batch in batches:
            a, b = [], []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                x, y = _spanning(*row)
                a += x
                b += y
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return tasks.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per input row: ``doc_id``, ``print``, ``component_id`` (smallest ``doc_id`` reachable over links of 3 bits or fewer).

    Null, empty and blank texts have fingerprint 0 and link like any other.  Rows without ``doc_id`` link too: they may join others
    into one component and have its number, null if no row of it has one.  Equal texts and repeated rows share a
    fingerprint and so a component.  Only ``doc_id`` and ``text`` are read.  An empty table gives an empty table.
    """
    prints = scratch.write(fingerprints(docs), "prints")
    distinct = scratch.write(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct")
    # Classes are named by fingerprint, as not every one has a number.
    roots = connected_components(near_links(distinct.selectExpr("print as id", "print"), scratch), scratch)
    rooted = scratch.write(
        distinct.join(roots, F.col("print") == F.col("node"), "left").select("print", F.coalesce("root", "print").alias("root"), "least"), "rooted")
    first = scratch.write(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "first")
    labels = scratch.write(rooted.join(first, "root").select("print", "component_id"), "labels")
    return prints.join(labels, "print", "left").select("doc_id", "print", "component_id")


def op4_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "simhash"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")

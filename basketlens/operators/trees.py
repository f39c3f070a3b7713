"""Boosted trees and random forests over all rows of a table, as Spark's own models.

Features become bins once, written as blocks of a byte for each value.  Growth is by level: tasks count their rows by node and bin, the counts are added
up, and the best split of a node is taken from them.  Candidate splits come from all rows: every midpoint of a feature of few values, exact
quantiles of the others.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from functools import partial, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.shipping import by_value
from basketlens.operators.quantiles import exact_quantiles
from basketlens.session import Scratch, freed, scratch_path

by_value(__name__)

CHUNK = 1 << 16  # rows worked on at once
MOST_CELLS = 1024  # of the joint counts of some features
MOST_SHARD = 8_000_000  # rows of a task that boosts
SAVED_TREES = 25
MOST_HELD = 64 << 20  # bytes of a forest's counts in a task


class Blocks(NamedTuple):
    """Binned rows: ``n`` rows a block, their bins by feature, labels and hashes.  A value's bin is the number of its feature's ``edges`` below it."""

    table: DataFrame
    edges: list
    rows: int

    @property
    def widths(self) -> list[int]:
        return [len(e) + 1 for e in self.edges]


def _few_values(rows: DataFrame, features: list[str], most: int) -> dict[str, list[float]]:
    """The distinct values of the features that have at most ``most`` of them."""
    def run(batches):
        seen = [np.zeros(0) for _ in features]
        for batch in batches:
            for k, values in enumerate(seen):
                if values is not None:
                    # A zero has no sign here.
                    values = np.union1d(values, batch.column(k).to_numpy(zero_copy_only=False) + 0.0)
                    seen[k] = values if len(values) <= most else None
        yield pa.RecordBatch.from_pydict(
            {"k": list(range(len(features))), "seen": seen}, pa.schema([("k", pa.int32()), ("seen", pa.list_(pa.float64()))]))

    found = rows.select(*[F.col(c).cast("double") for c in features]).mapInArrow(run, "k int, seen array<double>")
    # Of each task, no more than the bound; a feature that any task has more of is not among them.
    whole = found.groupBy("k").agg(F.bool_and(F.col("seen").isNotNull()).alias("few"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("seen"))
    return {features[r["k"]]: list(r["seen"]) for r in whole.where(f"few and size(seen) <= {most}").collect()}


def candidate_splits(rows: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Ascending split values of each feature, fewer than ``bins``, from all rows."""
    few = _few_values(rows, features, bins)
    many = [c for c in features if c not in few]
    edges = {c: [(a + b) / 2 for a, b in zip(v, v[1:])] for c, v in few.items()}
    if many:
        edges |= {q.variable: sorted(set(q.values)) for q in exact_quantiles(rows, many, [i / bins for i in range(1, bins)])}
    return [edges[c] for c in features]


def binned(rows: DataFrame, features: list[str], label: str, key: str, bins: int, scratch: Scratch) -> Blocks:
    """All rows in blocks, written once."""
    edges = [np.array(e) for e in candidate_splits(rows, features, bins)]

    def run(batches):
        for batch in batches:
            x = [np.searchsorted(e, batch.column(k).to_numpy(zero_copy_only=False)).astype(np.uint8) for k, e in enumerate(edges)]
            y, h = (batch.column(len(edges) + k).to_numpy(zero_copy_only=False) for k in (0, 1))
            yield pa.RecordBatch.from_pydict({
                "n": pa.array([len(batch)], pa.int32()), "x": pa.array([b"".join(c.tobytes() for c in x)], pa.binary()),
                "y": pa.array([y.astype(np.uint8).tobytes()], pa.binary()), "h": pa.array([h.astype(np.int64).tobytes()], pa.binary())})

    # Choices follow a hash of the row itself, whatever block it comes to.
    wide = rows.select(*[F.col(c).cast("double") for c in features], F.col(label).cast("int").alias("y"), F.xxhash64(key, *features).alias("h"))
    table = scratch.write(wide.mapInArrow(run, "n int, x binary, y binary, h binary").where("n > 0"), "blocks")
    return Blocks(table, [e.tolist() for e in edges], table.agg(F.sum("n")).first()[0] or 0)


def _joined(rows, width: int):
    """(bins by feature, labels, hashes) of about ``CHUNK`` rows each, from blocks."""
    held, n = [], 0
    for size, *buffers in rows:
        x, y, h = (np.frombuffer(b, t) for b, t in zip(buffers, (np.uint8, np.uint8, np.uint64)))
        held.append((x.reshape(width, size), y, h))
        n += size
        if n >= CHUNK:
            yield tuple(np.concatenate(parts, axis=-1) for parts in zip(*held))
            held, n = [], 0
    if held:
        yield tuple(np.concatenate(parts, axis=-1) for parts in zip(*held))


def _chunks(batches, width: int):
    return _joined((row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("n", "x", "y", "h")))), width)


def _best(n: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per node the best split by variance: its place (feature, bin) in the flat counts, gain, and count and sum on its left.

    ``n`` and ``s`` are counts and label sums by node, feature and bin.  Equal gains go to the first feature and its first split.  The gain is
    not above zero where no split helps.
    """
    left, low = n.cumsum(axis=2), s.cumsum(axis=2)
    count, total = left[:, :, -1:], low[:, :, -1:]
    right, high = count - left, total - low
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (low * low / left + high * high / right - total * total / count) / count
    gain = np.where((left > 0) & (right > 0), gain, -np.inf).reshape(len(n), -1)
    at = gain.argmax(axis=1)
    nodes = np.arange(len(n))
    return at, gain[nodes, at], left.reshape(len(n), -1)[nodes, at], low.reshape(len(n), -1)[nodes, at]


class _Tree:
    """A tree while it grows: by node feature (-1 for a leaf), bin, left child (the right one is next), count and label sum."""

    def __init__(self) -> None:
        self.feature, self.bin, self.left, self.n, self.s = [-1], [0], [0], [0.0], [0.0]

    def split(self, node: int, feature: int, last: int, left: tuple[float, float]) -> int:
        at = len(self.feature)
        self.feature[node], self.bin[node], self.left[node] = feature, last, at
        for n, s in (left, (self.n[node] - left[0], self.s[node] - left[1])):
            for values, value in ((self.feature, -1), (self.bin, 0), (self.left, 0), (self.n, n), (self.s, s)):
                values.append(value)
        return at


NODES = pa.schema([("tree", pa.int32()), ("id", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()), ("left", pa.int32()),
                   ("n", pa.float64()), ("s", pa.float64()), ("q", pa.float64()), ("gain", pa.float64())])


# Boosting: shards of rows with their margins stay in memory; a job counts for a level of a tree.


class _Layout:
    """Features in groups whose bins make at most ``MOST_CELLS`` joint cells, so that one count over the rows serves a group."""

    def __init__(self, widths: list[int]) -> None:
        self.widths, self.most = widths, max(widths)
        self.groups: list[list[int]] = []
        for f in sorted(range(len(widths)), key=lambda f: -widths[f]):
            room = (g for g in self.groups if math.prod(widths[i] for i in g) * widths[f] <= MOST_CELLS)
            group = next(room, None)
            if group is None:
                self.groups.append([f])
            else:
                group.append(f)
        self.dims = [[widths[f] for f in group] for group in self.groups]
        self.valid = np.arange(self.most) < np.array(widths)[:, None]

    def joint(self, x: np.ndarray) -> np.ndarray:
        codes = np.zeros((len(self.groups), x.shape[1]), np.uint16)
        for g, group in enumerate(self.groups):
            for f in group:
                codes[g] = codes[g] * self.widths[f] + x[f]
        return codes

    def steps(self, tree: _Tree) -> tuple[np.ndarray, np.ndarray]:
        """By node the group of its split, and by node and joint bin of that group the next node; a leaf leads to itself."""
        count = len(tree.feature)
        step = np.repeat(np.arange(count, dtype=np.uint16)[:, None], MOST_CELLS, axis=1)
        group = np.zeros(count, np.intp)
        places = {f: (g, k) for g, fs in enumerate(self.groups) for k, f in enumerate(fs)}
        for node, f in enumerate(tree.feature):
            if f >= 0:
                g, k = places[f]
                dims = self.dims[g]
                bins = np.arange(math.prod(dims)) // math.prod(dims[k + 1 :]) % dims[k]
                step[node, : len(bins)] = tree.left[node] + (bins > tree.bin[node])
                group[node] = g
        return group, step.ravel()

    def split_up(self, joint: list[np.ndarray], size: int) -> np.ndarray:
        """Counts by slot and by feature and bin, one after the other, from those of the groups."""
        table = np.zeros((size, len(self.widths), self.most))
        for counted, dims, group in zip(joint, self.dims, self.groups):
            cube = counted.reshape(size, *dims)
            for k, f in enumerate(group):
                table[:, f, : dims[k]] = cube.sum(axis=tuple(i for i in range(1, len(dims) + 1) if i != k + 1))
        return table[:, self.valid]


def _reached(codes: np.ndarray, steps: tuple[np.ndarray, np.ndarray], level: int) -> np.ndarray:
    """The node of every row at a level."""
    group, step = steps
    count, flat = codes.shape[1], codes.ravel()
    nodes, at, places = np.zeros(count, np.intp), np.arange(count), group * count
    for _ in range(level):
        nodes = step.take(nodes * MOST_CELLS + flat.take(places.take(nodes) + at)).astype(np.intp)
    return nodes


def _targets(labels: np.ndarray, margins: np.ndarray | None) -> np.ndarray:
    """What a tree is fitted on: the labels (-1 and 1) at first, then the residuals of the logistic loss."""
    return labels if margins is None else 4.0 * labels / (1.0 + np.exp(2.0 * labels * margins))


def _shards(rows, widths: list[int]):
    """Chunks of joint bins, labels, margins and sums of squares by node of the last tree."""
    layout = _Layout(widths)
    for x, y, _ in _joined(rows, len(widths)):
        yield layout.joint(x), y, None, None


def _counted(shards, widths: list[int], tree: _Tree, level: int, slots: np.ndarray | None, size: int):
    """Rows and target sums by slot, feature and bin; ``slots`` are those of the nodes, -1 for none, and nothing for the root."""
    layout = _Layout(widths)
    steps = layout.steps(tree)
    sums, rows = ([np.zeros(size * math.prod(d)) for d in layout.dims] for _ in range(2))
    squares = np.zeros(0)
    for codes, y, margins, of_last in shards:
        targets = _targets(y * 2.0 - 1.0, margins)
        if of_last is not None:
            squares = of_last + (squares if len(squares) else 0.0)
        if slots is not None:
            slot = slots.take(_reached(codes, steps, level))
            chosen = np.flatnonzero(slot >= 0)
            slot, targets = slot.take(chosen), targets.take(chosen)
        for g, dims in enumerate(layout.dims):
            cells = math.prod(dims)
            at = codes[g].astype(np.intp) if slots is None else codes[g].take(chosen) + slot * cells
            sums[g] += np.bincount(at, targets, size * cells)
            rows[g] += np.bincount(at, minlength=size * cells)
    yield layout.split_up(rows, size), layout.split_up(sums, size), squares


def _moved(shards, widths: list[int], tree: _Tree, depth: int, weight: float):
    """The shards with their margins after the tree."""
    values = np.array([weight * s / n if n else 0.0 for n, s in zip(tree.n, tree.s)])
    steps = _Layout(widths).steps(tree)
    for codes, y, margins, _ in shards:
        nodes = _reached(codes, steps, depth)
        squares = np.bincount(nodes, _targets(y * 2.0 - 1.0, margins) ** 2, len(values))
        yield codes, y, values.take(nodes) + (0.0 if margins is None else margins), squares


def _together(a: tuple, b: tuple) -> tuple:
    return tuple(x + y if len(x) and len(y) else x if len(x) else y for x, y in zip(a, b))


def _total(state, **args) -> tuple:
    """The counts of all shards."""
    parts = state.mapPartitions(partial(_counted, **args))
    if state.getNumPartitions() > 64:
        return parts.treeReduce(_together)
    return reduce(_together, parts.collect())


def _grown(layout: _Layout, count, depth: int) -> tuple[_Tree, np.ndarray]:
    """One regression tree; ``count`` gives counts for a level.  Of two siblings the smaller is counted, the other is what its parent has besides.

    Also the sums of squared targets of the tree before.
    """
    tree, shape = _Tree(), (len(layout.widths), layout.most)
    rows, sums = np.zeros((1, *shape)), np.zeros((1, *shape))
    rows[:, layout.valid], sums[:, layout.valid], squares = count(tree, 0, None, 1)
    tree.n[0], tree.s[0] = rows[0, 0].sum(), sums[0, 0].sum()
    open_nodes = [0]
    for level in range(depth):
        at, gain, left, low = _best(rows, sums)
        # Sums are rounded: what is left of a gain of nothing is no gain.
        means = sums[:, 0].sum(axis=1) / np.maximum(1, rows[:, 0].sum(axis=1))
        split = [k for k in range(len(open_nodes)) if gain[k] > 1e-13 * means[k] ** 2]
        for k in split:
            tree.split(open_nodes[k], int(at[k]) // layout.most, int(at[k]) % layout.most, (left[k], low[k]))
        if not split or level == depth - 1:
            break
        slots, small = np.full(len(tree.feature), -1, np.intp), []
        for i, k in enumerate(split):
            first = tree.left[open_nodes[k]]
            small.append(int(tree.n[first] > tree.n[first + 1]))
            slots[first + small[-1]] = i
        *counted, _ = count(tree, level + 1, slots, len(split))
        new = []
        for whole, part in zip((rows, sums), counted):
            table = np.zeros((2 * len(split), *shape))
            for i, k in enumerate(split):
                table[2 * i + small[i]][layout.valid] = part[i]
                table[2 * i + 1 - small[i]][layout.valid] = whole[k][layout.valid] - part[i]
            new.append(table)
        open_nodes = [tree.left[open_nodes[k]] + side for k in split for side in (0, 1)]
        # A node of one row stays a leaf.
        kept = [i for i, node in enumerate(open_nodes) if tree.n[node] > 1]
        rows, sums, open_nodes = new[0][kept], new[1][kept], [open_nodes[i] for i in kept]
        if not open_nodes:
            break
    return tree, squares


def boosted(estimator, blocks: Blocks) -> GBTClassificationModel:
    """The model of a boosted classifier (logistic loss, variance, all features, no subsampling) over all rows.

    Every few trees the shards are written, which ends their lineage: a lost executor costs the trees since.
    """
    spark, widths, depth, rate = blocks.table.sparkSession, blocks.widths, estimator.getMaxDepth(), estimator.getStepSize()
    layout, scratch = _Layout(widths), Scratch(spark, "boosting")
    tasks = max(1, min(spark.sparkContext.defaultParallelism, blocks.rows // 5000))
    tasks = max(tasks, math.ceil(blocks.rows / MOST_SHARD))
    rows = blocks.table.select("n", "x", "y", "h").repartition(tasks).rdd
    state = rows.mapPartitions(partial(_shards, widths=widths)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    before, saved, trees, squares = None, None, [], []
    for at in range(estimator.getMaxIter()):
        def count(tree, level, slots, size):
            return _total(state, widths=widths, tree=tree, level=level, slots=slots, size=size)

        tree, of_last = _grown(layout, count, depth)
        if before is not None:
            before.unpersist()
        trees.append(tree)
        squares.append(of_last)
        before = state
        state = state.mapPartitions(partial(_moved, widths=widths, tree=tree, depth=depth, weight=rate if at else 1.0))
        if at % SAVED_TREES == SAVED_TREES - 1:
            state.saveAsPickleFile(f"{scratch.root}/{at}", 1)
            before.unpersist()
            if saved is not None:
                scratch.drop(saved)
            before, saved = None, str(at)
            # At least one task: files are read whole, not dealt to more tasks than wrote them.
            state = spark.sparkContext.pickleFile(f"{scratch.root}/{at}", 1)
        state = state.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    squares.append(state.map(lambda shard: shard[3]).treeReduce(lambda a, b: a + b))
    for held in (before, state):
        if held is not None:
            held.unpersist()
    scratch.drop()
    columns = {name: [] for name in NODES.names}
    for at, (tree, q) in enumerate(zip(trees, squares[1:])):
        q, gain = q.copy(), np.zeros(len(q))
        for node in range(len(q) - 1, -1, -1):
            if tree.feature[node] >= 0:
                children = (tree.left[node], tree.left[node] + 1)
                q[node] = sum(q[c] for c in children)
                gain[node] = (sum(tree.s[c] ** 2 / tree.n[c] for c in children) - tree.s[node] ** 2 / tree.n[node]) / tree.n[node]
        for name, values in zip(NODES.names, ([at] * len(q), range(len(q)), tree.feature, tree.bin, tree.left, tree.n, tree.s, q, gain)):
            columns[name].extend(values)
    nodes = pa.table([pa.array(columns[f.name], f.type) for f in NODES], schema=NODES)
    n, s, q = (nodes[c].to_numpy() for c in ("n", "s", "q"))
    prediction, squared = (np.divide(v, n, out=np.zeros_like(s), where=n > 0) for v in (s, q))
    weights = [rate if at else 1.0 for at in range(len(trees))]
    return _written(
        spark, estimator, blocks, nodes, prediction, squared - prediction**2, np.stack([n, s, q], axis=1), weights,
        GBTClassificationModel, "regression.DecisionTreeRegressionModel", {})


# A forest: trees grow side by side, a pass over the blocks for each level.

POISSON = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)
ONES = float(1 << 26)  # counts of rows below, of rows of label 1 above
MOST_ROWS = 1 << 22  # counted together that way; a row counts a dozen times at most


def _drawn(h: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is in the tree's sample: Poisson with mean 1, by the hash of the row."""
    salt = np.random.default_rng([seed, tree]).integers(1, 1 << 63, 2, dtype=np.uint64)
    u = (h ^ salt[0]) * np.uint64(0x9E3779B97F4A7C15)
    u ^= u >> np.uint64(29)
    u *= salt[1] | np.uint64(1)
    u ^= u >> np.uint64(32)
    u *= np.uint64(0xD6E8FEB86659FD93)
    return POISSON.take(u >> np.uint64(48))


def _count_forest(batches, width: int, most: int, seed: int, level: int, sent):
    """Per tree, rows and rows of label 1 by open node, chosen feature and bin."""
    trees = sent.value
    held = {t: np.zeros((2, len(chosen) * chosen.shape[1] * most)) for t, _, _, _, _, chosen in trees}
    packed = {t: np.zeros(v.shape[1]) for t, v in held.items()}
    rows = 0

    def unpack():
        for t, v in packed.items():
            ones = np.floor(v / ONES)
            held[t][0] += v - ones * ONES
            held[t][1] += ones
            v[:] = 0

    for x, y, h in _chunks(batches, width):
        if rows + len(y) > MOST_ROWS:
            unpack()
            rows = 0
        rows += len(y)
        flat = np.ascontiguousarray(x.T).ravel()
        worth = np.where(y > 0, 1.0 + ONES, 1.0)
        for t, feature, last, left, slot, chosen in trees:
            times = _drawn(h, seed, t)
            at = np.flatnonzero(times)
            row = at * width
            weight = worth.take(at) * times.take(at)
            node = np.zeros(len(at), np.intp)
            for _ in range(level):
                node = left.take(node) + (flat.take(row + feature.take(node)) > last.take(node))
            node = slot.take(node)
            if level:
                inside = np.flatnonzero(node >= 0)
                node, row, weight = node.take(inside), row.take(inside), weight.take(inside)
            tries = chosen.shape[1]
            for j in range(tries):
                code = flat.take(row + chosen[:, j].take(node))
                packed[t] += np.bincount((node * tries + j) * most + code, weight, len(packed[t]))
    unpack()
    for t, v in held.items():
        yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "counts": pa.array([v.tobytes()], pa.binary())})


def _split_forest(table: pa.Table, tries: int, most: int) -> pa.Table:
    """The best splits of a tree's open nodes, from the counts of all tasks."""
    n, s = sum(np.frombuffer(b) for b in table["counts"].to_pylist()).reshape(2, -1, tries, most)
    at, gain, left, low = _best(n, s)
    found = np.stack([n[:, 0].sum(axis=1), s[:, 0].sum(axis=1), at, gain, left, low])
    return pa.table({"tree": table["tree"][:1], "found": pa.array([found.tobytes()], pa.binary())})


def forest(estimator, blocks: Blocks) -> RandomForestClassificationModel:
    """The model of a random forest (Gini, as many features a node as the root of all) over all rows; a tree's sample is as large as the table."""
    spark, widths = blocks.table.sparkSession, blocks.widths
    width, most, seed = len(widths), max(widths), estimator.getSeed()
    tries = math.ceil(math.sqrt(width)) if estimator.getNumTrees() > 1 else width
    trees = [_Tree() for _ in range(estimator.getNumTrees())]
    opened = {t: [0] for t in range(len(trees))}
    for level in range(estimator.getMaxDepth()):
        waiting = [t for t in opened if opened[t]]
        while waiting:
            batch, size = [], 0
            while waiting and (not batch or size + len(opened[waiting[0]]) <= MOST_HELD // (24 * tries * most)):
                size += len(opened[waiting[0]])
                batch.append(waiting.pop(0))
            parts, picks = [], {}
            for t in batch:
                tree, nodes = trees[t], opened[t]
                random = np.random.default_rng([seed, t, level]).random((len(nodes), width))
                picks[t] = np.sort(random.argsort(axis=1)[:, :tries], axis=1)
                feature = np.array(tree.feature, np.intp)
                leaf = feature < 0
                # A row in a leaf stays there: no bin is above.
                last, left = np.where(leaf, 255, tree.bin), np.where(leaf, np.arange(len(leaf)), tree.left)
                slot = np.full(len(leaf), -1, np.intp)
                slot[nodes] = np.arange(len(nodes))
                parts.append((t, np.where(leaf, 0, feature), last.astype(np.uint8), left.astype(np.intp), slot, picks[t]))
            sent = spark.sparkContext.broadcast(parts)
            counted = blocks.table.mapInArrow(partial(_count_forest, width=width, most=most, seed=seed, level=level, sent=sent), "tree int, counts binary")
            best = counted.groupBy("tree").applyInArrow(lambda table: _split_forest(table, tries, most), "tree int, found binary")
            with freed(spark):
                found = {r["tree"]: np.frombuffer(r["found"]).reshape(6, -1) for r in best.collect()}
            sent.destroy()
            for t in batch:
                tree, fresh = trees[t], []
                for k, (n, s, at, gain, left, low) in enumerate(found[t].T.tolist() if t in found else []):
                    node = opened[t][k]
                    tree.n[node], tree.s[node] = n, s
                    # Twice the variance of labels 0 and 1 is their Gini impurity: a pure node has no gain.
                    if gain > 1e-14 and 0 < s < n:
                        first = tree.split(node, int(picks[t][k][int(at) // most]), int(at) % most, (left, low))
                        fresh += [c for c in (first, first + 1) if 0 < tree.s[c] < tree.n[c]]
                opened[t] = fresh
    columns = {name: [] for name in NODES.names}
    for t, tree in enumerate(trees):
        _prune(tree)
        size = len(tree.feature)
        gain = [0.0] * size
        for node in range(size):
            if tree.feature[node] >= 0:
                gini = [2 * tree.s[c] * (1 - tree.s[c] / tree.n[c]) for c in (node, tree.left[node], tree.left[node] + 1)]
                gain[node] = (gini[0] - gini[1] - gini[2]) / tree.n[node]
        for name, values in zip(NODES.names, ([t] * size, range(size), tree.feature, tree.bin, tree.left, tree.n, tree.s, tree.s, gain)):
            columns[name].extend(values)
    nodes = pa.table([pa.array(columns[f.name], f.type) for f in NODES], schema=NODES)
    n, s = nodes["n"].to_numpy(), nodes["s"].to_numpy()
    p = np.divide(s, n, out=np.zeros_like(s), where=n > 0)
    return _written(
        spark, estimator, blocks, nodes, (2 * s > n).astype(float), 2 * p * (1 - p), np.stack([n - s, s], axis=1), [1.0] * len(trees),
        RandomForestClassificationModel, "classification.DecisionTreeClassificationModel", {"numClasses": 2})


def _prune(tree: _Tree) -> None:
    """Two leaves that call the same class become one, as in Spark's own trees; nodes are numbered anew."""
    called = [2 * s > n for n, s in zip(tree.n, tree.s)]
    for node in range(len(called) - 1, -1, -1):
        left = tree.left[node]
        if tree.feature[node] >= 0 and tree.feature[left] < 0 and tree.feature[left + 1] < 0 and called[left] == called[left + 1]:
            tree.feature[node] = -1
    kept, at = [0], 0
    while at < len(kept):
        if tree.feature[kept[at]] >= 0:
            kept += [tree.left[kept[at]], tree.left[kept[at]] + 1]
        at += 1
    number = {node: k for k, node in enumerate(kept)}
    tree.left = [number[tree.left[node]] if tree.feature[node] >= 0 else 0 for node in kept]
    tree.feature, tree.bin, tree.n, tree.s = ([values[node] for node in kept] for values in (tree.feature, tree.bin, tree.n, tree.s))


def _written(spark, estimator, blocks: Blocks, nodes: pa.Table, prediction, impurity, stats, weights: list[float], kind, member: str, extra: dict):
    """The trees written in the form of a saved model, and read as one."""
    def about(name: str, uid: str, params: dict, defaults: dict, **more) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.{name}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid,
                           "paramMap": params, "defaultParamMap": defaults} | more)

    path = scratch_path(spark, "model")
    params, defaults = ({p.name: v for p, v in of.items()} for of in (estimator._paramMap, estimator._defaultParamMap))
    width = len(blocks.edges)
    top = about(f"classification.{kind.__name__}", estimator.uid, params, defaults, numFeatures=width, numTrees=len(weights), **extra)
    spark.createDataFrame([(top,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    trees = [(at, about(member, f"tree_{uuid.uuid4().hex[:12]}", {}, {}), w) for at, w in enumerate(weights)]
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    feature, last, left = (nodes[c].to_numpy() for c in ("feature", "bin", "left"))
    inner = feature >= 0
    values = [[blocks.edges[f][b]] if f >= 0 else [] for f, b in zip(feature.tolist(), last.tolist())]
    table = pa.table({
        "tree": nodes["tree"], "id": nodes["id"], "prediction": prediction, "impurity": impurity, "stats": pa.array(list(stats), pa.list_(pa.float64())),
        "count": nodes["n"].to_numpy().astype(np.int64), "gain": np.where(inner, nodes["gain"].to_numpy(), -1.0),
        "left": np.where(inner, left, -1).astype(np.int32), "right": np.where(inner, left + 1, -1).astype(np.int32),
        "feature": np.where(inner, feature, -1).astype(np.int32), "value": pa.array(values, pa.list_(pa.float64()))})
    spark.createDataFrame(table).selectExpr(
        "tree as treeID",
        "named_struct('id', id, 'prediction', prediction, 'impurity', impurity, 'impurityStats', stats, 'rawCount', count, 'gain', gain, 'leftChild', left,"
        " 'rightChild', right, 'split', named_struct('featureIndex', feature, 'leftCategoriesOrThreshold', value, 'numCategories', -1)) as nodeData",
    ).coalesce(1).write.parquet(f"{path}/data")
    return kind.load(path)

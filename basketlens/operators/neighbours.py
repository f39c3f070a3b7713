"""Exact nearest neighbours as a join of boxes.

Rows with the same features collapse to one point.  Median splits of a sample, always along the feature that varies most, deal the points
into cells; a cell's box is the least one that holds its points.  A point first finds neighbours in its own cell, which bounds the distance
of the ones it looks for.  Only cells whose box comes within that bound can hold nearer ones: the point visits them in a second pass, to
which a cell is sent once for every ``VISITS`` visitors.  A task holds a cell and its visitors; inside, boxes of a few hundred points tell
in the same way which are compared.  No row is compared on the driver, and nothing is capped.

What is found travels as names and numbers of points, and so do the rows that look for it; features are joined by the number where they are needed.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.hashing import key_hash
from basketlens.functions.shipping import by_value
from basketlens.session import Scratch

by_value(__name__)

CELL_ROWS = 16_000  # points in a cell, on average
MOST_PIVOTS = 20_000  # points of the sample that is split, and cells: three megabytes with 19 features
SAMPLED = 32  # points of the sample for a cell
VISITS = 64_000  # visitors of a cell in one task, about
BLOCK = 256  # points compared at once, and points of a box inside a cell
NEAR = 8  # boxes that a first bound is taken from
SLACK = 1e-9  # relative; rounding must not leave out a cell or a neighbour

POINT = "point bigint, id string, x array<double>, ids array<string>"
FOUND = "found array<struct<distance: double, id: string, point: bigint>>"


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, by products: right but for rounding."""
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * a @ b.T


def rounding(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """More than ``squares`` can be wrong by, for each row of ``a``."""
    return 1e-12 * ((a * a).sum(axis=1) + (b * b).sum(axis=1).max(initial=0.0)) + 1e-300


def nearest(points: np.ndarray, others: np.ndarray, names: np.ndarray, most: int, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices of points and of their ``most`` nearest others, and squared distances; equal ones by name, none beyond ``limit``.

    Products tell which can be among them; the distances of those are taken exactly.
    """
    rough, error, reach = squares(points, others), rounding(points, others), limit
    if len(others) > most and not np.isfinite(limit).all():
        reach = np.minimum(limit, np.partition(rough, most - 1, axis=1)[:, most - 1])
    which, other = np.nonzero(rough <= (reach * (1 + SLACK) + 2 * error)[:, None])
    exact = np.empty(len(which))
    for part in range(0, len(which), 1 << 18):
        s = slice(part, part + (1 << 18))
        exact[s] = ((points[which[s]] - others[other[s]]) ** 2).sum(axis=1)
    order = np.lexsort((names[other], exact, which))
    which, other, exact = which[order], other[order], exact[order]
    first = np.arange(len(which)) - np.searchsorted(which, which) < most
    return which[first], other[first], exact[first]


def split_points(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Indices of the points in parts of at most ``most``, by halves along the feature with the widest range."""
    parts, out = [np.arange(len(x))], []
    while parts:
        part = parts.pop()
        if len(part) <= most:
            out.append(part)
            continue
        held = x[part]
        half = len(part) // 2
        order = np.argpartition(held[:, np.ptp(held, axis=0).argmax()], half)
        parts += [part[order[half:]], part[order[:half]]]
    return out


def outside(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point from every box, 0 inside."""
    total = np.zeros((len(points), len(low)))
    for i in range(points.shape[1]):
        p = points[:, i, None]
        gap = np.maximum(np.maximum(low[None, :, i] - p, p - high[None, :, i]), 0.0)
        total += gap * gap
    return total


def search(points: np.ndarray, others: np.ndarray, names: np.ndarray, most: int, limit: np.ndarray):
    """``nearest`` for many points and others: only boxes of others that a point's bound reaches are compared with its block."""
    boxes = split_points(others, BLOCK)
    low, high = (np.array([f(others[b], axis=0) for b in boxes]) for f in (np.min, np.max))
    found = []
    for block in split_points(points, BLOCK):
        x, bound = points[block], limit[block].copy()
        apart = np.maximum(np.maximum(low - x.max(axis=0), x.min(axis=0) - high), 0.0)
        apart = (apart * apart).sum(axis=1)
        if not np.isfinite(bound).all():
            near = np.concatenate([boxes[b] for b in np.argsort(apart, kind="stable")[:NEAR]])
            which, _, exact = nearest(x, others[near], names[near], most, bound)
            last = np.flatnonzero(np.bincount(which, minlength=len(x)) == most)
            ends = np.searchsorted(which, last, side="right") - 1
            bound[last] = np.minimum(bound[last], exact[ends])
        reach = bound * (1 + SLACK)
        close = np.flatnonzero(apart <= reach.max())
        close = close[(outside(x, low[close], high[close]) <= reach[:, None]).any(axis=0)]
        if len(close):
            near = np.concatenate([boxes[b] for b in close])
            which, other, exact = nearest(x, others[near], names[near], most, bound)
            found.append((block[which], near[other], exact))
    which, other, exact = (np.concatenate(p) for p in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    # Rows of a point stay in order: a point is in one block.
    order = np.argsort(which, kind="stable")
    return which[order], other[order], exact[order]


FOUND_TYPE = pa.list_(pa.struct([("distance", pa.float64()), ("id", pa.string()), ("point", pa.int64())]))


def _candidates(n: int, hits: tuple[np.ndarray, np.ndarray, np.ndarray], numbers: np.ndarray, ids: pa.Array, most: int) -> tuple[pa.Array, np.ndarray]:
    """For ``n`` points the rows that stand at the points found, nearest first, ``most`` at most, and how far the last is, infinite if there are fewer."""
    which, other, exact = hits
    copies = np.diff(ids.offsets.to_numpy())[other]
    start = ids.offsets.to_numpy()[other]
    row = np.repeat(np.arange(len(which)), copies)
    at = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
    names = ids.values.take(pa.array(at, pa.int64()))
    # Names are in order within a point and among equal distances of single rows; where copies mix, they are put in order.
    which, other, exact = which[row], other[row], exact[row]
    if (copies > 1).any():
        order = np.lexsort((_ranks(names), exact, which))
        which, other, exact, names = which[order], other[order], exact[order], names.take(pa.array(order))
    first = np.arange(len(which)) - np.searchsorted(which, which) < most
    which, other, exact, names = which[first], other[first], exact[first], names.filter(pa.array(first))
    sizes = np.bincount(which, minlength=n)
    ends = np.cumsum(sizes)
    bound = np.full(n, np.inf)
    full = np.flatnonzero(sizes == most)
    bound[full] = exact[ends[full] - 1]
    held = pa.StructArray.from_arrays([pa.array(exact), names, pa.array(numbers[other], pa.int64())], names=["distance", "id", "point"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), held), bound


def _ranks(names: pa.Array) -> np.ndarray:
    """Numbers in the order of the names."""
    names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
    codes = names.dictionary_encode()
    order = np.argsort(np.array(codes.dictionary.to_pylist(), dtype=object), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[codes.indices.to_numpy()] if len(codes) else np.zeros(0, np.int64)


def collapsed(rows: DataFrame, key: str, features: list[str], most: int) -> DataFrame:
    """``point`` (a number), ``id`` (smallest key), ``x``, ``ids`` (the ``most`` smallest keys) of every distinct point.

    Numbers differ from run to run: they are for a result that is written once.
    """
    # Zero has two signs, and they would be two points.
    x = F.array(*[F.col(c).cast("double") + F.lit(0.0) for c in features])
    named = rows.select(F.col(key).cast("string").alias("id"), x.alias("x"))
    # Ranks up to a limit are cut in every map task before the exchange, so a point that most rows share stays small.
    first = named.withColumn("rank", F.row_number().over(Window.partitionBy("x").orderBy("id"))).where(F.col("rank") <= most)
    return first.groupBy("x").agg(F.array_sort(F.collect_list("id")).alias("ids")).selectExpr("monotonically_increasing_id() as point", "ids[0] as id", "x", "ids")


class Splits(NamedTuple):
    """A tree of splits: a node sends what is at most ``value`` in ``feature`` to ``below``, else to the node after that; a cell where ``feature`` is -1."""

    feature: np.ndarray
    value: np.ndarray
    below: np.ndarray
    cell: np.ndarray


def fit_splits(sample: np.ndarray, cells: int) -> Splits:
    """About ``cells`` cells with equal shares of the sample: the largest is split at the median of the feature that varies most."""
    import heapq

    feature, value, below = [-1], [0.0], [0]
    open_parts = [(-len(sample), 0, sample)]
    leaves = 1
    while open_parts and leaves < cells:
        _, node, part = heapq.heappop(open_parts)
        for i in np.argsort(-part.var(axis=0), kind="stable") if len(part) > 1 else []:
            column = np.sort(part[:, i])
            # The border nearest to the median between different values.
            steps = np.flatnonzero(column[1:] > column[:-1])
            if len(steps):
                cut = column[steps[np.abs(steps + 1 - len(column) / 2).argmin()]]
                left = part[:, i] <= cut
                feature[node], value[node], below[node] = int(i), float(cut), len(feature)
                for half in (part[left], part[~left]):
                    heapq.heappush(open_parts, (-len(half), len(feature), half))
                    feature.append(-1)
                    value.append(0.0)
                    below.append(0)
                leaves += 1
                break
    kind = np.array(feature)
    return Splits(kind, np.array(value), np.array(below), np.where(kind < 0, np.cumsum(kind < 0) - 1, -1))


def cells_of(x: np.ndarray, splits: Splits) -> np.ndarray:
    node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(rows):
        at = node[rows]
        rows, at = rows[splits.feature[at] >= 0], at[splits.feature[at] >= 0]
        node[rows] = splits.below[at] + (x[rows, splits.feature[at]] > splits.value[at])
    return splits.cell[node].astype(np.int32)


def _placed(points: DataFrame, splits: Splits) -> DataFrame:
    """``cell`` of every point."""
    sent = points.sparkSession.sparkContext.broadcast(tuple(splits))

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(2))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells_of(x, Splits(*sent.value)) if len(x) else np.zeros(0, np.int32))], [*batch.schema.names, "cell"])

    return points.mapInArrow(run, f"{POINT}, cell int")


def _ids(column: pa.ChunkedArray) -> pa.Array:
    """One list array that begins at its first value."""
    column = column.combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), column.flatten())


def _within(placed: DataFrame, most: int, cells: np.ndarray, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """``found``: the nearest rows in a point's own cell, ``bound``: how far the last of them is, infinite if there are too few, and
    ``to``: the other cells whose box is no further from the point.  ``x`` is null where there is none."""
    sent = placed.sparkSession.sparkContext.broadcast((cells, low, high))

    def run(table: pa.Table) -> pa.Table:
        cells, low, high = sent.value
        x, ids, column = _matrix(table.column("x")), _ids(table.column("ids")), table.column("x")
        others = cells != table.column("cell")[0].as_py()
        hits = search(x, x, _ranks(table.column("id")), most, np.full(len(x), np.inf))
        found, bound = _candidates(len(x), hits, table.column("point").to_numpy(), ids, most)
        sizes, to = [np.zeros(1, np.int64)], [np.zeros(0, np.int32)]
        for at in range(0, len(x), BLOCK):
            s = slice(at, at + BLOCK)
            reached = (outside(x[s], low, high) <= bound[s][:, None] * (1 + SLACK)) & others
            sizes.append(reached.sum(axis=1))
            to.append(cells[np.nonzero(reached)[1]].astype(np.int32))
        ends = np.cumsum(np.concatenate(sizes))
        visits = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(to)))
        asks = pc.if_else(pa.array(np.diff(ends) > 0), pa.array(np.arange(len(x))), None)
        return pa.table({"point": table.column("point"), "x": column.take(asks), "found": found, "bound": pa.array(bound), "to": visits})

    return placed.select("point", "id", "x", "ids", "cell").groupBy("cell").applyInArrow(run, f"point bigint, x array<double>, {FOUND}, bound double, to array<int>")


def _across(visits: DataFrame, placed: DataFrame, most: int) -> DataFrame:
    """``point``, ``found``: the nearest rows of every visited cell within a point's bound."""

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not len(asked) or not len(held):
            return pa.table({"point": pa.array([], pa.int64()), "found": pa.array([], FOUND_TYPE)})
        x, others = _matrix(asked.column("x")), _matrix(held.column("x"))
        hits = search(x, others, _ranks(held.column("id")), most, asked.column("bound").to_numpy())
        found, _ = _candidates(len(x), hits, held.column("point").to_numpy(), _ids(held.column("ids")), most)
        some = pa.array(np.flatnonzero(np.diff(found.offsets.to_numpy())))
        return pa.table({"point": asked.column("point").take(some), "found": found.take(some)})

    # One row for each cell.
    parts = visits.groupBy("to").agg(F.ceil(F.count("*") / F.lit(VISITS)).cast("int").alias("parts"))
    asked = visits.join(F.broadcast(parts), "to").selectExpr("to", "cast(pmod(xxhash64(point), parts) as int) as part", "point", "x", "bound")
    held = placed.join(F.broadcast(parts), F.col("cell") == F.col("to")).selectExpr("cell", "explode(sequence(0, parts - 1)) as copy", "point", "id", "x", "ids")
    return asked.groupBy("to", "part").cogroup(held.groupBy("cell", "copy")).applyInArrow(run, f"point bigint, {FOUND}")


def _points(rows: DataFrame, key: str, features: list[str], most: int, scratch: Scratch) -> DataFrame:
    return scratch.write(collapsed(rows, key, features, most), "points")


def _named(rows: DataFrame, key: str, features: list[str], points: DataFrame) -> DataFrame:
    """(key, point): the number of the point where a row stands."""
    x = F.array(*[F.col(c).cast("double") + F.lit(0.0) for c in features])
    named = rows.select(F.col(key).cast("string").alias(key), x.alias("at"))
    return named.join(points.select("point", "x"), F.col("at") == F.col("x")).select(key, "point")


def _near_points(points: DataFrame, features: list[str], most: int, scratch: Scratch, cell_rows: int, keep_visits: bool) -> DataFrame:
    """``point``, ``found`` (the ``most`` nearest rows) of every distinct point.  Reads ``first`` and ``across`` in ``scratch``."""
    cells = max(1, min(MOST_PIVOTS, -(-points.count() // cell_rows)))
    chosen = points.orderBy(key_hash(F.col("id"), "pivot"), "id").limit(min(MOST_PIVOTS, SAMPLED * cells)).select("x").collect()
    splits = fit_splits(np.array([r["x"] for r in chosen], dtype=np.float64).reshape(len(chosen), len(features)), cells)
    placed = scratch.write(_placed(points, splits), "placed")
    ends = [f(F.col("x")[i]) for f in (F.min, F.max) for i in range(len(features))]
    boxes = placed.groupBy("cell").agg(F.array(*ends[: len(features)]).alias("low"), F.array(*ends[len(features) :]).alias("high")).collect()
    low, high = (np.array([r[side] for r in boxes], dtype=np.float64).reshape(len(boxes), len(features)) for side in ("low", "high"))
    first = scratch.write(_within(placed, most, np.array([r["cell"] for r in boxes], dtype=np.int32), low, high), "first")
    visits = first.where("size(to) > 0").selectExpr("explode(to) as to", "point", "x", "bound")
    if keep_visits:
        visits = scratch.write(visits, "visits")
    # A point has its own cell's rows and those of the cells that it visited, ``most`` of each at most.
    # Written by itself, so that cells and visitors are gone when the two passes are joined.
    across = scratch.write(_across(visits, placed, most), "across")
    scratch.drop("placed")
    further = across.groupBy("point").agg(F.flatten(F.collect_list("found")).alias("more"))
    both = first.select("point", "found").join(further, "point", "left")
    nearer = "(a, b) -> CASE WHEN a.distance < b.distance OR a.distance = b.distance AND a.id < b.id THEN -1 ELSE 1 END"
    return both.selectExpr("point", f"if(more is null, found, slice(array_sort(concat(found, more), {nearer}), 1, {most})) as found")


def _by_row(named: DataFrame, key: str, found: DataFrame, k: int) -> DataFrame:
    """(key, point, neighbours): what is found at a row's point, without the row."""
    return named.join(found, "point").select(key, "point", F.expr(f"slice(filter(found, n -> n.id <> {key}), 1, {k}) as neighbours"))


def near_names(
    rows: DataFrame, key: str, features: list[str], k: int, scratch: Scratch, cell_rows: int = CELL_ROWS, wanted: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(key, point, neighbours) as of ``near_neighbours``, but rows and neighbours have the number of their point for ``x``; and the table of ``point`` and ``x``.

    A row then takes a hundred bytes, whatever the number of features.  With ``wanted``, some of the rows, only those are given; all rows are searched.
    The first is lazy and reads tables in ``scratch``: when it is written, ``names``, ``first`` and ``across`` may go.
    """
    points = _points(rows, key, features, k + 1, scratch)  # a row finds itself
    # Written before the search, when little else is on disk; what is found then meets the rows by the number that it is joined by.
    named = scratch.write(_named(rows if wanted is None else wanted, key, features, points), "names")
    found = _near_points(points, features, k + 1, scratch, cell_rows, keep_visits=False)
    return _by_row(named, key, found, k), points.select("point", "x")


def near_neighbours(rows: DataFrame, key: str, features: list[str], k: int, scratch: Scratch, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(key, x, neighbours): the ``k`` nearest other rows of each row by Euclidean distance, nearest first, equal ones by key; exact.

    ``key`` is unique and features are not null.  ``distance`` is squared.  ``neighbours`` has fewer entries where there are not ``k`` other rows.
    The cells come from the points with the smallest hashes, ``MOST_PIVOTS`` at most; they and the boxes of the cells are all that reaches the driver.
    """
    points = _points(rows, key, features, k + 1, scratch)
    best = scratch.write(_near_points(points, features, k + 1, scratch, cell_rows, keep_visits=True), "best")
    scratch.drop("first", "across")
    pairs = best.selectExpr("point as of", "posexplode(found) as (rank, n)").selectExpr("of", "rank", "n.distance", "n.id", "n.point")
    at = points.select("point", "x")
    whole = pairs.join(at, "point").groupBy("of").agg(F.array_sort(F.collect_list(F.struct("rank", "distance", "id", "x"))).alias("whole"))
    found = whole.selectExpr("of as point", "transform(whole, n -> struct(n.distance, n.id, n.x)) as found")
    return _by_row(_named(rows, key, features, points), key, found, k).join(at, "point").select(key, "x", "neighbours")

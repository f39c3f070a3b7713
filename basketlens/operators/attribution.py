"""Sampled Shapley attribution of a classifier's probability."""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.shipping import by_value
from basketlens.operators.classify import FEATURES, KEY
from basketlens.session import Scratch

by_value(__name__)


def baseline(rows: DataFrame, features: list[str] = FEATURES) -> list[float]:
    """Feature means."""
    means = rows.agg(*[F.avg(c).alias(c) for c in features]).first()
    return [float(means[c] or 0.0) for c in features]


STANDARD_ERROR = 0.1  # of an attribution, on the probability scale, at most
DRAWS = 2  # feature orders that a row draws at first: one and its reverse; each further round draws as many as all before
MOST_ROUNDS = 20


def _step(width: int) -> int:
    """A step that shares no factor with the number of places, and so visits each of them once."""
    return next(k for k in range(max(1, round(width * 0.382)), width + 1) if math.gcd(k, width) == 1)


def _order(width: int, key: str, number: str, seed: int) -> str:
    """A row's random order of the features with that number."""
    return (
        f"transform(array_sort(transform(sequence(0, {width - 1}),"
        f" j -> struct(xxhash64({key}, {number}, j, {seed}L) as h, j as j))), s -> s.j)"
    )


def _drawn(model, rows: DataFrame, base: list[float], features: list[str], key: str, first: int, draws: int, seed: int) -> DataFrame:
    """(key, n, s, q): over ``draws`` draws from number ``first`` on, per feature the sum and the sum of squares of its change.

    A row has one random order of the features; pair of draws after pair it begins at another place of it, and the second of a pair is the
    reverse of the first, so that over a row's draws a feature joins early and late alike.  (Draws that balance each other make the error
    smaller than the one stated.)  The model scores every prefix of an order; a prefix counts for the feature that joined last and
    against the one joining next.
    """
    width = len(features)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = "array(" + ", ".join(f"cast({c} as double)" for c in features) + ")"
    means = "array(" + ", ".join(f"{v!r}D" for v in base) + ")"
    order = _order(width, key, f"draw div {2 * width}", seed)
    start = f"(draw div 2) * {_step(width)} % {width}"
    turned = f"concat(slice(whole, int(1 + {start}), {width}), slice(whole, 1, int({start})))"
    drawn = (
        rows.select(key, *features)
        .repartition(tasks, key)
        .selectExpr(key, f"{x} as x", f"explode(sequence({first}, {first + draws - 1})) as draw")
        .selectExpr(key, "x", "draw", f"{order} as whole")
        .selectExpr(key, "x", "draw", f"{turned} as forward")
        .selectExpr(key, "x", "draw", "if(draw % 2 = 0, forward, reverse(forward)) as joined")
    )
    # The ranks are columns below the explode, so that they are computed once per order.
    ranked = drawn.selectExpr(
        key, "draw", "joined", "x", f"transform(sequence(0, {width - 1}), j -> int(array_position(joined, j))) as ranks"
    )
    prefixes = ranked.selectExpr("*", f"explode(sequence(0, {width})) as taken").selectExpr(
        key,
        "draw",
        "joined",
        "taken",
        f"transform(sequence(0, {width - 1}), j -> if(ranks[j] <= taken, x[j], {means}[j])) as point",
    )
    scored = model.transform(prefixes.withColumn("features", array_to_vector("point")).drop("point"))
    shares = scored.select(
        key,
        "draw",
        F.expr("if(taken >= 1, joined[greatest(taken - 1, 0)], -1)").alias("last"),
        F.expr(f"if(taken < {width}, joined[least(taken, {width - 1})], -1)").alias("next"),
        vector_to_array("probability")[1].alias("p"),
    )
    changes = shares.groupBy(key, "draw").agg(
        *[F.expr(f"sum(case {j} when last then p when next then -p else 0 end)").alias(f"phi{j}") for j in range(width)]
    )
    return changes.groupBy(key).agg(
        F.count("*").alias("n"), F.array(*[F.sum(f"phi{j}") for j in range(width)]).alias("s"),
        F.array(*[F.sum(F.col(f"phi{j}") * F.col(f"phi{j}")) for j in range(width)]).alias("q"),
    )


ROWS = 32  # scored at once: their masks stay in a core's cache
MOST_LEAVES = 64
SPREADER = np.uint64(0x03F79D71B4CB0A89)  # its 64 shifts begin with 64 different groups of six bits


class Masks(NamedTuple):
    """Boosted trees by feature: which leaves a value leaves open.

    A value of feature ``f`` above ``n`` of its ``thresholds[f]`` closes, in every tree, the leaves left of the splits it fails: ``open[f][n]`` has a
    bit for every leaf that stays open, in their order.  A point ends in the first leaf that all its features leave open.
    """

    thresholds: list
    open: list
    leaves: np.ndarray  # weighted predictions, by tree and spread bit


def tree_masks(model, width: int) -> Masks | None:
    """The masks of a boosted classifier; nothing for other models, for larger trees and for splits by category."""
    if not isinstance(model, GBTClassificationModel):
        return None
    text, weights = model.toDebugString, list(model.treeWeights)
    trees = re.split(r"\n\s*Tree \d+ \(weight [^)]*\):\n", text)[1:]
    splits, leaves = [], np.zeros((len(trees), MOST_LEAVES))
    for t, tree in enumerate(trees):
        seen, waiting = 0, []
        for line in tree.splitlines():
            line = line.strip()
            if line.startswith("If"):
                found = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line)
                if not found:
                    return None
                waiting.append((int(found[1]), float(found[2]), seen))
            elif line.startswith("Else"):
                feature, value, first = waiting.pop()
                splits.append((feature, value, t, ~(((1 << seen) - 1) ^ ((1 << first) - 1)) & (1 << 64) - 1))
            elif line.startswith("Predict"):
                if seen == MOST_LEAVES:
                    return None
                bit = np.array([1 << seen], np.uint64) * SPREADER >> np.uint64(58)
                leaves[t, int(bit[0])] = weights[t] * float(line.split(":")[1])
                seen += 1
    thresholds, left = [], []
    for f in range(width):
        mine = [s for s in splits if s[0] == f]
        values = np.unique([s[1] for s in mine]) if mine else np.zeros(0)
        table = np.full((len(values) + 1, len(trees)), np.iinfo(np.uint64).max, np.uint64)
        for _, value, t, mask in mine:
            table[np.searchsorted(values, value) + 1, t] &= np.uint64(mask)
        thresholds.append(values)
        left.append(np.bitwise_and.accumulate(table, axis=0))
    return Masks(thresholds, left, leaves)


def _probabilities(masks: np.ndarray, leaves: np.ndarray) -> np.ndarray:
    """Probability of every row from its open leaves by tree."""
    bit = ((masks & (~masks + np.uint64(1))) * SPREADER >> np.uint64(58)).astype(np.int64)
    bit += np.arange(len(leaves)) * MOST_LEAVES
    return 1.0 / (1.0 + np.exp(-2.0 * leaves.ravel().take(bit).sum(axis=1)))


def _walked(masks: Masks, x: np.ndarray, base: list[float], orders: np.ndarray, first: int, draws: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row and feature, sums and sums of squares of the changes over the draws; ``orders`` are the rows' orders from that of ``first`` on."""
    width, rows = x.shape[1], np.arange(len(x))
    sums, squares = np.zeros(x.shape), np.zeros(x.shape)
    given = np.stack([masks.open[f][np.searchsorted(masks.thresholds[f], x[:, f])] for f in range(width)])
    means = np.stack([masks.open[f][np.searchsorted(masks.thresholds[f], base[f])] for f in range(width)])
    for number in range(first // (2 * width), (first + draws - 1) // (2 * width) + 1):
        order = orders[:, number - first // (2 * width)]
        joined = [given[order[:, j], rows] for j in range(width)]
        rest = [means[order[:, j]] for j in range(width)]
        s, q, seen = np.zeros(x.shape), np.zeros(x.shape), {}
        for pair in range(max(first, number * 2 * width) // 2, min(first + draws, (number + 1) * 2 * width) // 2):
            start = pair * _step(width) % width
            for back in (False, True):
                places = [(start + i) % width for i in range(width)][:: -1 if back else 1]
                # What the features that have not joined yet leave open, for each number of joined ones.
                later = [None] * (width + 1)
                later[width] = np.uint64(np.iinfo(np.uint64).max)
                for i in range(width - 1, -1, -1):
                    later[i] = later[i + 1] & rest[places[i]]
                now, before = np.uint64(np.iinfo(np.uint64).max), None
                for i in range(width + 1):
                    # The joined features are neighbours in the order: draws share such sets.
                    name = ((places[i - 1] if back else start) if 0 < i < width else 0, i)
                    if i:
                        now = now & joined[places[i - 1]]
                    if name not in seen:
                        seen[name] = _probabilities(now & later[i], masks.leaves)
                    if i:
                        change = seen[name] - before
                        s[:, places[i - 1]] += change
                        q[:, places[i - 1]] += change * change
                    before = seen[name]
        sums[rows[:, None], order] += s
        squares[rows[:, None], order] += q
    return sums, squares


def _drawn_by_masks(masks: Masks, rows: DataFrame, base: list[float], features: list[str], key: str, first: int, draws: int, seed: int) -> DataFrame:
    """As ``_drawn``, for boosted trees and unique keys: draws, but the prefixes of an order are scored by masks, where one feature more is one more mask."""
    width = len(features)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbers = f"sequence({first // (2 * width)}L, {(first + draws - 1) // (2 * width)}L)"
    x = "array(" + ", ".join(f"cast({c} as double)" for c in features) + ")"
    drawn = rows.select(key, *features).repartition(tasks, key).selectExpr(
        key, f"{x} as x", f"flatten(transform({numbers}, number -> {_order(width, key, 'number', seed)})) as orders")
    sent = rows.sparkSession.sparkContext.broadcast((tuple(masks), base))

    def run(batches):
        held, means = Masks(*sent.value[0]), sent.value[1]
        for batch in batches:
            n = len(batch)
            points = batch.column(1).flatten().to_numpy().reshape(n, width)
            orders = batch.column(2).flatten().to_numpy().reshape(n, -1, width)
            for at in range(0, n, ROWS):
                part = slice(at, at + ROWS)
                s, q = _walked(held, points[part], means, orders[part], first, draws)
                ends = pa.array(np.arange(len(s) + 1) * width, pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(v.ravel())) for v in (s, q)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[part], pa.array(np.full(len(s), draws)), *lists], [key, "n", "s", "q"])

    return drawn.mapInArrow(run, f"{key} {dict(rows.dtypes)[key]}, n bigint, s array<double>, q array<double>")


def attributions(
    model, rows: DataFrame, base: list[float], features: list[str] = FEATURES, key: str = KEY,
    error: float = STANDARD_ERROR, seed: int = 42,
) -> DataFrame:
    """(key, feature, phi, std_error): mean change of the probability when the feature joins, over sampled orders.

    A row draws orders in rounds until the standard error of each of its attributions is at most ``error`` (or, never seen, ``MOST_ROUNDS`` have
    passed: its stated error then tells); rows that are done take no part in the next round.  The attributions of a draw add up to the probability less that of the base, so those of a row do.  Every round's
    sums are written: a lost executor costs one round.  The work is linear in the rows.
    """
    scratch = Scratch(rows.sparkSession, "attributions")
    masks = tree_masks(model, len(features))
    rows = scratch.write(rows.select(key, *features), "rows")
    # Rows that share a key, or have none, count together.
    shared = scratch.write(rows.groupBy(key).agg(F.count("*").alias("rows")).where((F.col("rows") > 1) | F.col(key).isNull()).select(key), "shared") if masks else None
    plain = masks is None or not shared.isEmpty()
    spread = "greatest(0D, (q[j] - s[j] * s[j] / n) / (n - 1))"
    errors = f"transform(sequence(0, {len(features) - 1}), j -> sqrt({spread} / n))"
    total, left = None, rows
    for at in range(MOST_ROUNDS):
        first = DRAWS << (at - 1) if at else 0
        draws = (base, features, key, first, first or DRAWS, seed)
        new = _drawn(model, left if masks is None else left.join(shared, left[key].eqNullSafe(shared[key]), "left_semi"), *draws) if plain else None
        if masks is not None:
            alone = left.join(shared, left[key].eqNullSafe(shared[key]), "left_anti") if plain else left
            alone = _drawn_by_masks(masks, alone, *draws)
            new = alone if new is None else new.unionByName(alone)
        if total is None:
            total = scratch.write(new, "round-0")
        else:
            both = total.unionByName(new)
            sums = lambda c: F.array(*[F.sum(F.col(c)[j]) for j in range(len(features))]).alias(c)
            total = scratch.write(both.groupBy(key).agg(F.sum("n").alias("n"), sums("s"), sums("q")), f"round-{at}")
        open_rows = total.where(f"array_max({errors}) > {error!r}D").select(key)
        if open_rows.isEmpty():
            break
        left = rows.join(open_rows, key, "left_semi")
    entries = ", ".join(f"struct('{c}' as feature, s[{j}] / n as phi, errors[{j}] as std_error)" for j, c in enumerate(features))
    return total.selectExpr("*", f"{errors} as errors").selectExpr(key, f"inline(array({entries}))")


def global_importance(attributed: DataFrame, size: int | None = 5) -> DataFrame:
    ranked = (
        attributed.groupBy("feature")
        .agg(F.avg(F.abs("phi")).alias("mean_abs"))
        .orderBy(F.desc("mean_abs"), "feature")
    )
    return ranked if size is None else ranked.limit(size)


def breakdown(attributed: DataFrame, row_key: str, base_value: float, key: str = KEY) -> DataFrame:
    """Base value and contributions of one row, largest first."""
    return (
        attributed.where(F.col(key) == row_key)
        .select(key, "feature", "phi", F.lit(base_value).alias("base_value"))
        .orderBy(F.desc(F.abs("phi")), "feature")
    )


def probability_at(model, spark, point: list[float]) -> float:
    """The model's probability at one point."""
    row = spark.createDataFrame([(point,)], "point array<double>").select(array_to_vector("point").alias("features"))
    return model.transform(row).select(vector_to_array("probability")[1]).first()[0]

"""Segments by recency, frequency and spend."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.shipping import by_value

by_value(__name__)

RFM = ["Recency", "Frequency_of_Purchase", "Purchase_Amount"]

STARTS = 10
MOST_CELLS = 50_000  # of a coreset, about: two megabytes on the driver and in a broadcast
RESOLUTIONS = [2**b for b in range(3, 13)]  # cells along an axis
MOST_ROUNDS, LEAST_MOVE = 300, 1e-4

# Segment names by profile, and the list used when scoring.
CHAMPIONS, HIBERNATING, LOYAL = "Champions (VIP)", "Hibernating (At Risk)", "Loyal Customers"
POTENTIAL = "Potential Loyalist"
SCORED_NAMES = ["Nhóm 0 (Tiềm năng)", "Nhóm 1 (Ngủ đông)", "Nhóm 2 (Trung thành)", "Nhóm 3 (Rời bỏ)"]


def add_recency(orders: DataFrame) -> DataFrame:
    """Add whole days from the purchase to one day after the last purchase."""
    last = orders.agg(F.max("Time_of_Purchase")).scalar()
    return orders.withColumn("_last", last).withColumn(
        "Recency", F.expr("cast(timestampdiff(DAY, Time_of_Purchase, _last) + 1 as int)")
    ).drop("_last")


def rfm(orders: DataFrame, *keep: str) -> DataFrame:
    return add_recency(orders).select(*keep, *RFM).dropna(subset=RFM)


def standardised(rows: DataFrame, columns: list[str] = RFM) -> DataFrame:
    """Add ``<column>_z``: centred, divided by the population deviation (1 when constant)."""
    cells = ", ".join(f"avg({c}) as {c}_m, stddev_pop({c}) as {c}_s" for c in columns).split(", ")
    stats = rows.agg(F.struct(*[F.expr(c) for c in cells]).alias("s")).scalar()
    return rows.withColumn("_s", stats).selectExpr(
        *rows.columns, *[f"({c} - _s.{c}_m) / if(_s.{c}_s = 0, 1, _s.{c}_s) as {c}_z" for c in columns]
    )


def _prepared(rows: DataFrame):
    """Fitted assembler and scaler, and the persisted scaled vectors."""
    assembler = VectorAssembler(inputCols=RFM, outputCol="rfm")
    assembled = assembler.transform(rows)
    scaler = StandardScaler(inputCol="rfm", outputCol="scaled", withMean=True, withStd=True).fit(assembled)
    vectors = scaler.transform(assembled).select(vector_to_array("scaled").alias("z")).persist(StorageLevel.MEMORY_AND_DISK)
    return assembler, scaler, vectors


class Coreset(NamedTuple):
    """Weighted means of the cells of a grid, and the rows' squared distances from the mean of their cell."""

    points: np.ndarray
    weights: np.ndarray
    spread: float


def coreset(vectors: DataFrame, most_cells: int = MOST_CELLS) -> Coreset:
    """The rows of ``z`` as the occupied cells of the finest grid that has about ``most_cells`` at most.

    For any centres the root of the rows' cost differs from the root of the cells' cost by at most the root of ``spread``: a row is no
    further from its cell's mean than that, whichever centre is nearest (the triangle inequality, summed over rows).
    """
    width = len(vectors.first()["z"])
    axes = [F.col("z")[i] for i in range(width)]
    ends = vectors.agg(*[f(a) for a in axes for f in (F.min, F.max)]).first()
    low, side = [ends[2 * i] for i in range(width)], [(ends[2 * i + 1] - ends[2 * i]) or 1.0 for i in range(width)]

    def cell(resolution: int) -> list:
        return [F.least(F.floor((a - F.lit(lo)) / F.lit(w) * resolution), F.lit(resolution - 1)) for a, lo, w in zip(axes, low, side)]

    sizes = vectors.agg(*[F.approx_count_distinct(F.struct(*cell(r))) for r in RESOLUTIONS]).first()
    resolution = max([r for r, n in zip(RESOLUTIONS, sizes) if n <= most_cells], default=RESOLUTIONS[0])
    cells = vectors.groupBy(*[c.alias(f"g{i}") for i, c in enumerate(cell(resolution))]).agg(
        F.count("*").alias("w"), *[F.avg(a).alias(f"m{i}") for i, a in enumerate(axes)], sum((F.var_pop(a) for a in axes), F.lit(0.0)).alias("v"))
    # About ``most_cells`` rows.
    rows = cells.orderBy(*[f"g{i}" for i in range(width)]).collect()
    points = np.array([[r[f"m{i}"] for i in range(width)] for r in rows], dtype=np.float64)
    weights = np.array([r["w"] for r in rows], dtype=np.float64)
    return Coreset(points, weights, float(sum(r["w"] * r["v"] for r in rows)))


def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((points[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)


def weighted_kmeans(points: np.ndarray, weights: np.ndarray, k: int, seed: list[int]) -> tuple[float, np.ndarray]:
    """Cost and centres of one start: spread-out seeding, then moves until the centres stay."""
    rng = np.random.default_rng(seed)
    k = min(k, len(points))
    centres = points[rng.choice(len(points), p=weights / weights.sum())][None, :]
    while len(centres) < k:
        far = squared(points, centres).min(axis=1) * weights
        centres = np.vstack([centres, points[rng.choice(len(points), p=far / far.sum()) if far.sum() else len(centres)]])
    for _ in range(MOST_ROUNDS):
        own = squared(points, centres).argmin(axis=1)
        total = np.bincount(own, weights, minlength=k)
        sums = np.stack([np.bincount(own, weights * points[:, i], minlength=k) for i in range(points.shape[1])], axis=1)
        new = np.where(total[:, None] > 0, sums / np.maximum(total, 1e-300)[:, None], centres)
        moved, centres = ((new - centres) ** 2).sum(), new
        if moved <= LEAST_MOVE**2:
            break
    return float((squared(points, centres).min(axis=1) * weights).sum()), centres[np.lexsort(centres.T[::-1])]


def best_centres(spark, core: Coreset, ks: list[int], starts: int, seed: int) -> dict[int, np.ndarray]:
    """For each k the centres of the start with the lowest cost over the coreset; every start is a task of its own."""
    sent = spark.sparkContext.broadcast((core.points, core.weights))
    tries = [(k, start) for k in ks for start in range(starts)]

    def run(batches):
        for batch in batches:
            for k, start in zip(*(c.to_pylist() for c in batch.columns)):
                cost, centres = weighted_kmeans(*sent.value, k, [seed, k, start])
                yield pa.RecordBatch.from_pylist([{"k": k, "start": start, "cost": cost, "centres": centres.ravel().tolist()}])

    table = spark.createDataFrame(tries, "k int, start int").repartition(len(tries), "k", "start")
    found = table.mapInArrow(run, "k long, start long, cost double, centres array<double>")
    best = {r["k"]: r for r in sorted(found.collect(), key=lambda r: (-r["cost"], -r["start"]))}
    sent.destroy()
    return {k: np.array(best[k]["centres"]).reshape(-1, core.points.shape[1]) for k in ks}


def _tallies(vectors: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, dict]:
    """Per k: cost, and rows, sums and sums of squares of every cluster; one pass over the rows for all k."""

    def run(batches):
        for batch in batches:
            z = batch.column(0).flatten().to_numpy().reshape(len(batch), -1)
            out = []
            for k, c in centres.items():
                far = squared(z, c)
                own = far.argmin(axis=1)
                for at in range(len(c)):
                    mine = z[own == at]
                    if len(mine):
                        out.append({"k": k, "cluster": at, "n": len(mine), "cost": float(far[own == at, at].sum()), "squares": float((mine * mine).sum()), "sums": mine.sum(axis=0).tolist()})
            yield pa.RecordBatch.from_pylist(out)

    width = next(iter(centres.values())).shape[1]
    parts = vectors.select("z").mapInArrow(run, "k long, cluster long, n long, cost double, squares double, sums array<double>")
    rows = parts.groupBy("k", "cluster").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.sum("squares").alias("squares"),
                                             F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums")).collect()
    out = {}
    for k, c in centres.items():
        mine = {r["cluster"]: r for r in rows if r["k"] == k}
        n = np.array([mine[a]["n"] if a in mine else 0 for a in range(len(c))], dtype=np.float64)
        sums = np.array([mine[a]["sums"] if a in mine else [0.0] * width for a in range(len(c))])
        out[k] = {"n": n, "sums": sums, "squares": np.array([mine[a]["squares"] if a in mine else 0.0 for a in range(len(c))]), "cost": sum(r["cost"] for r in mine.values())}
    return out


def _silhouettes(vectors: DataFrame, centres: dict[int, np.ndarray], tallies: dict[int, dict]) -> dict[int, float]:
    """Per k the mean silhouette by squared distances, from the clusters' sums; one pass for all k."""

    def run(batches):
        for batch in batches:
            z = batch.column(0).flatten().to_numpy().reshape(len(batch), -1)
            out = []
            for k, c in centres.items():
                n, sums, squares = (tallies[k][x] for x in ("n", "sums", "squares"))
                own = squared(z, c).argmin(axis=1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    mean = np.where(n > 0, (z * z).sum(axis=1)[:, None] + squares / n - 2 * z @ (sums / n[:, None]).T, np.inf)
                    at = np.arange(len(z))
                    inside = mean[at, own] * n[own] / (n[own] - 1)
                    mean[at, own] = np.inf
                    outside = mean.min(axis=1)
                    value = np.where((n[own] > 1) & np.isfinite(outside), (outside - inside) / np.maximum(inside, outside), 0.0)
                out.append({"k": k, "total": float(np.nan_to_num(value).sum()), "n": len(z)})
            yield pa.RecordBatch.from_pylist(out)

    parts = vectors.select("z").mapInArrow(run, "k long, total double, n long")
    return {r["k"]: r["value"] for r in parts.groupBy("k").agg((F.sum("total") / F.sum("n")).alias("value")).collect()}


def sweep(rows: DataFrame, ks: range = range(2, 10), starts: int = STARTS, seed: int = 42) -> DataFrame:
    """Inertia and silhouette per number of clusters, over all rows.

    All starts of all k run on one coreset; one pass over the rows then costs the best centres of every k, a second gives
    their silhouettes (squared distances to cluster means).  Inertia is on the population-deviation scale.
    """
    _, _, vectors = _prepared(rows)
    try:
        centres = best_centres(rows.sparkSession, coreset(vectors), list(ks), starts, seed)
        tallies = _tallies(vectors, centres)
        scores = _silhouettes(vectors, centres, tallies)
    finally:
        vectors.unpersist()
    found = []
    for k in ks:
        n = tallies[k]["n"].sum()
        found.append((k, float(tallies[k]["cost"] * n / (n - 1)), scores[k]))
    return rows.sparkSession.createDataFrame(found, "k int, inertia double, silhouette double")


def as_model(spark, centres: np.ndarray):
    """The centres as a k-means model: fitted on the centres alone, each of which is a cluster."""
    table = spark.createDataFrame([(c.tolist(),) for c in centres], "z array<double>").select(array_to_vector("z").alias("scaled"))
    return KMeans(k=len(centres), initMode="random", maxIter=1, seed=1, featuresCol="scaled", predictionCol="Cluster").fit(table)


def fit_segments(rows: DataFrame, k: int = 4, starts: int = STARTS, seed: int = 42) -> PipelineModel:
    """Assembler, scaler and k-means as one model that can be saved; the centres come from a coreset of the rows."""
    assembler, scaler, vectors = _prepared(rows)
    try:
        centres = best_centres(rows.sparkSession, coreset(vectors), [k], starts, seed)[k]
    finally:
        vectors.unpersist()
    return PipelineModel([assembler, scaler, as_model(rows.sparkSession, centres)])


def profile(clustered: DataFrame, key: str = "Cluster") -> DataFrame:
    return clustered.groupBy(key).agg(*[F.round(F.avg(c), 2).alias(c) for c in RFM]).orderBy(key)


def segment_names(profiles: DataFrame) -> DataFrame:
    """Name per cluster; one cluster winning several titles takes the last of amount, recency, frequency."""
    def winner(column: str) -> str:
        # Highest mean; the lower cluster id on a tie.
        return f"max_by(Cluster, struct({column}, -Cluster)) over ()"

    # One row per cluster.
    return profiles.selectExpr(
        "Cluster",
        f"""case when Cluster = {winner('Frequency_of_Purchase')} then '{LOYAL}'
            when Cluster = {winner('Recency')} then '{HIBERNATING}'
            when Cluster = {winner('Purchase_Amount')} then '{CHAMPIONS}'
            else '{POTENTIAL}' end as Segment_Name""",
    )


def named(clustered: DataFrame) -> DataFrame:
    """Add the segment name; the joined table has one row per cluster."""
    return clustered.join(F.broadcast(segment_names(profile(clustered))), "Cluster", "left")


def radar(profiles: DataFrame) -> DataFrame:
    """Profiles scaled to 0-1 over the clusters, recency inverted."""
    def unit(c: str) -> str:
        return f"({c} - min({c}) over ()) / (max({c}) over () - min({c}) over () + 1e-9D)"

    return profiles.selectExpr(
        "Cluster", f"1 - {unit('Recency')} as recency_inverted", f"{unit('Frequency_of_Purchase')} as frequency",
        f"{unit('Purchase_Amount')} as monetary",
    )


def projection(clustered: DataFrame) -> DataFrame:
    """Add two principal components of the scaled vectors."""
    model = PCA(k=2, inputCol="scaled", outputCol="components").fit(clustered)
    parts = vector_to_array("components")
    return model.transform(clustered).withColumns({"PC1": parts[0], "PC2": parts[1]}).drop("components")


def score_segments(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Assign rows (recency relative to these rows) and name clusters from the fixed list."""
    names = ", ".join(f"'{n}'" for n in SCORED_NAMES)
    return model.transform(rows).withColumn(
        "Segment", F.expr(f"element_at(array({names}), Cluster % {len(SCORED_NAMES)} + 1)")
    )

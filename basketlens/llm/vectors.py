"""Embedding near-dedup with spherical-cap filters.

Filters are directions in space; a vector belongs to all whose inner product with it exceeds a threshold (it lies in
their caps).  The directions form a structured code: the space is cut into two blocks, each with a small random codebook,
and a filter is one codeword of each.  So a vector's caps are listed from two short score lists, best first, without
looking at all products.  Vectors that share a cap are compared in double precision.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.shipping import by_value
from basketlens.llm.components import connected_components
from basketlens.session import Scratch

by_value(__name__)

COSINE = 0.95
CODES = 4  # independent codes: a vector that lies between the directions of one does not in all
MISS = 1e-4  # chance to miss a pair at the threshold that the number of caps is chosen for
NARROW = 16  # coordinates that the plan's normal scores need, at least
CROWD = 64  # distinct vectors for each filter
BLOCK = 1024  # vectors of one cap that are compared at once


def _tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def cap_plan(vectors: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, float]:
    """Codewords per block and threshold (in standard deviations of a random product) for a number of vectors.

    Filters grow with the vectors, so the crowd in a cap stays the same.  The threshold is the highest with which a pair at ``cosine``
    shares a cap with the wanted chance: each cap of one vector holds the other with the chance that its normal score stays above.
    """
    words = max(16, math.ceil(math.sqrt(vectors / CROWD * 8)))
    filters = CODES * words * words
    best = 1.0
    for z in np.arange(6.0, 0.5, -0.02):
        # P(second score > z | first score > z), by quadrature over the first score's excess (about exponential).
        u = z + (np.arange(40) + 0.5) / 40 * 3 / max(z, 1)
        density = np.exp(-u * u / 2)
        above = np.array([_tail((z - cosine * v) / math.sqrt(1 - cosine * cosine)) for v in u])
        stay = float((density * above).sum() / density.sum())
        # Caps of one vector are correlated through the blocks: count half of them as independent.
        if filters * _tail(z) * stay / 2 >= -math.log(miss):
            best = float(z)
            break
    return words, best


def codebooks(width: int, words: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Two random codebooks for the first and the second half of the coordinates; a filter's two parts have norm 1/2 (squared)."""
    rng = np.random.default_rng((seed, width, words))
    cut = max(1, width // 2)
    books = []
    for size in (cut, width - cut):
        book = rng.normal(size=(words, max(size, 1)))
        books.append(book / np.linalg.norm(book, axis=1, keepdims=True) * math.sqrt(0.5))
    return books[0], books[1]


def rotation(width: int, code: int, seed: int = 12) -> np.ndarray:
    """The random rotation of a code: blocks of any input then carry about equal shares of the norm."""
    q, r = np.linalg.qr(np.random.default_rng((seed, width, code)).normal(size=(width, width)))
    return q * np.sign(np.diag(r))


def caps(unit: np.ndarray, words: int, z: float) -> list[np.ndarray]:
    """Filters whose caps hold each (unit) row: list decoding, from the best codewords on, until no row reaches the threshold."""
    if unit.shape[1] < NARROW:  # zeros leave all angles as they are
        unit = np.pad(unit, ((0, 0), (0, NARROW - unit.shape[1])))
    width = unit.shape[1]
    left, right = codebooks(width, words)
    least = z / math.sqrt(width)
    rows, codes = [], []
    for code in range(CODES):
        turned = unit @ rotation(width, code)
        first, second = turned[:, : left.shape[1]] @ left.T, turned[:, left.shape[1] :] @ right.T
        order1, order2 = np.argsort(-first, axis=1), np.argsort(-second, axis=1)
        first, second = np.take_along_axis(first, order1, 1), np.take_along_axis(second, order2, 1)
        for i in range(words):
            start = np.flatnonzero(first[:, i] + second[:, 0] >= least)
            if not len(start):
                break
            live = start
            for j in range(words):
                live = live[first[live, i] + second[live, j] >= least]
                if not len(live):
                    break
                rows.append(live)
                codes.append((code * words + order1[live, i]) * words + order2[live, j])
    if not rows:
        return [np.zeros(0, dtype=np.int64) for _ in unit]
    rows, codes = np.concatenate(rows), np.concatenate(codes)
    order = np.lexsort((codes, rows))
    return np.split(codes[order], np.cumsum(np.bincount(rows, minlength=len(unit)))[:-1])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, width)


def _list_of(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.zeros(0), kind))


def _compare(a: tuple, b: tuple, cap: int, cosine: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of two blocks of a cap that are linked and whose first common cap this is."""
    (units_a, caps_a), (units_b, caps_b) = a, b
    hit = units_a @ units_b.T >= cosine
    if same:
        hit = np.triu(hit, 1)
    i, j = np.nonzero(hit)
    keep = np.ones(len(i), dtype=bool)
    for at in range(0, len(i), 1 << 14):
        p, q = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
        x, y = caps_a[p], caps_b[q]
        keep[at : at + (1 << 14)] = ~((x[:, :, None] == y[:, None, :]) & (x[:, :, None] < cap) & (x[:, :, None] >= 0)).any(axis=(1, 2))
    return i[keep], j[keep]


def _padded(lists: pa.ListArray) -> np.ndarray:
    """Lists as rows of equal length, filled up with -1."""
    sizes = np.asarray(lists.value_lengths())
    out = np.full((len(sizes), max(1, int(sizes.max(initial=0)))), -1, dtype=np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.asarray(lists.flatten())
    return out


def near_vectors(vectors: DataFrame, scratch: Scratch, cosine: float = COSINE, miss: float = MISS) -> DataFrame:
    """One row per input row: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Equal vectors are compared once, as a class with a weight; all vectors of a class are linked to each other.  A pair is
    counted in the first cap that both are in, in the task that compares them: what leaves a task is a count per class and at most one
    link per class and block, never the pairs.  A cap with many classes is cut into blocks, and pairs of blocks are
    separate rows.  Vectors that are null, zero, empty, or hold null or non-finite components link with nothing; vectors of
    different lengths are not compared.  Rows that repeat a ``vec_id`` are vectors of their own for ``n_links`` and share a component;
    rows without ``vec_id`` count as links and have a null component.  Only ``vec_id`` and ``embedding`` are read.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    fit = (
        (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    rows = scratch.write(rows.select("vec_id", "v", F.coalesce(fit, F.lit(False)).alias("fit"), F.xxhash64("v").alias("h")), "rows")
    # A class: equal vectors.  Its number is any that is the same in every run: the hash of the vector, and the least id is its name.
    classes = scratch.write(
        rows.where("fit").groupBy("h", "v").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"))
        .withColumn("class", F.xxhash64("v", F.lit("class"))), "classes",
    )
    sizes = classes.groupBy(F.size("v").alias("width")).count().collect()  # one row per vector length in use
    plans = {r.width: cap_plan(r["count"], cosine, miss) for r in sizes}

    def list_caps(batches):
        for batch in batches:
            values = batch.column(2)
            widths = np.asarray(values.value_lengths())
            for width in np.unique(widths):
                picked = np.flatnonzero(widths == width)
                part = batch.take(pa.array(picked))
                matrix = _matrix(part.column(2), int(width))
                unit = matrix / np.linalg.norm(matrix / np.abs(matrix).max(axis=1, keepdims=True), axis=1, keepdims=True) / np.abs(matrix).max(axis=1, keepdims=True)
                found = caps(unit, *plans[int(width)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), _list_of(list(unit), pa.float64()), _list_of(found, pa.int64())], ["class", "weight", "unit", "caps"])

    capped = classes.select("class", "weight", "v").mapInArrow(list_caps, "class long, weight long, unit array<double>, caps array<long>")
    capped = scratch.write(capped.withColumn("width", F.size("unit")), "capped")
    members = capped.select("width", F.explode("caps").alias("cap"), "class")
    crowds = scratch.write(members.groupBy("width", "cap").count().where("count > 1").selectExpr("width", "cap", f"cast(ceil(count / {BLOCK}) as int) as parts"), "crowds")
    blocks = (
        capped.select("width", F.explode("caps").alias("cap"), "class", "weight", "unit", "caps").join(crowds, ["width", "cap"])
        .withColumn("part", F.pmod(F.xxhash64("class"), "parts"))
        # A block goes, as first or second, to every pair of blocks that it is in.
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .selectExpr("width", "cap", "least(part, other) as one", "greatest(part, other) as two", "part", "class", "weight", "unit", "caps")
    )

    def links(table: pa.Table) -> pa.Table:
        cap, one, two = (table.column(c)[0].as_py() for c in ("cap", "one", "two"))
        part, kinds, weights = (table.column(c).to_numpy() for c in ("part", "class", "weight"))
        units = _matrix(table.column("unit").combine_chunks(), table.column("width")[0].as_py())
        listed = _padded(table.column("caps").combine_chunks())
        here, there = np.flatnonzero(part == one), np.flatnonzero(part == two)
        i, j = _compare((units[here], listed[here]), (units[there], listed[there]), cap, cosine, one == two)
        i, j = here[i], there[j]
        more = np.bincount(i, weights=weights[j], minlength=len(kinds)) + np.bincount(j, weights=weights[i], minlength=len(kinds))
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while (y := up.get(x, x)) != x:
                up[x] = up.get(y, y)
                x = y
            return x

        for x, y in zip(kinds[i].tolist(), kinds[j].tolist()):
            x, y = root(x), root(y)
            if x != y:
                up[max(x, y)] = min(x, y)
        linked = np.flatnonzero(more)
        return pa.table({
            "class": pa.array(kinds[linked], pa.int64()), "n": pa.array(more[linked].astype(np.int64), pa.int64()),
            "to": pa.array([root(x) for x in kinds[linked].tolist()], pa.int64()),
        })

    found = scratch.write(blocks.groupBy("width", "cap", "one", "two").applyInArrow(links, "class long, n long, to long"), "found")
    # Components are named by the least id, which a class has unless all of its rows lack one.
    roots = connected_components(found.selectExpr("class as a", "to as b"), scratch)
    named = classes.select("class", "id").join(roots.withColumnRenamed("node", "class"), "class", "left").select(F.coalesce("root", "class").alias("root"), "class", "id")
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    counts = found.groupBy("class").agg(F.sum("n").alias("n"))
    # Classes that hold one vec_id (repeated rows with different vectors) are one component in the result only by their id.
    labels = scratch.write(
        classes.select("h", "v", "class", "weight").join(named.select("class", "root"), "class").join(least, "root").join(counts, "class", "left")
        .selectExpr("h", "v", "coalesce(n, 0) + weight - 1 as n_links", "component_id"), "labels",
    )
    plain = rows.where("fit").join(labels, ["h", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not fit").selectExpr("vec_id", "0L as n_links", "vec_id as component_id")
    return plain.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op7_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Scratch(spark, "vectors"))


OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), r AS (
  SELECT a AS n, a AS m FROM l UNION SELECT r.n, l.b FROM r JOIN l ON l.a = r.m
), c AS (
  SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, coalesce((SELECT min(m) FROM r WHERE r.n = e.vec_id), e.vec_id) AS component_id
  FROM embeddings e
)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM c
"""

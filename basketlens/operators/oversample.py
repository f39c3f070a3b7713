"""Oversampling of the smaller class by interpolation between neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.hashing import key_hash, key_uniform
from basketlens.operators.neighbours import near_names
from basketlens.operators.quantiles import exact_quantiles
from basketlens.session import Scratch, materialise

NEIGHBOURS = 5


def oversample(
    train: DataFrame, features: list[str], label: str, key: str, k: int = NEIGHBOURS, seed: int = 42, scratch: Scratch | None = None
) -> DataFrame:
    """``train`` plus synthetic rows of the smaller class until both classes are equal.

    A synthetic row lies between a row of the class and one of its ``k`` nearest rows of the class, all of which are searched.
    Every row gets the same number of synthetic rows, and the remainder goes to
    the rows with the smallest hashes, so the classes end exactly equal.  The result reads tables in ``scratch``, which the caller may drop when it has written the result.
    """
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count("*").alias("n")).collect()}
    kept = train.select(key, *features, label).withColumn("synthetic", F.lit(False))
    if len(counts) < 2 or len(set(counts.values())) == 1:
        return kept
    small = min(counts, key=counts.get)
    n, need = counts[small], max(counts.values()) - counts[small]
    each, rest = divmod(need, n)
    scratch = scratch or Scratch(train.sparkSession, "oversample")
    minority = scratch.write(train.where(F.col(label) == small).select(key, *features), "minority")
    hashed = minority.select(key_hash(F.col(key), f"extra-{seed}").alias("h"))
    limit = -1.0
    if rest:
        rank = 0.0 if n == 1 else (rest - 0.5) / (n - 1)
        limit = exact_quantiles(hashed, ["h"], [min(1.0, max(0.0, rank))])[0].values[0]
    copies = F.lit(each) + (key_hash(F.col(key), f"extra-{seed}") <= F.lit(limit)).cast("int")
    near, points = near_names(minority, key, features, k, scratch, wanted=minority.where(copies > 0))
    scratch.drop("minority")
    pick = F.concat_ws("/", F.col(key), F.col("copy"))
    # Written by itself, as numbers: the lists of neighbours are gone when the features of rows and picked ones are joined.
    picked = scratch.write(
        near.withColumn("copies", copies)
        .selectExpr(key, "point as of", "neighbours", "explode(sequence(1, copies)) as copy")
        .withColumn("u", key_uniform(pick, f"step-{seed}"))
        .withColumn("which", F.floor(key_uniform(pick, f"neighbour-{seed}") * F.size("neighbours")).cast("int") + 1)
        .selectExpr(
            f"concat({key}, '/', copy) as {key}",
            "of",
            "u",
            "if(size(neighbours) > 0, element_at(neighbours, which).point, null) as point",
        ),
        "picked",
    )
    scratch.drop("names", "first", "across")
    rows = picked.join(points.withColumnRenamed("point", "of"), "of")
    made = rows.join(points.withColumnRenamed("x", "found"), "point", "left").selectExpr(key, "x", "u", "coalesce(found, x) as other")
    synthetic = made.selectExpr(
        key,
        *[f"x[{i}] + u * (other[{i}] - x[{i}]) as {c}" for i, c in enumerate(features)],
        f"{small!r} as {label}",
        "true as synthetic",
    )
    doubles = kept.selectExpr(key, *[f"cast({c} as double) as {c}" for c in features], label, "synthetic")
    return doubles.unionByName(synthetic)


def between_neighbours(full: DataFrame, features: list[str], label: str, key: str, k: int = NEIGHBOURS) -> DataFrame:
    """Rows per class, and how many of them are synthetic and lie between their parent and one of its ``k`` nearest rows."""
    classes = full.where("synthetic").select(label).distinct()
    pool = full.where("not synthetic").join(F.broadcast(classes), label, "left_semi")
    scratch = Scratch(full.sparkSession, "between")
    made = full.where("synthetic").selectExpr(label, f"regexp_extract({key}, '^(.*)/', 1) as parent", "array(" + ", ".join(features) + ") as made")
    parents = pool.join(made.select(F.col("parent").alias(key)), key, "left_semi")
    near, points = near_names(pool, key, features, k, scratch, wanted=parents)
    near = scratch.write(near.selectExpr(f"{key} as parent", "point as of", "transform(neighbours, n -> n.point) as points"), "near")
    scratch.drop("names", "first", "across")
    # Numbered and written: a row meets the features of its parent's neighbours one by one, not as a list of all.
    found = made.join(near, "parent").join(points.withColumnRenamed("point", "of"), "of")
    joined = scratch.write(found.selectExpr("monotonically_increasing_id() as row", label, "made", "x", "points"), "joined")
    scratch.drop("near")
    pairs = joined.selectExpr("row", "explode(points) as point").join(points.withColumnRenamed("x", "n"), "point").select("row", "n")
    square = lambda a, b: f"aggregate(zip_with({a}, {b}, (p, q) -> (p - q) * (p - q)), 0.0D, (s, d) -> s + d)"
    hit = f"abs(sqrt({square('x', 'n')}) - sqrt({square('x', 'made')}) - sqrt({square('n', 'made')})) < 1e-6"
    hits = joined.join(pairs, "row").where(hit).select(label, "row").distinct()
    held = hits.groupBy(label).agg(F.count("*").alias("between"))
    sizes = full.groupBy(label).agg(F.count("*").alias("count"))
    # Two rows; the neighbours behind them are not kept.
    found = materialise(sizes.join(held, label, "left").select(label, "count", F.coalesce("between", F.lit(0).cast("bigint")).alias("between")), "between-counts")
    scratch.drop()
    return found

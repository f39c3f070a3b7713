"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.session import Scratch


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(v as decimal(38, 0)))")).first())


def connected_components(links: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """``node``, ``root`` (smallest node reachable) for every node of ``links`` (columns ``a`` and ``b``, bigint).

    Alternates two steps until nothing changes: every node hands its larger neighbours to its smallest neighbour, then
    its smaller ones.  Each step's table is written, so the plan does not grow and lost executors cost one step; minima per node
    are pre-aggregated, and both join inputs are plain shuffles that adaptive execution can split at a hub.
    Self-links, repeated links and nulls are ignored; no links give an empty table.
    """
    edges = scratch.write(
        links.where("a <> b").selectExpr("greatest(a, b) as u", "least(a, b) as v").distinct(), f"{name}-0"
    )
    before, step = _signature(edges), 0
    while True:
        both = edges.unionByName(edges.selectExpr("v as u", "u as v"))
        least = scratch.write(both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) as m"), f"{name}-{step}-a")
        large = scratch.write(both.join(least, "u").where("v > u").selectExpr("v as u", "m as v").distinct(), f"{name}-{step}-b")
        lowest = scratch.write(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-{step}-c")
        small = large.join(lowest, "u").where("v <> m").selectExpr("v as u", "m as v").unionByName(lowest.selectExpr("u", "m as v"))
        edges = scratch.write(small.distinct(), f"{name}-{step + 1}")
        scratch.drop(f"{name}-{step}", *(f"{name}-{step}-{k}" for k in "abc"))
        step += 1
        after = _signature(edges)
        if after == before:
            break
        before = after
    # Every node now points at its root; roots point nowhere.
    return edges.selectExpr("u as node", "v as root").unionByName(edges.selectExpr("v as node", "v as root").distinct())

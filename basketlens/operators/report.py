"""Grouped reports as declarations."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.measures import measure


@dataclass(frozen=True)
class Report:
    """Keys, measures and order of one report.

    ``keys`` are column names, or (name, expression) pairs for computed keys.
    ``order`` entries are column names, with a leading ``-`` for descending.
    ``hidden`` are aggregates used only for the order.
    """

    keys: list = field(default_factory=list)
    measures: list = field(default_factory=list)
    order: list = field(default_factory=list)
    where: str | None = None
    limit: int | None = None
    hidden: dict = field(default_factory=dict)
    decimals: dict = field(default_factory=dict)
    needs: list = field(default_factory=list)

    def key_names(self) -> list[str]:
        return [k if isinstance(k, str) else k[0] for k in self.keys]


def _order(entry: str) -> Column:
    return F.col(entry[1:]).desc() if entry.startswith("-") else F.col(entry).asc()


def run_report(orders: DataFrame, spec: Report) -> DataFrame:
    """Filter, partial and final hash aggregate, sort, optional top-k.

    Keys follow the stated order as a tie-break, so a limit is deterministic.
    """
    if spec.where:
        orders = orders.where(spec.where)
    keys = [F.col(k) if isinstance(k, str) else k[1]().alias(k[0]) for k in spec.keys]
    measures = [
        measure(m, spec.decimals.get(m)) if isinstance(m, str) else m[1]().alias(m[0]) for m in spec.measures
    ]
    hidden = [build().alias(name) for name, build in spec.hidden.items()]
    result = orders.groupBy(*keys).agg(*measures, *hidden)
    order = [_order(e) for e in spec.order]
    if order:
        named = {e.lstrip("-") for e in spec.order}
        order += [F.col(k) for k in spec.key_names() if k not in named]
        result = result.orderBy(*order)
    if spec.limit is not None:
        result = result.limit(spec.limit)
    return result.drop(*spec.hidden)

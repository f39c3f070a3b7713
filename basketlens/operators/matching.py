"""Propensity scores and nearest-score matching."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.operators.explore import histogram
from basketlens.operators.ranges import with_bucket
from basketlens.operators.skew import salted_left_join
from basketlens.operators.stats import t_test
from basketlens.session import materialise

TREATMENT, OUTCOME = "Discount_Used", "Return_Rate"
CONFOUNDERS = ["Age", "Income_Level", "Brand_Loyalty"]


def complete_rows(orders: DataFrame, confounders: list[str] = CONFOUNDERS) -> DataFrame:
    return orders.dropna(subset=[*confounders, TREATMENT, OUTCOME])


MOST_STEPS, LEAST_STEP = 25, 1e-12


def newton_weights(cells: DataFrame, width: int) -> list[float]:
    """Constant and weights of a logistic regression over ``cells`` (``x1`` to ``x<width>``, ``label``, ``n`` rows), L2 penalty of unit weight in all
    but the constant.

    Each Newton step is one aggregate over the cells: the gradient and the second derivatives, a handful of sums.  With rows of one
    label only, the constant would have no end: it stays where the last finite step has left it.
    """
    x = ["1.0D", *[f"x{i}" for i in range(1, width + 1)]]
    at = np.zeros(width + 1)
    for _ in range(MOST_STEPS):
        line = " + ".join(f"{float(w)!r}D * {c}" for w, c in zip(at, x))
        found = cells.selectExpr("*", f"1 / (1 + exp(-({line}))) as p").agg(
            *[F.expr(f"sum(n * (p - label) * {c})") for c in x],
            *[F.expr(f"sum(n * p * (1 - p) * {c} * {d})") for k, c in enumerate(x) for d in x[k:]],
        ).first()
        if found[0] is None:
            break
        slope, curve = np.array(found[: width + 1]), np.zeros((width + 1, width + 1))
        curve[np.triu_indices(width + 1)] = found[width + 1 :]
        curve = curve + np.triu(curve, 1).T
        slope[1:] += at[1:]
        curve[1:, 1:] += np.eye(width)
        if curve[0, 0] < 1e-9:
            break
        step = np.linalg.solve(curve, slope)
        at = at - step
        if np.abs(step).max() <= LEAST_STEP * (1 + np.abs(at).max()):
            break
    return at.tolist()


def propensity_scores(
    rows: DataFrame, confounders: list[str] = CONFOUNDERS, treatment: str = TREATMENT
) -> DataFrame:
    """Add ``Propensity_Score``: logistic regression of the treatment, L2 penalty of unit weight in all.

    Text confounders are coded in alphabetical order.  Rows with the same confounders and treatment are one cell: rows are read once, and the
    steps of the fit read the cells, which are written.
    """
    texts = [f.name for f in rows.schema if f.name in confounders and isinstance(f.dataType, T.StringType)]
    terms = list(confounders)
    if texts:
        indexer = StringIndexer(
            inputCols=texts, outputCols=[f"_code_{c}" for c in texts], stringOrderType="alphabetAsc"
        ).fit(rows)
        for name, labels in zip(texts, indexer.labelsArray):
            codes = ", ".join('"' + label.replace('"', '\\"') + '"' for label in labels)
            terms[terms.index(name)] = f"array_position(array({codes}), {name}) - 1"
    names = [f"x{i}" for i in range(1, len(terms) + 1)]
    coded = rows.selectExpr(f"int({treatment}) as label", *[f"double({t}) as {x}" for x, t in zip(names, terms)])
    cells = materialise(coded.groupBy("label", *names).agg(F.count("*").alias("n")), "cells")
    constant, *weights = newton_weights(cells, len(terms))
    # The fitted line as an expression: scoring stays in generated code.
    line = " + ".join(f"{float(w)!r}D * ({t})" for w, t in zip(weights, terms))
    return rows.withColumn("Propensity_Score", F.expr(f"1 / (1 + exp(-({constant!r}D + {line})))"))


def nearest_controls(
    rows: DataFrame, score: str, treatment: str = TREATMENT, outcome: str = OUTCOME, key: str = "Customer_ID",
    buckets: int | None = None,
) -> DataFrame:
    """Nearest control per distinct treated score: (score, treated_rows, match_score, control_id, control_outcome).

    Exact, with replacement.  Equal distances go to the lower score, equal
    scores to the lowest id.  Rows collapse to distinct scores first; the
    nearest control on each side is found inside range buckets, and the last
    and first control of the buckets around are carried over their borders.
    """
    distinct = rows.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(treatment) == 1).alias("treated_rows"),
        F.min(F.expr(f"if({treatment} = 0, struct({key} as id, {outcome} as outcome), null)")).alias("control"),
    )
    distinct = materialise(distinct.where("score is not null"), "scores")
    placed = with_bucket(distinct, "score", buckets).selectExpr(
        "*", "if(control is not null, struct(score, control), null) as side"
    )
    # One row per bucket.
    borders = (
        placed.groupBy("_bucket")
        .agg(F.min("side").alias("first_side"), F.max("side").alias("last_side"))
        .selectExpr(
            "_bucket",
            "last(last_side, true) over (order by _bucket rows between unbounded preceding and 1 preceding) as left_side",
            "last(first_side, true) over (order by _bucket desc rows between unbounded preceding and 1 preceding)"
            " as right_side",
        )
    )
    inside = "partition by _bucket order by score"
    sides = (
        placed.join(F.broadcast(borders), "_bucket")
        .selectExpr(
            "score",
            "treated_rows",
            f"coalesce(last(side, true) over ({inside} rows between unbounded preceding and current row), left_side)"
            " as below",
            f"coalesce(last(side, true) over ({inside} desc rows between unbounded preceding and current row),"
            " right_side) as above",
        )
        .where("treated_rows > 0")
    )
    return sides.selectExpr(
        "score",
        "treated_rows",
        "case when below is null then above when above is null then below"
        " when score - below.score <= above.score - score then below else above end as best",
    ).selectExpr(
        "score",
        "treated_rows",
        "best.score as match_score",
        "best.control.id as control_id",
        "best.control.outcome as control_outcome",
    )


def matched_pairs(
    rows: DataFrame, score: str, treatment: str = TREATMENT, outcome: str = OUTCOME, key: str = "Customer_ID",
    buckets: int | None = None,
) -> DataFrame:
    """One row per treated row with its matched control."""
    matches = materialise(nearest_controls(rows, score, treatment, outcome, key, buckets), "matches")
    treated = rows.where((F.col(treatment) == 1) & F.col(score).isNotNull()).select(
        key, F.col(score).cast("double").alias("score"), F.col(outcome).alias("outcome")
    )
    counts = matches.select("score", "treated_rows")
    return salted_left_join(
        treated, matches.drop("treated_rows"), counts, "score", "treated_rows", F.col(key)
    ).select(
        key, "score", "outcome", "control_id", "match_score", "control_outcome",
        F.abs(F.col("score") - F.col("match_score")).alias("distance"),
    )


def matched_sample(pairs: DataFrame, key: str = "Customer_ID") -> DataFrame:
    """Treated rows and their controls as one list; a control used twice appears twice.

    Both rows of a pair come from one pass over the pairs.
    """
    return pairs.selectExpr(
        f"inline(array(struct({key} as {key}, 1 as treated, score as score, outcome as outcome),"
        f" struct(control_id as {key}, 0 as treated, match_score as score, control_outcome as outcome)))"
    )


def matched_effect(pairs: DataFrame) -> DataFrame:
    """Mean outcome of the treated minus that of their controls, with a t-test."""
    test = t_test(matched_sample(pairs), "treated", "outcome")
    return test.selectExpr("*", "mean_yes - mean_no as effect")


def score_histograms(rows: DataFrame, pairs: DataFrame, score: str, treatment: str = TREATMENT) -> DataFrame:
    """Score histograms of 20 bins: treated and control before, treated and matched control after."""
    before = rows.select(
        F.expr(f"if({treatment} = 1, 'before_treated', 'before_control')").alias("series"),
        F.col(score).alias("score"),
    )
    after = matched_sample(pairs).selectExpr(
        "if(treated = 1, 'after_treated', 'after_control') as series", "score"
    )
    return histogram(before.unionByName(after), "score", 20, by="series")

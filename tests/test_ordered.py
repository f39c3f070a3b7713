"""Quantiles, ranks, matching and skewed joins against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.functions import probability
from basketlens.operators import classify, explore, matching, quantiles, stats
from basketlens.operators.quantiles import exact_quantiles
from basketlens.operators.skew import salted_left_join


def values(kind, n=20_000):
    source = random.Random(7)
    if kind == "spread":
        return [source.lognormvariate(0, 3) for _ in range(n)]
    if kind == "hot":
        return [5.0 if source.random() < 0.4 else source.gauss(0, 1) for _ in range(n)]
    if kind == "peaks":  # half beside zero, half beside a billion
        return [source.gauss(0, 1e-6) if i % 2 else 1e9 + source.random() * 1e-3 for i in range(n)]
    if kind == "signs":
        return [source.choice([-1e300, -5e-324, -0.0, 0.0, 5e-324, 1e300, -1.5, 1.5]) for _ in range(n)]
    return [float(source.randrange(4)) for _ in range(n)]


@pytest.mark.parametrize("kind", ["spread", "hot", "few", "peaks", "signs"])
@pytest.mark.parametrize("n", [20_000, 37, 2])
def test_quantiles_equal_numpy(spark, kind, n):
    data = values(kind, n)
    df = spark.createDataFrame([(v, "ab"[i // 2 % 2] if n > 2 else "a") for i, v in enumerate(data)], "v double, g string").repartition(7)
    wanted = [0.0, 0.01, 0.25, 0.5, 1 / 3, 0.99, 1.0]
    got = exact_quantiles(df, ["v"], wanted, by="g")
    assert got
    for q in got:
        part = [v for i, v in enumerate(data) if ("ab"[i // 2 % 2] if n > 2 else "a") == q.by]
        assert q.n == len(part)
        assert q.values == pytest.approx(list(np.quantile(part, wanted)), rel=1e-12)


def test_ranks_never_order_rows(spark, monkeypatch):
    """Whatever the values, the window runs over prefixes: at most 65,536 rows for each group, column and prefix above."""
    rows = spark.createDataFrame([(v,) for v in values("peaks", 5000)], "v double")
    with quantiles.narrowed(rows, ["v"]) as narrow:
        keys = narrow.select("by", quantiles.sort_key(F.col("c0")).alias("b0")).selectExpr("by", f"{quantiles.ordered_bits('b0')} as key0")
        assert keys.selectExpr("shiftright(key0, 48) as p").distinct().count() < 400
        inside = keys.selectExpr("shiftright(key0, 32) as p", "shiftright(key0, 48) as above").distinct().groupBy("above").count()
        assert inside.agg(F.max("count")).first()[0] <= 1 << 16
        plan = []
        original = type(narrow).collect
        monkeypatch.setattr(type(narrow), "collect", lambda df: plan.append(df._jdf.queryExecution().executedPlan().toString()) or original(df))
        quantiles.ranked(narrow, 1, [0.5])
    assert plan and all("HashAggregate" in p and "ObjectHashAggregate" not in p and "percentile" not in p for p in plan)


def test_quantiles_of_several_columns_skip_nulls(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 5.0), (4.0, 7.0)], "a double, b double")
    got = {q.variable: q.values for q in exact_quantiles(df, ["a", "b"], [0.5])}
    assert got == {"a": [2.0], "b": [6.0]}
    assert exact_quantiles(df.where("a > 9"), ["a"], [0.5]) == []


def test_box_stats(spark):
    data = [1.0, 2.0, 3.0, 4.0, 100.0]
    row = explore.box_stats(spark.createDataFrame([(v,) for v in data], "v double"), "v").first()
    assert (row.q1, row.median, row.q3) == (2.0, 3.0, 4.0)
    assert (row.whisker_low, row.whisker_high, row.outliers, row.n) == (1.0, 4.0, 1, 5)


@pytest.mark.parametrize("buckets", [2, 8, 64])
@pytest.mark.parametrize("distinct", [6, 900])
def test_rank_test_equals_brute_force(spark, buckets, distinct):
    source = random.Random(distinct)
    rows = [(source.randrange(2), float(source.randrange(distinct))) for _ in range(700)]
    got = stats.mann_whitney(spark.createDataFrame(rows, "g int, v double"), "g", "v", buckets).first()
    xs, ys = [v for g, v in rows if g], [v for g, v in rows if not g]
    u = sum((x > y) + 0.5 * (x == y) for x in xs for y in ys)
    assert got.u_statistic == u and (got.n_yes, got.n_no) == (len(xs), len(ys))
    assert 0 <= got.p_value <= 1


def test_rank_test_with_all_values_tied(spark):
    rows = [(i % 2, 3.0) for i in range(10)]
    assert stats.mann_whitney(spark.createDataFrame(rows, "g int, v double"), "g", "v").first().u_statistic == 12.5


def test_tail_probabilities():
    assert probability.normal_two_sided(1.959963984540054) == pytest.approx(0.05, abs=1e-12)
    # Table values of the t distribution.
    for t, df, p in [(12.706204736, 1, 0.05), (2.228138852, 10, 0.05), (2.660283, 60, 0.01), (1.959966, 10**7, 0.05)]:
        assert probability.student_two_sided(t, df) == pytest.approx(p, rel=1e-5)
    assert probability.student_two_sided(0.0, 5) == pytest.approx(1.0)
    for power in range(4, 14):
        assert probability.student_two_sided(1.959963984540054, 10.0**power) == pytest.approx(
            0.05 + 0.27733 / 10.0**power, abs=1e-9 if power > 4 else 1e-7)


def test_group_tests_with_an_empty_arm(spark):
    df = spark.createDataFrame([(1, 3.0), (1, 4.0)], "g int, v double")
    rank, mean = stats.mann_whitney(df, "g", "v").first(), stats.t_test(df, "g", "v").first()
    assert (rank.n_yes, rank.n_no, rank.mean_no, rank.p_value) == (2, 0, None, None)
    assert (mean.n_yes, mean.n_no, mean.p_value) == (2, 0, None)


def test_null_keys_do_not_meet_in_one_task(spark):
    df = spark.range(80_000).selectExpr("id", "if(id % 4 = 0, id, null) as k").repartition(8)
    counts = df.groupBy("k").agg(F.count("*").alias("n"))
    dim = counts.where("k is not null").selectExpr("k", "n")
    joined = salted_left_join(df, dim, counts.withColumnRenamed("n", "m"), "k", "m", F.col("id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 80_000 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_t_test_and_effect_size(spark):
    rows = [(1, 3.0), (1, 5.0), (1, 7.0), (0, 2.0), (0, 2.0), (0, 5.0)]
    df = spark.createDataFrame(rows, "g int, v double")
    got, pooled = stats.t_test(df, "g", "v").first(), 3.5
    assert got.t_statistic == pytest.approx(2.0 / math.sqrt(pooled * 2 / 3)) and got.degrees == 4
    assert stats.cohens_d(df, "g", "v").first().cohens_d == pytest.approx(2.0 / math.sqrt(pooled))


def test_normality_statistic(spark):
    data = values("hot", 400)
    got = stats.normality(spark.createDataFrame([(v,) for v in data], "v double"), "v").first()
    mean, sd, n = np.mean(data), np.std(data, ddof=1), len(data)
    cdf = [0.5 * math.erfc(-(v - mean) / sd / math.sqrt(2)) for v in sorted(data)]
    distance = max(max((i + 1) / n - c, c - i / n) for i, c in enumerate(cdf))
    assert got.ks_statistic == pytest.approx(distance, abs=1e-9)


@pytest.mark.parametrize("buckets", [2, 8, 64])
@pytest.mark.parametrize("scores", ["tied", "distinct", "hot"])
def test_nearest_match_equals_brute_force(spark, buckets, scores):
    source = random.Random(f"{buckets}{scores}")
    draw = {
        "tied": lambda: source.randrange(30) / 32.0,
        "distinct": source.random,
        "hot": lambda: 0.5 if source.random() < 0.4 else source.random(),
    }[scores]
    rows = [(f"{i:04d}", int(source.random() < 0.6), source.randrange(5), draw()) for i in range(600)]
    df = spark.createDataFrame(rows, "Customer_ID string, Discount_Used int, Return_Rate int, score double")
    got = {r.Customer_ID: r for r in matching.matched_pairs(df, "score", buckets=buckets).collect()}
    controls = [(s, i, y) for i, t, y, s in rows if not t]
    treated = [(i, s, y) for i, t, y, s in rows if t]
    assert set(got) == {i for i, _, _ in treated}
    for i, s, y in treated:
        score, control, outcome = min(controls, key=lambda c: (abs(c[0] - s), c[0], c[1]))
        assert (got[i].match_score, got[i].control_id) == (score, control)
        assert (got[i].outcome, got[i].control_outcome) == (y, outcome)


def test_matching_with_controls_on_one_side_only(spark):
    rows = [("a", 1, 1, 0.9), ("b", 1, 2, 0.8), ("c", 0, 3, 0.1), ("d", 0, 4, 0.1)]
    df = spark.createDataFrame(rows, "Customer_ID string, Discount_Used int, Return_Rate int, score double")
    assert {r.control_id for r in matching.matched_pairs(df, "score").collect()} == {"c"}
    effect = matching.matched_effect(matching.matched_pairs(df, "score")).first()
    assert effect.effect == pytest.approx(1.5 - 3.0)


def test_propensity_equals_newton_solution(spark):
    source = random.Random(3)
    rows = []
    for i in range(800):
        age, income = source.randrange(18, 71), source.choice(["High", "Low", "Middle"])
        loyal = source.randrange(1, 6)
        rows.append((str(i), age, income, loyal, int(source.random() < 1 / (1 + math.exp(-(loyal - 3) / 2)))))
    df = spark.createDataFrame(
        rows, "Customer_ID string, Age int, Income_Level string, Brand_Loyalty int, Discount_Used int")
    got = {r.Customer_ID: r.Propensity_Score for r in matching.propensity_scores(df).collect()}
    code = {"High": 0, "Low": 1, "Middle": 2}
    x = np.array([[1.0, r[1], code[r[2]], r[3]] for r in rows])
    y, w, ridge = np.array([r[4] for r in rows]), np.zeros(4), np.diag([0.0, 1, 1, 1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (p - y) + ridge @ w)
    p = 1 / (1 + np.exp(-x @ w))
    assert max(abs(got[r[0]] - q) for r, q in zip(rows, p)) < 1e-4


def test_hot_key_is_spread_and_nothing_lost(spark):
    rows = [(i, 1 if i < 3000 else i) for i in range(6000)] + [(9999, None)]
    df = spark.createDataFrame(rows, "id long, k long")
    counts = df.groupBy("k").agg(F.count("*").alias("n"))
    dim = counts.where("k is not null and k % 2 = 1").selectExpr("k", "n", "k * 10 as payload")
    joined = salted_left_join(df, dim, counts, "k", "n", F.col("id"), rows_per_task=100)
    assert joined.count() == len(rows)
    for r in joined.collect():
        assert r.payload == (r.k * 10 if r.k is not None and r.k % 2 == 1 else None)


def test_roc_equals_brute_force(spark):
    source = random.Random(5)
    rows = [(source.randrange(2), source.randrange(40) / 40.0) for _ in range(500)]
    df = spark.createDataFrame(rows, "High_Satisfaction int, score double")
    got = sorted(tuple(r) for r in classify.roc_points(df, buckets=8).collect())
    p = sum(y for y, _ in rows)
    for threshold, fpr, tpr in got:
        assert tpr == pytest.approx(sum(y for y, s in rows if s >= threshold) / p)
        assert fpr == pytest.approx(sum(1 - y for y, s in rows if s >= threshold) / (len(rows) - p))
    assert len(got) == len({s for _, s in rows}) + 1


def test_correlation_is_pairwise(spark):
    df = spark.createDataFrame([(1, 2, None), (2, 4, 1), (3, 7, 0), (None, 1, 5)], "a int, b int, c int")
    got = {(r.column_a, r.column_b): r.r for r in explore.correlations(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 7])[0, 1])
    assert got["c", "b"] == got["b", "c"] == pytest.approx(np.corrcoef([1, 0, 5], [4, 7, 1])[0, 1])
    assert got["a", "a"] == 1.0


@pytest.mark.parametrize("kind, n, normal", [("gauss", 3000, True), ("uniform", 3000, False), ("gauss", 60, True), ("skew", 60, False)])
def test_normality(spark, kind, n, normal):
    source = random.Random(5)
    draw = {"gauss": lambda: source.gauss(10, 3), "uniform": source.random, "skew": lambda: source.lognormvariate(0, 1)}[kind]
    data = sorted(draw() for _ in range(n))
    row = stats.normality(spark.createDataFrame([(v,) for v in data] + [(None,)], "v double"), "v", buckets=9).first()
    mean, sd = np.mean(data), np.std(data, ddof=1)
    share = [0.5 * math.erfc(-(v - mean) / sd / 2**0.5) for v in data]
    distance = max(max((k + 1) / n - s, s - k / n) for k, s in enumerate(share))
    assert row.n == n and row.ks_statistic == pytest.approx(distance, abs=1e-12) and row.normal is normal


def test_normality_of_nothing(spark):
    for data in ([], [(1.0,)], [(2.0,)] * 9):
        row = stats.normality(spark.createDataFrame(data, "v double"), "v").first()
        assert row.n == len(data) and row.ks_statistic is None and row.normal is None

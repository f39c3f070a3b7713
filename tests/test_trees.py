"""Boosting and forests over binned rows, against Spark's own."""

import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from basketlens.operators import classify, trees
from basketlens.session import Scratch

FEATURES = ["a", "b", "c", "d"]


def table(spark, n=1500):
    """Features of few values, so that both libraries see the same splits."""
    source, rows = random.Random(11), []
    for i in range(n):
        a, b, c, d = source.randrange(20), source.randrange(4), source.choice([-1.5, 0.0, 0.5, 2.0]), source.randrange(2)
        rows.append((str(i), float(a), float(b), c, float(d), int(a + 3 * b * d + 2 * c + source.gauss(0, 3) > 12)))
    return spark.createDataFrame(rows, "Customer_ID string, a double, b double, c double, d double, High_Satisfaction int").repartition(3)


def blocks_of(spark, rows):
    return trees.binned(rows, FEATURES, classify.TARGET, classify.KEY, 32, Scratch(spark, "blocks"))


def probabilities(model, rows):
    return {r[0]: r[1] for r in model.transform(rows).select(classify.KEY, vector_to_array("probability")[1]).collect()}


def test_boosted_trees_are_those_of_the_library(spark, monkeypatch):
    """Over several written states, deep nodes of single rows among them; the model is Spark's own class, with its parameters."""
    monkeypatch.setattr(trees, "SAVED_TREES", 3)
    rows = table(spark)
    vectors = classify.assemble(rows, FEATURES).cache()
    estimator = GBTClassifier(labelCol=classify.TARGET, maxIter=8, maxDepth=6, stepSize=0.3, seed=1)
    own, library = trees.boosted(estimator, blocks_of(spark, rows)), estimator.fit(vectors)
    assert type(own) is GBTClassificationModel and own.getStepSize() == 0.3 and own.treeWeights == library.treeWeights
    truth = probabilities(library, vectors)
    assert len(truth) == 1500 and probabilities(own, vectors) == pytest.approx(truth, abs=1e-9)
    assert own.totalNumNodes == library.totalNumNodes
    vectors.unpersist()


def test_a_single_tree_of_the_forest_splits_as_the_library(spark, monkeypatch):
    """With every row drawn once and all features at hand, a tree is the library's decision tree, pruned alike."""
    from pyspark.ml.classification import DecisionTreeClassifier

    rows = table(spark)
    vectors = classify.assemble(rows, FEATURES).cache()
    monkeypatch.setattr(trees, "POISSON", np.ones(1 << 16, np.uint8))
    own = trees.forest(RandomForestClassifier(labelCol=classify.TARGET, numTrees=1, maxDepth=7, seed=3), blocks_of(spark, rows))
    library = DecisionTreeClassifier(labelCol=classify.TARGET, maxDepth=7).fit(vectors)
    assert probabilities(own, vectors) == pytest.approx(probabilities(library, vectors), abs=1e-9)
    assert own.totalNumNodes == library.numNodes
    assert list(own.featureImportances.toArray()) == pytest.approx(list(library.featureImportances.toArray()), abs=1e-9)
    vectors.unpersist()


def test_forest_is_as_good_as_the_library(spark, monkeypatch):
    """Held in parts: some trees at a time."""
    monkeypatch.setattr(trees, "MOST_HELD", 20_000)
    rows = table(spark)
    vectors = classify.assemble(rows, FEATURES).cache()
    estimator = RandomForestClassifier(labelCol=classify.TARGET, numTrees=20, maxDepth=5, seed=42)
    own, library = (classify.evaluate("f", m, vectors) for m in (trees.forest(estimator, blocks_of(spark, rows)), estimator.fit(vectors)))
    assert own.auc > 0.9 and abs(own.auc - library.auc) < 0.02
    again = trees.forest(estimator, blocks_of(spark, rows.repartition(5)))
    assert probabilities(own.model, vectors) == probabilities(again, vectors)
    vectors.unpersist()


def test_a_tree_draws_each_row_once_on_average():
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 100_000, dtype=np.uint64)
    one, other = (trees._drawn(hashes, 42, t) for t in (0, 1))
    shares = Counter(one.tolist())
    assert [shares[k] / 1e5 for k in range(3)] == pytest.approx([0.3679, 0.3679, 0.1839], abs=0.01)
    assert abs(np.corrcoef(one, other)[0, 1]) < 0.02


def test_splits_come_from_all_rows(spark):
    """One row among 60,000 has a value of its own, which a sample would miss; many values give exact quantiles."""
    rows = spark.range(60_000).selectExpr("double(if(id = 31000, 7, id % 2)) as rare", "double(id) as wide", "1.0D as same")
    rare, wide, same = trees.candidate_splits(rows, ["rare", "wide", "same"], 32)
    assert rare == [0.5, 4.0] and same == []
    assert wide == pytest.approx([59_999 * i / 32 for i in range(1, 32)])


def test_blocks_hold_every_row_once(spark):
    rows = table(spark)
    blocks = blocks_of(spark, rows)
    assert blocks.rows == 1500 and blocks.widths == [20, 4, 4, 2]
    held = Counter()
    for r in blocks.table.collect():
        x = np.frombuffer(r.x, np.uint8).reshape(4, r.n)
        held.update(zip(*x.tolist(), np.frombuffer(r.y, np.uint8).tolist()))
    levels = [{v: k for k, v in enumerate(sorted(values))} for values in (range(20), range(4), (-1.5, 0.0, 0.5, 2.0), range(2))]
    assert held == Counter((*(levels[k][r[c]] for k, c in enumerate(FEATURES)), r[classify.TARGET]) for r in rows.collect())


def test_training_fits_trees_on_binned_rows_once(spark, monkeypatch):
    monkeypatch.setattr(classify, "FEATURES", FEATURES)
    made, binned = [], trees.binned
    monkeypatch.setattr(trees, "binned", lambda *a: made.append(1) or binned(*a))
    rows = classify.assemble(table(spark), FEATURES)
    small = {"labelCol": classify.TARGET, "maxDepth": 3}
    estimators = {
        "Logistic Regression": LogisticRegression(labelCol=classify.TARGET),
        "Random Forest": RandomForestClassifier(**small, numTrees=5, seed=1), "Gradient Boosting": GBTClassifier(**small, maxIter=3)}
    training = classify.Training(None, rows, None, rows, estimators, {})
    assert len(made) == 0 and all(f.auc > 0.85 for f in training.compare()) and len(made) == 1


def test_evaluation_scores_every_row_once(spark):
    """Both measures read written scores."""
    calls = spark.sparkContext.accumulator(0)

    def score(x):
        calls.add(1)
        return float(x)

    rows = spark.range(100).selectExpr("string(id) as Customer_ID", "int(id % 2) as High_Satisfaction", "id")
    by = F.udf(score, "double")
    model = SimpleNamespace(transform=lambda r: r.withColumn("rawPrediction", by("id")).withColumn("prediction", F.col("High_Satisfaction").cast("double")))
    fitted = classify.evaluate("m", model, rows)
    assert fitted.f1 == 1.0 and calls.value == 100

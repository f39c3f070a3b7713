"""Properties of segmentation, oversampling, the classifier and attribution."""

import os
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from basketlens.operators import attribution, classify, segment
from basketlens.operators.neighbours import near_names, near_neighbours
from basketlens.operators.oversample import oversample
from basketlens.session import FREED, Scratch, materialise, scratch_path


def gaussian_rfm(spark):
    source = random.Random(1)
    centres = [(10, 2, 50.0), (300, 5, 400.0), (40, 20, 900.0), (200, 30, 100.0)]
    rows = [
        (g, source.gauss(a, 3), source.gauss(b, 0.5), source.gauss(c, 10))
        for g, (a, b, c) in enumerate(centres) for _ in range(250)
    ]
    return spark.createDataFrame(rows, "truth int, Recency double, Frequency_of_Purchase double, Purchase_Amount double")


def test_segments_recover_groups_and_survive_saving(spark):
    rows = gaussian_rfm(spark)
    model = segment.fit_segments(rows, k=4)
    pairs = model.transform(rows).select("truth", "Cluster").distinct().collect()
    assert len(pairs) == 4 and len({r.Cluster for r in pairs}) == 4
    path = scratch_path(spark, "segment-test")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(rows).select("truth", "Cluster").distinct().collect()
    assert sorted(again) == sorted(pairs)
    projected = segment.projection(model.transform(rows))
    assert {"PC1", "PC2"} <= set(projected.columns)


def test_inertia_falls_with_k(spark):
    found = segment.sweep(gaussian_rfm(spark), ks=range(2, 5), starts=2).orderBy("k").collect()
    assert found[0].inertia > found[1].inertia > found[2].inertia
    assert found[2].silhouette > 0.9


def test_one_cluster_winning_everything_is_loyal(spark):
    rows = [(0, 9.0, 9.0, 9.0), (1, 1.0, 1.0, 1.0)]
    profiles = spark.createDataFrame(
        rows, "Cluster int, Recency double, Frequency_of_Purchase double, Purchase_Amount double")
    got = {r.Cluster: r.Segment_Name for r in segment.segment_names(profiles).collect()}
    assert got == {0: "Loyal Customers", 1: "Potential Loyalist"}


def test_recency_counts_whole_days(spark):
    import datetime as dt

    rows = [("a", dt.datetime(2024, 1, 3, 12)), ("b", dt.datetime(2024, 1, 1, 13)), ("c", None)]
    got = segment.add_recency(spark.createDataFrame(rows, "id string, Time_of_Purchase timestamp_ntz")).collect()
    assert {r.id: r.Recency for r in got} == {"a": 1, "b": 2, "c": None}


def imbalanced(spark, n=400, share=0.2, copies=False):
    source = random.Random(2)
    rows = []
    for i in range(n):
        y = int(source.random() < share)
        point = (1.0, 1.0, 1.0) if copies and y and i % 3 else tuple(source.gauss(y, 1) for _ in range(3))
        rows.append((str(i), *point, y))
    return spark.createDataFrame(rows, "Customer_ID string, a double, b double, c double, High_Satisfaction int")


@pytest.mark.parametrize("copies", [False, True])
def test_oversampling(spark, copies):
    train = imbalanced(spark, copies=copies)
    features = ["a", "b", "c"]
    full = oversample(train, features, "High_Satisfaction", "Customer_ID").cache()
    sizes = {r.High_Satisfaction: r["count"] for r in classify.class_counts(full).collect()}
    assert sizes[0] == sizes[1]
    assert full.select("Customer_ID").distinct().count() == full.count()
    assert full.where("not synthetic").count() == train.count()
    # Each synthetic row lies on the segment from its parent to another minority row.
    minority = [tuple(r[f] for f in features) for r in train.where("High_Satisfaction = 1").collect()]
    by_id = {r.Customer_ID: tuple(r[f] for f in features) for r in train.collect()}
    for r in full.where("synthetic").collect():
        parent, made = by_id[r.Customer_ID.split("/")[0]], tuple(r[f] for f in features)
        assert any(on_segment(parent, other, made) for other in minority)
    full.unpersist()


def on_segment(a, b, p):
    length = sum((y - x) ** 2 for x, y in zip(a, b)) ** 0.5
    via = sum((y - x) ** 2 for x, y in zip(a, p)) ** 0.5 + sum((y - x) ** 2 for x, y in zip(b, p)) ** 0.5
    return abs(length - via) < 1e-9


@pytest.mark.parametrize("width, partitions, cell", [(3, 4, 40), (19, 4, 60), (19, 64, 60), (2, 8, 5), (19, 8, 5000)])
def test_near_neighbours_are_the_nearest(spark, width, partitions, cell):
    """Against all pairs: single points, points that many rows share, and ties on a grid, over many cells and over one."""
    source, features = random.Random(6), [f"x{i}" for i in range(width)]
    table = [(str(i), *(source.gauss(0, 1) for _ in features)) for i in range(500)]
    table += [(str(500 + i), *([1.5] * width)) for i in range(40)]
    table += [(str(600 + i), *(float(source.randrange(2)) if j < 4 else -0.0 for j in range(width))) for i in range(150)]
    table += [("far", *([1e6] * width)), ("farther", *([1e9] * width))]
    rows = spark.createDataFrame(table, "Customer_ID string, " + ", ".join(f"{f} double" for f in features)).repartition(partitions)
    points = {r[0]: np.array(r[1:]) for r in table}
    names, matrix = list(points), np.array(list(points.values()))
    got = near_neighbours(rows, "Customer_ID", features, 5, Scratch(spark, "t"), cell_rows=cell).collect()
    assert len(got) == len(table)
    for r in got:
        truth = sorted((float(d), i) for d, i in zip(((matrix - points[r.Customer_ID]) ** 2).sum(axis=1), names) if i != r.Customer_ID)
        assert [(n.distance, n.id) for n in r.neighbours] == truth[:5]
        assert all((np.array(n.x) == points[n.id]).all() for n in r.neighbours)


def test_found_neighbours_travel_without_features(spark):
    """Fifty features: what is written of the neighbours takes less than the points themselves, where six copies of them took more."""
    source, features = random.Random(4), [f"x{i}" for i in range(50)]
    table = [(str(i), *(source.random() for _ in features)) for i in range(400)]
    scratch = Scratch(spark, "t")
    near_neighbours(spark.createDataFrame(table, "id string, " + ", ".join(f"{f} double" for f in features)), "id", features, 5, scratch, cell_rows=100)
    folder = Path(scratch.root.removeprefix("file:"))
    points, best = (sum(p.stat().st_size for p in (folder / name).rglob("*.parquet")) for name in ("points", "best"))
    assert best < 2 * points


def test_neighbours_of_some_rows_are_of_all(spark):
    """Rows that are wanted alone get the neighbours that they have among all, by the numbers of their points."""
    source = random.Random(5)
    rows = spark.createDataFrame([(str(i), source.random(), float(i % 3)) for i in range(200)] + [("same", 0.5, 1.0), ("as", 0.5, 1.0)], "id string, a double, b double")
    scratch = Scratch(spark, "t")
    whole = {r.id: [(n.id, n.x) for n in r.neighbours] for r in near_neighbours(rows, "id", ["a", "b"], 5, Scratch(spark, "t"), cell_rows=20).collect()}
    some, points = near_names(rows, "id", ["a", "b"], 5, scratch, cell_rows=20, wanted=rows.where("id in ('7', '8', 'as')"))
    at = {r.point: r.x for r in points.collect()}
    assert len(whole) == 202
    assert {r.id: [(n.id, at[n.point]) for n in r.neighbours] for r in some.collect()} == {k: whole[k] for k in ("7", "8", "as")}


def test_few_rows_have_few_neighbours(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0)], "id string, x double")
    got = {r.id: [n.id for n in r.neighbours] for r in near_neighbours(rows, "id", ["x"], 5, Scratch(spark, "t"), cell_rows=1).collect()}
    assert got == {"a": ["b", "c"], "b": ["c", "a"], "c": ["b", "a"]}
    assert near_neighbours(rows.limit(0), "id", ["x"], 5, Scratch(spark, "t")).collect() == []


def test_neighbours_take_narrow_tasks(spark):
    """A point that most rows share stays one point; second passes go to near cells only."""
    source = random.Random(3)
    table = [(str(i), float(i % 20) * 100 + source.random(), source.random()) for i in range(2000)] + [(f"c{i}", 5.0, 5.0) for i in range(3000)]
    scratch = Scratch(spark, "t")
    near_neighbours(spark.createDataFrame(table, "id string, a double, b double"), "id", ["a", "b"], 5, scratch, cell_rows=50)
    points, visits = (spark.read.parquet(f"{scratch.root}/{name}") for name in ("points", "visits"))
    assert points.count() == 2001 and points.selectExpr("max(size(ids))").first()[0] == 6
    assert visits.count() < 2001 * 5  # of 41 cells


def test_neighbours_send_a_cell_once_to_its_visitors(spark, monkeypatch):
    """A few wide features beside many narrow ones, as the classifier has them: a point goes to few cells, and no cell is copied for each cell that asks."""
    from pyspark.sql.pandas.group_ops import PandasGroupedOpsMixin

    sent, cogroup = [], PandasGroupedOpsMixin.cogroup
    monkeypatch.setattr(PandasGroupedOpsMixin, "cogroup", lambda asked, held: (sent.append(held._df.count()), cogroup(asked, held))[1])
    source, tops = random.Random(8), [53, 25, 20, 12, *[3] * 15]
    features = [f"x{i}" for i in range(len(tops))]
    table = [(str(i), *(float(source.randrange(t)) for t in tops)) for i in range(3000)]
    scratch = Scratch(spark, "t")
    rows = spark.createDataFrame(table, "id string, " + ", ".join(f"{f} double" for f in features))
    near_neighbours(rows, "id", features, 5, scratch, cell_rows=150)
    assert spark.read.parquet(f"{scratch.root}/visits").count() < 3000 * 16  # of 20 cells
    assert sent and sent[0] <= 3000


def test_split_is_disjoint_complete_and_stratified(spark):
    rows = imbalanced(spark, n=1000)
    marked = classify.mark_split(rows)
    assert marked.count() == 1000
    for r in marked.groupBy("High_Satisfaction").agg(
        F.count("*").alias("n"), F.count_if("in_train").alias("t")).collect():
        assert abs(r.t - 0.8 * r.n) <= 1
    again = classify.mark_split(rows.repartition(5))
    assert marked.select("Customer_ID", "in_train").exceptAll(again.select("Customer_ID", "in_train")).count() == 0


def test_codes_are_alphabetical_and_unseen_is_zero(spark):
    fitted = classify.fit_encoder(
        spark.createDataFrame([("1", "b", 1), ("2", "a", 0), ("3", "c", 0)], "Customer_ID string, p string, High_Satisfaction int"),
        ["p"])
    fresh = spark.createDataFrame([("4", "c"), ("5", "Fax"), ("6", "b")], "Customer_ID string, p string")
    assert {r.Customer_ID: r.p for r in classify.encode(fitted, fresh).collect()} == {"4": 2.0, "5": 0.0, "6": 1.0}


def learnable(spark):
    source = random.Random(4)
    rows = []
    for i in range(800):
        a, b, c = (source.gauss(0, 1) for _ in range(3))
        rows.append((str(i), a, b, c, int(a + b + source.gauss(0, 0.5) > 1.2)))
    return spark.createDataFrame(rows, "Customer_ID string, a double, b double, c double, High_Satisfaction int")


def test_model_quality_importance_and_report(spark):
    rows = classify.assemble(learnable(spark), ["a", "b", "c"]).cache()
    model = LogisticRegression(labelCol="High_Satisfaction").fit(rows)
    fitted = classify.evaluate("lr", model, rows)
    assert fitted.auc > 0.9
    scored = classify.score_column(model.transform(rows)).cache()
    report = {r["class"]: r for r in classify.classification_report(scored).collect()}
    assert report["1"].f1 == pytest.approx(fitted.f1)
    assert report["accuracy"].support == 800
    assert classify.importances(model, ["a", "b", "c"], spark, 2).first().feature in ("a", "b")
    points = sorted((r.fpr, r.tpr) for r in classify.roc_points(scored).collect())
    area = sum((x2 - x1) * (y1 + y2) / 2 for (x1, y1), (x2, y2) in zip(points, points[1:]))
    assert area == pytest.approx(fitted.auc, abs=1e-6)


def test_attribution_sums_to_difference(spark):
    features = ["a", "b", "c"]
    rows = classify.assemble(learnable(spark), features)
    model = LogisticRegression(labelCol="High_Satisfaction").fit(rows)
    base = attribution.baseline(rows, features)
    phi = attribution.attributions(model, rows, base, features).cache()
    start = attribution.probability_at(model, spark, base)
    ends = {r.Customer_ID: r.score for r in classify.score_column(model.transform(rows)).collect()}
    for r in phi.groupBy("Customer_ID").agg(F.sum("phi").alias("total")).collect():
        assert start + r.total == pytest.approx(ends[r.Customer_ID], abs=1e-9)
    assert phi.agg(F.max("std_error")).first()[0] <= attribution.STANDARD_ERROR
    assert [r.feature for r in attribution.global_importance(phi).collect()][-1] == "c"
    assert attribution.breakdown(phi, "0", start).count() == 3


class Linear:
    """A model whose probability is a line: every order gives the same attributions."""

    weights = [0.02, -0.03, 0.05]

    def transform(self, rows):
        from pyspark.ml.functions import array_to_vector, vector_to_array

        x = vector_to_array("features")
        p = F.lit(0.5) + sum(w * x[k] for k, w in enumerate(self.weights))
        return rows.withColumn("probability", array_to_vector(F.array(1 - p, p)))


def test_attribution_is_exact_on_a_line(spark):
    features, base = ["a", "b", "c"], [0.1, 0.2, 0.3]
    rows = learnable(spark).limit(40)
    truth = {(r.Customer_ID, f): w * (r[f] - b) for r in rows.collect() for f, w, b in zip(features, Linear.weights, base)}
    got = {(r.Customer_ID, r.feature): r for r in attribution.attributions(Linear(), rows, base, features).collect()}
    assert set(got) == set(truth)
    for k, r in got.items():
        assert r.phi == pytest.approx(truth[k], abs=1e-12) and r.std_error < 1e-7


class Product(Linear):
    """Features that work together: their orders differ."""

    def transform(self, rows):
        from pyspark.ml.functions import array_to_vector, vector_to_array

        x = vector_to_array("features")
        p = F.lit(0.5) + 0.1 * x[0] * x[1] * x[2]
        return rows.withColumn("probability", array_to_vector(F.array(1 - p, p)))


def test_attribution_draws_until_its_error_is_small(spark):
    """Against all orders: within a few of the stated errors, which a tighter bound makes smaller."""
    from itertools import permutations

    features, base = ["a", "b", "c"], [1.0, 1.0, 1.0]
    table = [("1", 2.0, 3.0, -1.0), ("2", 1.0, 1.0, 1.0), ("3", -2.0, 2.0, 2.0)]
    rows = spark.createDataFrame(table, "Customer_ID string, a double, b double, c double")
    truth = {}
    for key, *x in table:
        for order in permutations(range(3)):
            point, before = list(base), 0.5 + 0.1
            for j in order:
                point[j] = x[j]
                after = 0.5 + 0.1 * point[0] * point[1] * point[2]
                truth[key, features[j]] = truth.get((key, features[j]), 0.0) + (after - before) / 6
                before = after
    got = attribution.attributions(Product(), rows, base, features, error=0.06).collect()
    assert len(got) == 9 and all(r.std_error <= 0.06 for r in got)
    for r in got:
        assert abs(r.phi - truth[r.Customer_ID, r.feature]) <= 5 * r.std_error + 1e-9


def test_masks_of_boosted_trees_draw_what_the_model_scores(spark):
    """Sums over draws of several orders against a prediction for every prefix; rows with the same key count together."""
    from pyspark.ml.classification import GBTClassifier

    features = ["a", "b", "c"]
    rows = classify.assemble(learnable(spark), features)
    model = GBTClassifier(labelCol="High_Satisfaction", maxIter=8, maxDepth=6, stepSize=0.3, seed=1).fit(rows)
    few, base = rows.where("int(Customer_ID) < 40").drop("features"), [0.1, -0.2, 0.3]
    masks = attribution.tree_masks(model, 3)
    for first, draws in ((0, 2), (2, 2), (4, 12)):
        got, truth = (
            {r.Customer_ID: (r.n, r.s, r.q) for r in f(m, few, base, features, "Customer_ID", first, draws, 42).collect()}
            for f, m in ((attribution._drawn_by_masks, masks), (attribution._drawn, model)))
        assert set(got) == set(truth) and len(got) == 40
        for k, (n, s, q) in truth.items():
            assert got[k][0] == n and got[k][1] == pytest.approx(s, abs=1e-9) and got[k][2] == pytest.approx(q, abs=1e-9)
    once = {(r.Customer_ID, r.feature): r.phi for r in attribution.attributions(model, few, base, features, error=1.0).collect()}
    twice = few.unionByName(few.where("Customer_ID = '7'"))
    for r in attribution.attributions(model, twice, base, features, error=1.0).collect():
        assert r.phi == pytest.approx(once[r.Customer_ID, r.feature] * (2 if r.Customer_ID == "7" else 1), abs=1e-9)


def test_residuals_score_every_row_once(spark, monkeypatch):
    """f15_residuals reads its scores by key, by value and in a filter; the model must not run for each of them."""
    from types import SimpleNamespace

    from basketlens.catalog import residual_queries

    calls = spark.sparkContext.accumulator(0)

    def score(x):
        calls.add(1)
        return float(x)

    rows = spark.createDataFrame([(str(i), i) for i in range(100)], "Customer_ID string, v int")
    held = rows.where("v < 40").selectExpr("Customer_ID", "v % 2 as High_Satisfaction")
    training = SimpleNamespace(test=held, best=lambda: SimpleNamespace(auc=0.525))
    monkeypatch.setattr(residual_queries.m, "_training", lambda spark, path: training)
    monkeypatch.setattr(residual_queries.m, "f15_score", lambda spark, path: rows.select("Customer_ID", F.udf(score, "double")("v").alias("probability_pct")))
    assert tuple(residual_queries.f15_residuals(spark, "").first()) == (100, 40, 0.0)
    assert calls.value == 100


def held_tables(spark, before=()):
    """Folders in the shared folder that were not there before."""
    return sorted({p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir()} - set(before))


@pytest.mark.parametrize("share", [0.2, 0.5])
def test_prepare_keeps_the_sets_alone(spark, monkeypatch, share):
    """Neighbours and parts go when the sets are written; equal classes need no neighbours."""
    rows = imbalanced(spark, share=share)
    monkeypatch.setattr(classify, "model_rows", lambda orders: orders)
    # The rows are coded already.
    monkeypatch.setattr(classify, "fit_encoder", lambda rows: PipelineModel([]))
    features = [c for c in rows.columns if c not in (classify.KEY, classify.TARGET)]
    monkeypatch.setattr(classify, "FEATURES", features)
    monkeypatch.setattr(classify, "assemble", lambda rows: rows)
    before = held_tables(spark)
    made = classify.prepare(rows, fit_rows=100)
    assert [n.rsplit("-", 1)[0] for n in held_tables(spark, before)] == ["resampled", "test", "train"]
    counts = {r[0]: r[1] for r in made.resampled.groupBy(classify.TARGET).count().collect()}
    assert len(set(counts.values())) == 1 and made.train.count() == 100 and made.test.count() > 0


def test_prepare_draws_the_rows_to_fit_on_without_keeping_the_others(spark, monkeypatch):
    """The same rows to fit on, and no table of the oversampled rows or of neighbours."""
    rows = imbalanced(spark, n=1500, share=0.2)
    # The rows are coded already.
    monkeypatch.setattr(classify, "fit_encoder", lambda rows: PipelineModel([]))
    features = [c for c in rows.columns if c not in (classify.KEY, classify.TARGET)]
    monkeypatch.setattr(classify, "FEATURES", features)
    monkeypatch.setattr(classify, "assemble", lambda rows: rows)
    whole, before = classify.prepare(rows, fit_rows=100, written=True), held_tables(spark)
    alone = classify.prepare(rows, fit_rows=100, written=True, keep_resampled=False)
    assert [n.rsplit("-", 1)[0] for n in held_tables(spark, before)] == ["test", "train"]
    expected = whole.resampled.orderBy(classify.key_hash(F.col(classify.KEY), "fit"), classify.KEY).limit(100)
    assert sorted(alone.train.collect()) == sorted(whole.train.collect()) == sorted(expected.collect())
    assert sorted(alone.test.collect()) == sorted(whole.test.collect())


def test_models_are_fitted_on_all_oversampled_rows(spark, monkeypatch):
    """More rows than the 50,000 that fits once stopped at: none is left out, and one table holds them."""
    rows = spark.range(42_000).selectExpr("cast(id as string) as Customer_ID", "double(id % 7) as a", "double(id % 40) + id % 3 as b", "int(id % 40 = 0) as High_Satisfaction")
    monkeypatch.setattr(classify, "fit_encoder", lambda rows: PipelineModel([]))
    monkeypatch.setattr(classify, "FEATURES", ["a", "b"])
    monkeypatch.setattr(classify, "assemble", lambda rows: rows)
    before = held_tables(spark)
    made = classify.prepare(rows, written=True)
    assert [n.rsplit("-", 1)[0] for n in held_tables(spark, before)] == ["test", "train"]
    counts = {r[0]: r[1] for r in made.train.groupBy(classify.TARGET).count().collect()}
    larger = 42_000 - 1_050 - made.test.where("High_Satisfaction = 0").count()
    assert counts == {0: larger, 1: larger} and 2 * larger > 65_000
    assert made.resampled.count() == made.train.count()


def test_rows_to_fit_on_are_bounded_before_they_are_ordered(spark, monkeypatch):
    """What is ordered is little more than what is taken; keys that repeat leave too few below the bound, and all are ordered."""
    rows = spark.range(20_000).selectExpr("cast(id as string) as k", "id as v")
    for table, held in ((rows, True), (rows.selectExpr("if(v % 2 = 0, 'a', 'b') as k", "v"), False)):
        scratch = Scratch(spark, "t")
        got = classify.first_by_hash(table, "k", 1000, 20_000, scratch)
        expected = table.orderBy(classify.key_hash(F.col("k"), "fit"), "k").limit(1000)
        assert sorted(r.k for r in got.collect()) == sorted(r.k for r in expected.collect())
        assert (spark.read.parquet(f"{scratch.root}/drawn").count() in range(1000, 4000)) == held


def test_names_of_neighbours_are_written_without_features(spark):
    """The search for names keeps neither a second copy of what it found nor the visits; rows are names and numbers."""
    source = random.Random(12)
    rows = spark.createDataFrame([(str(i), source.random(), source.random()) for i in range(400)], "id string, a double, b double")
    scratch = Scratch(spark, "t")
    near, _ = near_names(rows, "id", ["a", "b"], 5, scratch, cell_rows=50)
    assert near.columns == ["id", "point", "neighbours"] and near.count() == 400
    held = {p.name for p in Path(scratch.root.removeprefix("file:")).iterdir()}
    assert held == {"points", "names", "first", "across"}
    first = spark.read.parquet(f"{scratch.root}/first")
    assert first.where("(x is null) <> (size(to) = 0)").count() == 0 < first.where("x is null").count()


def test_scoring_reads_the_written_rows(spark, data, monkeypatch):
    from basketlens.catalog import model_queries as m

    monkeypatch.setattr(m, "_models", {})
    rows = m._rows(spark, data)
    encoder = classify.fit_encoder(rows)
    model = LogisticRegression(labelCol=classify.TARGET, maxIter=2).fit(classify.assemble(classify.encode(encoder, rows)))
    fitted = classify.Fitted("lr", model, 1.0, 1.0)
    monkeypatch.setattr(m, "_training", lambda *_: classify.Training(encoder, None, None, None, {"lr": None}, {"lr": fitted}))
    scored = m.f15_score(spark, data)
    assert all("/complete-" in f for f in scored.inputFiles()) and scored.count() == rows.count()


def test_between_neighbours_keeps_its_counts_alone(spark):
    from basketlens.operators.oversample import between_neighbours

    rows = imbalanced(spark)
    features = [c for c in rows.columns if c not in (classify.KEY, classify.TARGET)]
    full = materialise(oversample(rows, features, classify.TARGET, classify.KEY), "full")
    before = held_tables(spark)
    found = between_neighbours(full, features, classify.TARGET, classify.KEY).collect()
    assert [n.rsplit("-", 1)[0] for n in held_tables(spark, before)] == ["between-counts"]
    assert len({r["count"] for r in found}) == 1
    assert sum(r["between"] for r in found) == full.where("synthetic").count() > 0


def test_written_tables_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {n for n in disk.getAllFiles().mkString(",").split(",") if "/shuffle_" in n}
    before, kept = shuffles(), spark.conf.get(FREED, None)
    for written in (materialise(spark.range(1000).repartition(7), "t"), Scratch(spark, "t").write(spark.range(1000).repartition(7), "t")):
        assert written.count() == 1000
    made = {n for n in shuffles() - before if n.endswith(".data")}
    # The counts leave theirs, of a few bytes; the tables' own would be kilobytes.
    assert all(os.path.getsize(n) < 1000 for n in made)
    assert spark.conf.get(FREED, None) == kept


def test_attribution_and_residuals_read_written_codes(spark, data, monkeypatch):
    from basketlens.catalog import model_queries as m

    monkeypatch.setattr(m, "_models", {})
    encoder = classify.fit_encoder(m._rows(spark, data))
    monkeypatch.setattr(m, "_training", lambda *_: classify.Training(encoder, None, None, None, {}, {}))
    coded = m._encoded(spark, data)
    assert "Join" not in coded._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(coded.collect()) == sorted(classify.encode(encoder, m._rows(spark, data)).collect())


def test_projection_reads_the_written_rows(spark, data):
    from basketlens.catalog import model_queries

    assert all("/rfm-" in f for f in model_queries.m9_pca(spark, data).inputFiles())


def test_quarantine_is_not_dealt_to_a_fixed_number_of_tasks(spark, data, monkeypatch):
    from basketlens.catalog import clean_queries

    frame = type(spark.range(1))
    monkeypatch.setattr(frame, "repartitionByRange", lambda *a: pytest.fail("dealt by range"))
    row = clean_queries.io_quarantine(spark, data).first()
    assert row.rows_in > 0 and row.quarantined_rows == row.short_records + row.long_records > 0


def test_coreset_stays_within_its_bound(spark):
    """For any centres: roots of the costs of rows and cells differ by at most the root of the spread."""
    _, _, vectors = segment._prepared(gaussian_rfm(spark))
    core = segment.coreset(vectors, most_cells=60)
    z = np.array([r.z for r in vectors.collect()])
    assert core.weights.sum() == len(z) and len(core.points) <= 80
    rng = np.random.default_rng(0)
    for _ in range(20):
        centres = rng.normal(0, 1, (4, 3))
        full = segment.squared(z, centres).min(axis=1).sum()
        cells = (segment.squared(core.points, centres).min(axis=1) * core.weights).sum()
        assert abs(full**0.5 - cells**0.5) <= core.spread**0.5 + 1e-9
    vectors.unpersist()


def test_sweep_is_near_the_fit_on_all_rows(spark):
    """Inertia within a hundredth of ten k-means starts over all rows, and the silhouettes of the evaluator."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    source = random.Random(9)
    rows = spark.createDataFrame(
        [(source.randrange(2000), source.randrange(1, 40), source.lognormvariate(4, 1)) for _ in range(4000)],
        "Recency int, Frequency_of_Purchase int, Purchase_Amount double")
    found = {r.k: r for r in segment.sweep(rows, ks=range(2, 7), starts=5).collect()}
    _, _, vectors = segment._prepared(rows)
    scaled = vectors.select(array_to_vector("z").alias("scaled")).cache()
    for k in range(2, 7):
        best = min((KMeans(k=k, seed=s, maxIter=300, tol=1e-4, featuresCol="scaled").fit(scaled) for s in range(5)), key=lambda m: m.summary.trainingCost)
        assert found[k].inertia <= best.summary.trainingCost * 4000 / 3999 * 1.01
    model = segment.as_model(spark, segment.best_centres(spark, segment.coreset(vectors), [4], 5, 42)[4])
    judge = ClusteringEvaluator(featuresCol="scaled", predictionCol="Cluster").evaluate(model.transform(scaled))
    assert found[4].silhouette == pytest.approx(judge, abs=1e-6)
    scaled.unpersist()
    vectors.unpersist()


def test_newton_steps_equal_the_library_fit(spark):
    from basketlens.operators import matching
    from pyspark.ml.feature import VectorAssembler

    source, table = random.Random(3), []
    for _ in range(3000):
        age, income, loyalty = source.randrange(18, 71), source.choice(["Low", "High", "Middle"]), source.randrange(1, 6)
        table.append((age, income, loyalty, int(source.random() < 1 / (1 + 2.7 ** -(0.03 * (age - 40) + 0.4 * (loyalty - 3))))))
    rows = spark.createDataFrame(table, "Age int, Income_Level string, Brand_Loyalty int, Discount_Used int")
    got = matching.propensity_scores(rows)
    coded = rows.selectExpr("Discount_Used as label", "double(Age) as x1", "double(array_position(array('High', 'Low', 'Middle'), Income_Level) - 1) as x2", "double(Brand_Loyalty) as x3")
    fit = LogisticRegression(regParam=1 / 3000, elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-12).fit(
        VectorAssembler(inputCols=["x1", "x2", "x3"], outputCol="features").transform(coded))
    weights = matching.newton_weights(coded.groupBy("label", "x1", "x2", "x3").agg(F.count("*").alias("n")), 3)
    assert weights == pytest.approx([fit.intercept, *fit.coefficients], abs=1e-6)
    assert abs(got.agg(F.avg(F.col("Propensity_Score") - F.col("Discount_Used"))).first()[0]) < 1e-9
    one_arm = rows.where("Discount_Used = 1")
    assert all(0 < r.Propensity_Score <= 1 for r in matching.propensity_scores(one_arm).collect())

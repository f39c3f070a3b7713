"""Segmentation, classifier and attribution."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from basketlens.catalog.oracle_base import over_orders
from basketlens.catalog.rounding import rounded
from basketlens.operators import attribution, classify, segment
from basketlens.operators.oversample import between_neighbours
from basketlens.plans.dashboard import select_rows
from basketlens.session import materialise, scratch_path
from basketlens.sources.retail import retail_orders

ID, AMT, TIME, FREQ, SAT = (
    "Customer_ID", "Purchase_Amount", "Time_of_Purchase", "Frequency_of_Purchase", "Customer_Satisfaction",
)
KEY, TARGET, FEATURES = classify.KEY, classify.TARGET, classify.FEATURES


def _rfm(spark, path, *keep):
    return segment.rfm(retail_orders(spark, path, [TIME, FREQ, AMT, *keep]), *keep)


def _by_quarter(spark, path):
    """A fixed assignment both engines know: the quarter of the purchase."""
    return _rfm(spark, path, "Purchase_Quarter").withColumn("Cluster", F.col("Purchase_Quarter") - 1)


_models: dict = {}


def _once(spark, path, name, build):
    """Models are trained once per session and input, as the scripts that share them do."""
    key = (spark.sparkContext.applicationId, path, name)
    if key not in _models:
        _models[key] = build()
    return _models[key]


def _rfm_table(spark, path):
    """The rows by key, written once: fits pass over them several times."""
    return _once(spark, path, "rfm", lambda: materialise(_rfm(spark, path, ID), "rfm"))


def _segments(spark, path):
    return _once(spark, path, "segments", lambda: segment.fit_segments(_rfm_table(spark, path).select(*segment.RFM)))


def m1_recency(spark, path):
    return segment.add_recency(retail_orders(spark, path, [ID, TIME])).select(ID, "Recency")


def m2_rfm(spark, path):
    return _rfm(spark, path, ID)


def m3_scaled(spark, path):
    return rounded(segment.standardised(_rfm(spark, path, ID)).select(ID, *[f"{c}_z" for c in segment.RFM]))


def m4_k_sweep(spark, path):
    return rounded(segment.sweep(_rfm(spark, path)))


def m5_clusters(spark, path):
    return _segments(spark, path).transform(_rfm(spark, path, ID)).select(ID, "Cluster")


def m6_profile(spark, path):
    return segment.profile(_by_quarter(spark, path))


def m7_names(spark, path):
    return segment.named(_by_quarter(spark, path)).groupBy("Cluster", "Segment_Name").agg(F.count("*").alias("rows"))


def m8_radar(spark, path):
    return rounded(segment.radar(segment.profile(_by_quarter(spark, path))))


def _clustered(spark, path):
    return _segments(spark, path).transform(_rfm_table(spark, path))


def m6_fitted_profile(spark, path):
    return segment.profile(_clustered(spark, path))


def m7_fitted_names(spark, path):
    return segment.named(_clustered(spark, path)).groupBy("Cluster", "Segment_Name").agg(F.count("*").alias("rows"))


def m8_fitted_radar(spark, path):
    return rounded(segment.radar(segment.profile(_clustered(spark, path))))


def m9_pca(spark, path):
    return rounded(segment.projection(_clustered(spark, path)).select(ID, "Cluster", "PC1", "PC2"))


def m10_score(spark, path):
    """Filtered rows scored by a saved and reloaded model; profile per segment."""
    target = scratch_path(spark, "segments")
    _segments(spark, path).write().overwrite().save(target)
    orders = retail_orders(spark, path, [TIME, FREQ, AMT, "Purchase_Channel"])
    rows = segment.rfm(select_rows(orders, Purchase_Channel=["Online"]))
    return segment.profile(segment.score_segments(PipelineModel.load(target), rows), "Segment")


def _rows(spark, path):
    return classify.model_rows(retail_orders(spark, path, [ID, *classify.INPUTS, TARGET]))


def _complete(spark, path):
    """The complete rows, written once: preparation and scoring read them, and each would join the order view again."""
    return _once(spark, path, "complete", lambda: materialise(_rows(spark, path), "complete"))


def _training(spark, path):
    return _once(spark, path, "training", lambda: classify.prepare(_complete(spark, path), written=True))


def f01_features(spark, path):
    orders = retail_orders(spark, path, [ID, "Product_Rating", "Brand_Loyalty"])
    return classify.add_engagement(orders).select(ID, "Engagement_Score")


def f02_model_rows(spark, path):
    return rounded(_rows(spark, path))


def f03_encoded(spark, path):
    rows = _rows(spark, path)
    return classify.encode(classify.fit_encoder(rows), rows).select(ID, *classify.CATEGORIES)


def f04_split(spark, path):
    return classify.mark_split(_rows(spark, path)).select(ID, TARGET, F.col("in_train").cast("int").alias("in_train"))


def f05_class_counts(spark, path):
    return classify.class_counts(_rows(spark, path))


def f06_oversampled(spark, path):
    """Class sizes of the rows to fit on after oversampling; synthetic rows that lie towards one of the five nearest."""
    return between_neighbours(_training(spark, path).resampled, FEATURES, TARGET, KEY)


def _quality(name):
    def run(spark, path):
        f = _training(spark, path).fit(name)
        return rounded(spark.createDataFrame([(f.name, f.f1, f.auc)], "model string, f1 double, auc double"))

    return run


def f10_compare(spark, path):
    training = _training(spark, path)
    best = training.best().name
    rows = [(f.name, f.f1, f.auc, f.name == best) for f in training.compare()]
    return rounded(spark.createDataFrame(rows, "model string, f1 double, auc double, best boolean"))


def _fixed_scores(spark, path):
    """A score both engines compute alike: share of loyalty and rating in their maxima."""
    orders = retail_orders(spark, path, [ID, TARGET, "Product_Rating", "Return_Rate", "Age", AMT])
    score = "(Product_Rating * 11 + Age - 3 * Return_Rate) / 125.0D + Purchase_Amount / 100000000.0D"
    return orders.withColumn("score", F.expr(score)).withColumn("prediction", F.expr("int(score >= 0.5D)"))


def f11_report(spark, path):
    return rounded(classify.classification_report(_fixed_scores(spark, path)))


def f12_confusion(spark, path):
    return classify.confusion(_fixed_scores(spark, path))


def f13_roc(spark, path):
    return rounded(classify.roc_points(_fixed_scores(spark, path)), 12)


def f11_model_report(spark, path):
    training = _training(spark, path)
    best = training.best()
    return rounded(classify.classification_report(classify.score_column(best.model.transform(training.test))))


def _best_scored(spark, path):
    training = _training(spark, path)
    return classify.score_column(training.best().model.transform(training.test))


def f12_model_confusion(spark, path):
    return classify.confusion(_best_scored(spark, path))


def f13_model_roc(spark, path):
    return rounded(classify.roc_points(_best_scored(spark, path)), 12)


def f14_importance(spark, path):
    return rounded(classify.importances(_training(spark, path).best().model, FEATURES, spark))


def f15_score(spark, path):
    """All orders scored by the saved and reloaded encoder and best model."""
    training = _training(spark, path)
    target = scratch_path(spark, "satisfaction")
    best = training.best()
    PipelineModel([*training.encoder.stages, best.model]).write().overwrite().save(target)
    *encoder, model = PipelineModel.load(target).stages
    # The target is always known: rows with complete features are the complete rows.
    return rounded(classify.score_rows(PipelineModel(encoder), model, _complete(spark, path).select(ID, *classify.INPUTS)))


def _encoded(spark, path):
    """Every complete row in codes, written once: baseline, attributions and residuals read them."""
    return _once(spark, path, "encoded", lambda: materialise(classify.encode(_training(spark, path).encoder, _rows(spark, path)), "encoded"))


def _attributed(spark, path):
    """Attributions of every complete row, written once and read by the three queries."""
    def build():
        training = _training(spark, path)
        model = training.best().model
        rows = _encoded(spark, path)
        base = attribution.baseline(rows)
        table = materialise(attribution.attributions(model, rows, base), "attributions")
        return table, attribution.probability_at(model, spark, base)

    return _once(spark, path, "attributions", build)


def x1_shapley(spark, path):
    return rounded(_attributed(spark, path)[0])


def x2_importance(spark, path):
    return rounded(attribution.global_importance(_attributed(spark, path)[0]))


def x3_breakdown(spark, path):
    """The first row by key."""
    attributed, base_value = _attributed(spark, path)
    first = attributed.agg(F.min(ID)).first()[0]
    return rounded(attribution.breakdown(attributed, first, base_value))


QUERIES = {
    f.__name__: f
    for f in [
        m1_recency, m2_rfm, m3_scaled, m4_k_sweep, m5_clusters, m6_profile, m7_names, m8_radar, m6_fitted_profile, m7_fitted_names, m8_fitted_radar, m9_pca, m10_score,
        f01_features, f02_model_rows, f03_encoded, f04_split, f05_class_counts, f06_oversampled,
    ]
}
QUERIES |= {
    "f07_logistic": _quality("Logistic Regression"),
    "f08_forest": _quality("Random Forest"),
    "f09_boosting": _quality("Gradient Boosting"),
}
QUERIES |= {
    f.__name__: f
    for f in [
        f10_compare, f11_report, f11_model_report, f12_confusion, f12_model_confusion, f13_roc, f13_model_roc, f14_importance, f15_score, x1_shapley,
        x2_importance, x3_breakdown,
    ]
}

_RECENCY = """rec AS (SELECT *, CAST(date_diff('day', CAST(Time_of_Purchase AS DATE),
    (SELECT CAST(max(Time_of_Purchase) AS DATE) FROM o)) + 1 AS INTEGER) AS Recency FROM o)"""
_RFM = "rfm AS (SELECT * FROM rec WHERE Recency IS NOT NULL AND Frequency_of_Purchase IS NOT NULL AND Purchase_Amount IS NOT NULL)"
_PROFILE = """prof AS (SELECT Purchase_Quarter - 1 AS Cluster, round(avg(Recency), 2) AS Recency,
    round(avg(Frequency_of_Purchase), 2) AS Frequency_of_Purchase, round(avg(Purchase_Amount), 2) AS Purchase_Amount,
    count(*) AS rows FROM rfm GROUP BY 1)"""
_COMPLETE = "r AS (SELECT *, Product_Rating * Brand_Loyalty AS Engagement_Score FROM o WHERE Brand_Loyalty IS NOT NULL)"
_SCORES = f"""s AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM (SELECT *,
    (Product_Rating * 11 + Age - 3 * Return_Rate) / 125.0::DOUBLE + Purchase_Amount / 100000000.0::DOUBLE AS score FROM o))"""
_CELLS = """c AS (SELECT CAST(High_Satisfaction AS VARCHAR) AS class, count(*) AS support,
    count(*) FILTER (WHERE prediction = High_Satisfaction) AS hit,
    (SELECT count(*) FROM s z WHERE z.prediction = s.High_Satisfaction) AS called FROM s GROUP BY High_Satisfaction)"""
_PER_CLASS = """pc AS (SELECT class, CASE WHEN called = 0 THEN 0 ELSE CAST(hit AS DOUBLE) / called END AS precision,
    CAST(hit AS DOUBLE) / support AS recall, 2.0 * hit / (called + support) AS f1, support FROM c)"""


_HASHED = """h AS (SELECT Customer_ID, High_Satisfaction,
    CAST(CAST('0x' || substr(md5(Customer_ID || '-42'), 1, 13) AS BIGINT) AS DOUBLE) AS h FROM r)"""


def _z(c):
    return f"round(({c} - (SELECT avg({c}) FROM rfm)) / (SELECT stddev_pop({c}) FROM rfm), 6) AS {c}_z"


def _unit(c):
    return f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER () + 1e-9)"


def _first(column):
    return f"(SELECT Cluster FROM prof ORDER BY {column} DESC, Cluster LIMIT 1)"


ORACLE = {
    "m1_recency": over_orders("SELECT Customer_ID, Recency FROM rec", _RECENCY),
    "m2_rfm": over_orders("SELECT Customer_ID, Recency, Frequency_of_Purchase, Purchase_Amount FROM rfm", _RECENCY, _RFM),
    "m3_scaled": over_orders(
        f"SELECT Customer_ID, {', '.join(_z(c) for c in segment.RFM)} FROM rfm", _RECENCY, _RFM),
    "m6_profile": over_orders("SELECT * EXCLUDE (rows) FROM prof", _RECENCY, _RFM, _PROFILE),
    "m7_names": over_orders(
        f"""SELECT Cluster, rows, CASE Cluster WHEN {_first('Frequency_of_Purchase')} THEN 'Loyal Customers'
        WHEN {_first('Recency')} THEN 'Hibernating (At Risk)' WHEN {_first('Purchase_Amount')} THEN 'Champions (VIP)'
        ELSE 'Potential Loyalist' END AS Segment_Name FROM prof""", _RECENCY, _RFM, _PROFILE),
    "m8_radar": over_orders(
        f"""SELECT Cluster, round(1 - {_unit('Recency')}, 6) AS recency_inverted,
        round({_unit('Frequency_of_Purchase')}, 6) AS frequency, round({_unit('Purchase_Amount')}, 6) AS monetary
        FROM prof""", _RECENCY, _RFM, _PROFILE),
    "f01_features": over_orders("SELECT Customer_ID, Product_Rating * Brand_Loyalty AS Engagement_Score FROM o"),
    "f02_model_rows": over_orders(
        "SELECT Customer_ID, " + ", ".join(
            f"round({c}, 6) AS {c}" if c == "Research_Hours" else c for c in [*FEATURES, TARGET]) + " FROM r", _COMPLETE),
    "f03_encoded": over_orders(
        "SELECT Customer_ID, " + ", ".join(
            f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS {c}" for c in classify.CATEGORIES) + " FROM r",
        _COMPLETE),
    "f04_split": over_orders(
        """SELECT Customer_ID, High_Satisfaction, CASE WHEN h <= cut THEN 1 ELSE 0 END AS in_train
        FROM h JOIN (SELECT High_Satisfaction, quantile_cont(h, 0.8) AS cut FROM h GROUP BY 1) USING (High_Satisfaction)""",
        _COMPLETE, _HASHED),
    "f05_class_counts": over_orders("SELECT High_Satisfaction, count(*) AS count FROM r GROUP BY 1", _COMPLETE),
    "f06_oversampled": over_orders(
        """SELECT High_Satisfaction, max(n) OVER () AS count, max(n) OVER () - n AS between
        FROM (SELECT High_Satisfaction, count(*) AS n FROM fit GROUP BY 1)""",
        _COMPLETE, _HASHED,
        """fit AS (SELECT h.High_Satisfaction FROM h JOIN (SELECT High_Satisfaction, quantile_cont(h, 0.8) AS cut FROM h GROUP BY 1) c
        ON h.High_Satisfaction = c.High_Satisfaction AND h.h <= c.cut)"""),
    "f11_report": over_orders(
        """SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM pc
        UNION ALL SELECT 'accuracy', NULL, NULL, (SELECT round(CAST(sum(hit) AS DOUBLE) / sum(support), 6) FROM c),
            CAST(sum(support) AS BIGINT) FROM pc
        UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
            CAST(sum(support) AS BIGINT) FROM pc
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
            round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
            CAST(sum(support) AS BIGINT) FROM pc""", _SCORES, _CELLS, _PER_CLASS),
    "f12_confusion": over_orders(
        """SELECT High_Satisfaction, count(*) FILTER (WHERE prediction = 0) AS predicted_0,
        count(*) FILTER (WHERE prediction = 1) AS predicted_1 FROM s GROUP BY 1""", _SCORES),
    "f13_roc": over_orders(
        """SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
        UNION ALL SELECT DISTINCT round(score, 12), round(CAST(count(*) FILTER (WHERE High_Satisfaction = 0)
            OVER (ORDER BY score DESC) AS DOUBLE) / count(*) FILTER (WHERE High_Satisfaction = 0) OVER (), 12),
            round(CAST(count(*) FILTER (WHERE High_Satisfaction = 1) OVER (ORDER BY score DESC) AS DOUBLE)
            / count(*) FILTER (WHERE High_Satisfaction = 1) OVER (), 12) FROM s""", _SCORES),
}

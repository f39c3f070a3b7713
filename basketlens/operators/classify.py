"""The satisfaction classifier: features, split, training, comparison, reports, scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.hashing import RANGE, key_hash
from basketlens.operators import trees
from basketlens.operators.oversample import oversample
from basketlens.operators.quantiles import exact_quantiles
from basketlens.operators.ranges import running_totals
from basketlens.session import Scratch, materialise, scratch_path

KEY, TARGET = "Customer_ID", "High_Satisfaction"
# Model inputs, the coded ones among them.
FEATURES = [
    "Age", "Income_Level", "Frequency_of_Purchase", "Purchase_Channel", "Brand_Loyalty", "Product_Rating",
    "Research_Hours", "Social_Media_Influence", "Discount_Sensitivity", "Return_Rate", "Engagement_with_Ads",
    "Device_Used_for_Shopping", "Payment_Method", "Discount_Used", "Customer_Loyalty_Program_Member",
    "Purchase_Intent", "Shipping_Preference", "Time_to_Decision", "Engagement_Score",
]
CATEGORIES = [
    "Income_Level", "Purchase_Channel", "Social_Media_Influence", "Discount_Sensitivity", "Engagement_with_Ads",
    "Device_Used_for_Shopping", "Payment_Method", "Purchase_Intent", "Shipping_Preference",
]
INPUTS = [c for c in FEATURES if c != "Engagement_Score"]
TRAIN_SHARE = 0.8


def add_engagement(orders: DataFrame) -> DataFrame:
    return orders.withColumn("Engagement_Score", F.col("Product_Rating") * F.col("Brand_Loyalty"))


def model_rows(orders: DataFrame) -> DataFrame:
    """Key, features and target of the complete rows."""
    return add_engagement(orders).select(KEY, *FEATURES, TARGET).dropna(subset=[*FEATURES, TARGET])


def fit_encoder(rows: DataFrame, categories: list[str] = CATEGORIES) -> PipelineModel:
    """Alphabetical codes from 0 for the text features, in place; a label not seen in fitting gets code 0."""
    indexer = StringIndexer(
        inputCols=categories, outputCols=[f"_i_{c}" for c in categories], stringOrderType="alphabetAsc",
        handleInvalid="keep",
    ).fit(rows)
    # The arithmetic also drops the nominal metadata: codes are used as numbers.
    codes = {
        c: f"if(_i_{c} >= {len(labels)}, 0.0D, _i_{c} + 0.0D) AS {c}"
        for c, labels in zip(categories, indexer.labelsArray)
    }
    kept = [c for c in rows.columns if c not in categories and c != TARGET]
    statement = f"SELECT {', '.join([*kept, *codes.values()])}{{target}} FROM __THIS__"
    return PipelineModel([indexer, SQLTransformer(statement=statement.format(target=", " + TARGET))])


def encode(encoder: PipelineModel, rows: DataFrame) -> DataFrame:
    """Coded rows; rows to be scored may lack the target."""
    if TARGET not in rows.columns:
        rows = rows.withColumn(TARGET, F.lit(None).cast("int"))
    return encoder.transform(rows)


def mark_split(rows: DataFrame, share: float = TRAIN_SHARE, seed: int = 42) -> DataFrame:
    """Add ``in_train``: within each class the ``share`` of rows with the smallest key hashes, exactly."""
    hashed = rows.withColumn("_h", key_hash(F.col(KEY), seed))
    limits = {q.by: q.values[0] for q in exact_quantiles(hashed, ["_h"], [share], by=TARGET)}
    test = F.lit(False)
    for code, limit in limits.items():
        test = F.when(F.col(TARGET) == int(code), F.col("_h") <= F.lit(limit)).otherwise(test)
    return hashed.withColumn("in_train", test).drop("_h")


def class_counts(rows: DataFrame, label: str = TARGET) -> DataFrame:
    return rows.groupBy(label).agg(F.count("*").alias("count")).orderBy(label)


def classifiers(train_rows: int) -> dict:
    """The three models by name, in order of comparison."""
    columns = {"featuresCol": "features", "labelCol": TARGET}
    return {
        "Logistic Regression": LogisticRegression(
            **columns, maxIter=1000, regParam=1.0 / max(1, train_rows), elasticNetParam=0.0, standardization=False
        ),
        "Random Forest": RandomForestClassifier(
            **columns, numTrees=300, maxDepth=10, seed=42, maxMemoryInMB=1024, cacheNodeIds=True
        ),
        "Gradient Boosting": GBTClassifier(**columns, maxIter=300, maxDepth=6, stepSize=0.05, seed=42),
    }


def assemble(rows: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features").transform(rows)


def reloaded(model, spark):
    """The model saved and read back: kept for later use, and without the training summary,
    which holds the session and so cannot always be shipped to executors."""
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    return type(model).load(path)


@dataclass
class Fitted:
    """One trained model and its hold-out quality."""

    name: str
    model: object
    f1: float
    auc: float


def evaluate(name: str, model, test: DataFrame) -> Fitted:
    scratch = Scratch(test.sparkSession, "evaluate")
    # Both measures read the scores, and the model would score for each.
    scored = scratch.write(model.transform(test).select(TARGET, "rawPrediction", "prediction"), "scored")
    f1 = MulticlassClassificationEvaluator(labelCol=TARGET, metricName="fMeasureByLabel", metricLabel=1.0)
    auc = BinaryClassificationEvaluator(labelCol=TARGET, rawPredictionCol="rawPrediction", numBins=0)
    fitted = Fitted(name, model, f1.evaluate(scored), auc.evaluate(scored))
    scratch.drop()
    return fitted


@dataclass
class Training:
    """Encoder, prepared sets and models of one training run."""

    encoder: PipelineModel
    train: DataFrame
    resampled: DataFrame | None
    test: DataFrame
    estimators: dict
    fitted: dict
    blocks: trees.Blocks | None = None

    def binned(self) -> trees.Blocks:
        """The rows to fit on in bins, written once for both kinds of trees."""
        if self.blocks is None:
            self.blocks = trees.binned(self.train, FEATURES, TARGET, KEY, self.estimators["Gradient Boosting"].getMaxBins(), Scratch(self.train.sparkSession, "binned"))
        return self.blocks

    def fit(self, name: str) -> Fitted:
        """Train the named model once."""
        if name not in self.fitted:
            estimator = self.estimators[name]
            if isinstance(estimator, RandomForestClassifier):
                model = trees.forest(estimator, self.binned())
            elif isinstance(estimator, GBTClassifier):
                model = trees.boosted(estimator, self.binned())
            else:
                model = reloaded(estimator.fit(self.train), self.train.sparkSession)
            self.fitted[name] = evaluate(name, model, self.test)
        return self.fitted[name]

    def compare(self) -> list[Fitted]:
        return [self.fit(name) for name in self.estimators]

    def best(self) -> Fitted:
        """Highest F1; the earlier model on a tie."""
        return max(self.compare(), key=lambda f: f.f1)


def first_by_hash(rows: DataFrame, key: str, size: int, expected: int, scratch: Scratch) -> DataFrame:
    """The ``size`` rows with the smallest key hashes, equal ones by key, of about ``expected`` rows.

    An ordered limit would send ``size`` rows from every task.  Those below a bound that holds a fifth more are written; all are ordered only if
    they are too few, as with keys that repeat.
    """
    hashed = rows.withColumn("_h", key_hash(F.col(key), "fit"))
    share = (1.2 * size + 1000) / max(1, expected)
    if share < 1:
        drawn = scratch.write(hashed.where(F.col("_h") < share * RANGE), "drawn")
        hashed = drawn if drawn.count() >= size else hashed
    return hashed.orderBy("_h", key).limit(size).drop("_h")


def prepare(orders: DataFrame, fit_rows: int | None = None, written: bool = False, keep_resampled: bool = True) -> Training:
    """Encode, split, oversample the whole train part and keep the sets as written tables.

    Models are fitted on all rows of the oversampled train part, which is written once.  ``written``: ``orders`` are ``model_rows`` in a table that
    the caller keeps.  A caller may ask for a trial on ``fit_rows`` rows, those with the smallest key hashes; no query does.  Without
    ``keep_resampled`` the rows of a trial are drawn while the train part is oversampled, and the result has none of the others.
    """
    scratch = Scratch(orders.sparkSession, "prepare")
    # Written once: codes, split points and both parts read the complete rows, and each would join the order view again.
    rows = orders if written else scratch.write(model_rows(orders), "rows")
    encoder = fit_encoder(rows)
    split = mark_split(encode(encoder, rows))
    # Not written apart: codes and hashes are made again from the complete rows, which takes no shuffle.
    in_train = split.where("in_train").drop("in_train")
    test = materialise(split.where("not in_train").select(KEY, *FEATURES, TARGET), "test")
    resampled = oversample(in_train, FEATURES, TARGET, KEY, scratch=scratch)
    if fit_rows is None:
        train = resampled = materialise(resampled, "train")
    else:
        largest = in_train.groupBy(TARGET).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if keep_resampled:
            resampled = materialise(resampled, "resampled")
            scratch.drop()
        train = materialise(first_by_hash(resampled, KEY, fit_rows, 2 * largest, scratch), "train")
        resampled = resampled if keep_resampled else None
    scratch.drop()
    return Training(encoder, assemble(train), resampled, assemble(test), classifiers(train.count()), {})


def score_column(scored: DataFrame) -> DataFrame:
    """(key, target, score, prediction) from a model's output."""
    return scored.select(
        KEY, TARGET, vector_to_array("probability")[1].alias("score"), F.col("prediction").cast("int").alias("prediction")
    )


def confusion(scored: DataFrame, label: str = TARGET) -> DataFrame:
    return (
        scored.groupBy(label)
        .pivot("prediction", [0, 1])
        .agg(F.count(F.lit(1)))
        .na.fill(0)
        .withColumnsRenamed({"0": "predicted_0", "1": "predicted_1"})
        .orderBy(label)
    )


def classification_report(scored: DataFrame, label: str = TARGET) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted means; 0 where undefined."""
    cells = scored.agg(
        *[
            F.count_if((F.col(label) == a) & (F.col("prediction") == p)).alias(f"c{a}{p}")
            for a in (0, 1)
            for p in (0, 1)
        ]
    )
    def ratio(top: str, bottom: str) -> str:
        return f"coalesce(try_divide(double({top}), {bottom}), 0.0D)"

    per_class = cells.selectExpr(
        "*",
        *[
            sql
            for c, o in ((0, 1), (1, 0))
            for sql in (
                f"{ratio(f'c{c}{c}', f'(c{c}{c} + c{o}{c})')} as p{c}",
                f"{ratio(f'c{c}{c}', f'(c{c}{c} + c{c}{o})')} as r{c}",
                f"{ratio(f'2 * c{c}{c}', f'(2 * c{c}{c} + c{o}{c} + c{c}{o})')} as f{c}",
                f"c{c}{c} + c{c}{o} as s{c}",
            )
        ],
    )
    def mean(x: str) -> str:
        return f"({x}0 + {x}1) / 2"

    def weighted(x: str) -> str:
        return ratio(f"({x}0 * s0 + {x}1 * s1)", "(s0 + s1)")

    accuracy = ratio("(c00 + c11)", "(s0 + s1)")
    rows = [
        f"struct('{c}' as class, p{c} as precision, r{c} as recall, f{c} as f1, s{c} as support)" for c in (0, 1)
    ] + [
        f"struct('accuracy' as class, cast(null as double) as precision, cast(null as double) as recall,"
        f" {accuracy} as f1, s0 + s1 as support)",
        f"struct('macro avg' as class, {mean('p')} as precision, {mean('r')} as recall, {mean('f')} as f1,"
        " s0 + s1 as support)",
        f"struct('weighted avg' as class, {weighted('p')} as precision, {weighted('r')} as recall,"
        f" {weighted('f')} as f1, s0 + s1 as support)",
    ]
    return per_class.selectExpr(f"inline(array({', '.join(rows)}))")


def roc_points(scored: DataFrame, label: str = TARGET, buckets: int | None = None) -> DataFrame:
    """False and true positive rate at every distinct score, highest first, from the origin.

    Rows collapse to distinct scores; running counts go over range buckets.
    """
    counts = scored.groupBy(F.col("score").cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives")
    )
    counts = materialise(counts, "roc-counts")
    totals = counts.agg(F.sum("positives").alias("p"), F.sum("negatives").alias("n")).first()
    positives, negatives = totals["p"] or 0, totals["n"] or 0
    points = running_totals(counts, "score", ["positives", "negatives"], descending=True, buckets=buckets)
    origin = scored.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return origin.unionByName(
        points.selectExpr(
            "score as threshold",
            f"try_divide(double(negatives_to), {negatives}) as fpr",
            f"try_divide(double(positives_to), {positives}) as tpr",
        )
    )


def importances(model, features: list[str], spark, size: int = 12) -> DataFrame:
    """Largest feature importances; absolute coefficients of a linear model."""
    vector = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    rows = [(name, abs(float(v))) for name, v in zip(features, vector.toArray())]
    return (
        spark.createDataFrame(rows, "feature string, importance double")
        .orderBy(F.desc("importance"), "feature")
        .limit(size)
    )


def score_rows(encoder: PipelineModel, model, orders: DataFrame) -> DataFrame:
    """Class at probability 0.5 and probability in percent for rows with complete features."""
    rows = add_engagement(orders).select(KEY, *FEATURES).dropna(subset=FEATURES)
    scored = model.transform(assemble(encode(encoder, rows)))
    probability = vector_to_array("probability")[1]
    return scored.select(
        KEY, (probability >= 0.5).cast("int").alias("predicted"), (probability * 100).alias("probability_pct")
    )

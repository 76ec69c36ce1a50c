"""Fraud classification on the fraud mart: features, split, three classifiers, metrics, persistence."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.functions.classify import is_fraud_label
from remitlens.functions.numeric import percent
from remitlens.ml import figures
from remitlens.operators.selection import kth_values

# --- fixed values -------------------------------------------------------------------------------------------
FEATURES = (
    "total_calls",
    "failed_calls",
    "call_failure_rate_pct",
    "avg_quality_score",
    "avg_delivery_rate_pct",
    "poor_quality_calls",
    "total_transfers",
    "total_transfer_usd",
    "avg_transfer_usd",
    "fraud_transfers",
    "fraud_rate_pct",
    "very_large_transfers",
    "support_tickets",
    "fraud_tickets",
    "avg_satisfaction_score",
    "total_fraud_signals",
)
# The label is a function of these; models meant to predict anything must not see them.
LABEL_FEATURES = ("fraud_transfers", "fraud_rate_pct", "fraud_tickets", "total_fraud_signals")
SEED = 42
TRAIN_SHARE = 70
FOREST, BOOSTED, LOGISTIC = "Random Forest", "Gradient Boosting", "Logistic Regression"
MODEL_NAMES = (FOREST, BOOSTED, LOGISTIC)
# Scoring rules that need no fitting: a feature, and the value above which it predicts fraud.
RULES = {
    "Call Failures": ("call_failure_rate_pct", 30),
    "Transfer Volume": ("total_transfer_usd", 900),
    "Support Tickets": ("support_tickets", 5),
    "Fraud Signals": ("total_fraud_signals", 1),
}
# ------------------------------------------------------------------------------------------------------------
Found = TypeVar("Found")
HONEST_FEATURES = tuple(name for name in FEATURES if name not in LABEL_FEATURES)


def training_table(fraud_mart: DataFrame) -> DataFrame:
    """user_id, the features with missing values as 0, and the label."""
    numbers = [F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name) for name in FEATURES]
    return fraud_mart.select("user_id", *numbers, is_fraud_label(F.col("fraud_risk_level")).alias("is_fraud"))


def label_balance(table: DataFrame) -> DataFrame:
    users, frauds = F.count(F.lit(1)), F.sum(F.col("is_fraud").cast("bigint"))
    return table.agg(
        users.alias("users"),
        frauds.alias("fraud_users"),
        (users - frauds).alias("safe_users"),
        percent(frauds, users, 1).alias("fraud_rate_pct"),
    )


def in_training_set(user_id: Column) -> Column:
    """A repeatable 70/30 split by user, the same share in expectation in both classes, without a shuffle."""
    digest = F.substring(F.md5(F.concat(user_id, F.lit(f":{SEED}")).cast("binary")), 1, 8)
    return F.conv(digest, 16, 10).cast("bigint") % 100 < TRAIN_SHARE


def split(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    chosen = in_training_set(F.col("user_id"))
    return table.where(chosen), table.where(~chosen)


def stratified(table: DataFrame, share_of_ten: int = 7) -> DataFrame:
    """The table with ``is_training``: in each class exactly that many tenths of the rows (to the nearest row), chosen by a hash of
    the user. The bound of each class is its k-th smallest hash, selected by counting; no class is sorted or lies in one task."""
    digest = F.substring(F.md5(F.concat("user_id", F.lit(f":{SEED}")).cast("binary")), 1, 13)
    hashed = table.withColumn("_hash", F.conv(digest, 16, 10).cast("double"))  # 52 bits, exact in a double
    bounds = kth_values(hashed, "is_fraud", "_hash", lambda n: F.array(F.call_function("div", n * share_of_ten + 5, F.lit(10))))
    bounds = bounds.select(F.col("is_fraud").alias("_class"), F.col("value").alias("_bound"))
    chosen = F.coalesce(F.col("_hash") <= F.col("_bound"), F.lit(False)).alias("is_training")
    return hashed.join(F.broadcast(bounds), F.col("is_fraud") == F.col("_class"), "left").select(*table.columns, chosen)


def stratified_split(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training and test rows with the exact share in both classes."""
    marked = stratified(table)
    return marked.where("is_training").drop("is_training"), marked.where("NOT is_training").drop("is_training")


def class_weights(table: DataFrame) -> DataFrame:
    """Weight per label: rows / (2 * rows of the label). Two rows."""
    counts = table.groupBy("is_fraud").agg(F.count(F.lit(1)).alias("rows"))
    total = table.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("class_weight", total.cast("double") / (F.col("rows") * 2).cast("double"))


def _weight_column(table: DataFrame) -> Column:
    """The balanced weight as an expression; one value per label is read to the driver."""
    weights = {row["is_fraud"]: row["class_weight"] for row in class_weights(table).collect()}
    return F.when(F.col("is_fraud") == 1, F.lit(weights.get(1, 1.0))).otherwise(F.lit(weights.get(0, 1.0)))


@dataclass(frozen=True)
class Settings:
    trees: int = 100
    tree_depth: int = 10
    boosting_rounds: int = 100
    boosting_depth: int = 3
    boosting_rate: float = 0.1
    regression_iterations: int = 1000


def _classifier(name: str, train_rows: int, settings: Settings):
    common = {"labelCol": "is_fraud"}
    if name == FOREST:
        return RandomForestClassifier(
            numTrees=settings.trees,
            maxDepth=settings.tree_depth,
            seed=SEED,
            weightCol="class_weight",
            featuresCol="features",
            **common,
        )
    if name == BOOSTED:
        return GBTClassifier(
            maxIter=settings.boosting_rounds,
            maxDepth=settings.boosting_depth,
            stepSize=settings.boosting_rate,
            seed=SEED,
            featuresCol="features",
            **common,
        )
    return LogisticRegression(
        maxIter=settings.regression_iterations,
        regParam=1.0 / max(train_rows, 1),
        standardization=False,
        weightCol="class_weight",
        featuresCol="scaled",
        **common,
    )


def fit(
    train: DataFrame, name: str, features: Sequence[str] = FEATURES, settings: Settings = Settings()
) -> PipelineModel:
    """Fit one classifier. The scaler is fitted on the training rows only and used by the regression alone."""
    weighted = train if "class_weight" in train.columns else train.withColumn("class_weight", _weight_column(train))
    stages = [VectorAssembler(inputCols=list(features), outputCol="features")]
    if name == LOGISTIC:
        stages.append(StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True))
    stages.append(_classifier(name, train.count() if name == LOGISTIC else 0, settings))
    return Pipeline(stages=stages).fit(weighted)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows)


def confusion(predictions: DataFrame) -> DataFrame:
    """Rows per actual and predicted label, zero cells included, in one row."""
    actual, predicted = F.col("is_fraud"), F.col("prediction").cast("int")

    def cell(a: int, p: int) -> Column:
        return F.count(F.when((actual == a) & (predicted == p), F.lit(1)))

    return predictions.agg(
        cell(0, 0).alias("true_safe"),
        cell(0, 1).alias("false_fraud"),
        cell(1, 0).alias("false_safe"),
        cell(1, 1).alias("true_fraud"),
    )


def metrics(predictions: DataFrame) -> dict[str, float]:
    """Accuracy, precision, recall, F1 (0 when undefined) and AUC (0 when only one class is present)."""
    cells = confusion(predictions).first()
    tp, fp, fn, tn = cells["true_fraud"], cells["false_fraud"], cells["false_safe"], cells["true_safe"]

    def share(part: float, whole: float) -> float:
        return part / whole if whole else 0.0

    precision, recall = share(tp, tp + fp), share(tp, tp + fn)
    both_classes = (tp + fn) > 0 and (tn + fp) > 0
    evaluator = BinaryClassificationEvaluator(labelCol="is_fraud", metricName="areaUnderROC")
    return {
        "accuracy": share(tp + tn, tp + tn + fp + fn),
        "precision": precision,
        "recall": recall,
        "f1": share(2 * precision * recall, precision + recall),
        "auc_roc": evaluator.evaluate(predictions) if both_classes else 0.0,
    }


def rule_figures(table: DataFrame) -> DataFrame:
    """Cells, accuracy, precision, recall, F1 and rank-sum AUC of the fixed rules on the rows of a training table, and the best
    rule by F1, the first listed winning ties. One pass over the table."""
    rules = {name: (F.col(feature), F.col(feature) > bound) for name, (feature, bound) in RULES.items()}
    return figures.with_best(figures.figures(figures.by_rules(table, rules, "is_fraud")), list(RULES))


def feature_areas(table: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """The rank-sum AUC of each feature alone: how well its order separates the classes, whatever the classifier."""
    rules = {name: (F.col(name), F.lit(0)) for name in features}
    found = figures.areas(figures.by_rules(table, rules, "is_fraud"))
    return found.select(F.col("rule").alias("feature"), "auc")


def _of_each_model(spark: SparkSession, work: Callable[[str], Found]) -> dict[str, Found]:
    """The results of ``work`` for all classifiers, done at the same time: boosting and regression are hundreds of short jobs
    in a row, and one of them alone leaves most of a cluster idle."""
    with ThreadPoolExecutor(max_workers=len(MODEL_NAMES)) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(work), name) for name in MODEL_NAMES}
        return {name: future.result() for name, future in started.items()}


def compare(
    train: DataFrame, test: DataFrame, features: Sequence[str] = FEATURES, settings: Settings = Settings()
) -> tuple[dict[str, PipelineModel], dict[str, dict[str, float]], str]:
    """Fit and score the three classifiers; the best has the highest F1, the first listed winning ties."""
    weighted = train.withColumn("class_weight", _weight_column(train))

    def fitted_and_scored(name: str) -> tuple[PipelineModel, dict[str, float]]:
        model = fit(weighted, name, features, settings)
        return model, metrics(predict(model, test))

    found = _of_each_model(train.sparkSession, fitted_and_scored)
    models, scores = ({name: pair[at] for name, pair in found.items()} for at in (0, 1))
    return models, scores, max(MODEL_NAMES, key=lambda name: scores[name]["f1"])


def metrics_table(spark: SparkSession, scores: dict[str, dict[str, float]], best: str) -> DataFrame:
    """Three rows, one per classifier."""
    columns = ("accuracy", "precision", "recall", "f1", "auc_roc")
    rows = [(name, *[float(score[c]) for c in columns], name == best) for name, score in scores.items()]
    kinds = ", ".join(f"{c} double" for c in columns)
    return spark.createDataFrame(rows, f"model string, {kinds}, is_best boolean")


def feature_importance(
    spark: SparkSession, forest: PipelineModel, features: Sequence[str] = FEATURES, top: int | None = None
) -> DataFrame:
    """Importance per feature from the fitted forest, largest first; as many rows as features."""
    weights = forest.stages[-1].featureImportances.toArray()
    rows = sorted(zip(features, map(float, weights)), key=lambda item: (-item[1], item[0]))
    ranked = [(rank, name, weight) for rank, (name, weight) in enumerate(rows[:top], 1)]
    return spark.createDataFrame(ranked, "importance_rank bigint, feature string, importance double")


def save(model: PipelineModel, path: str) -> None:
    """Store the fitted pipeline, including its scaler."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)

"""The classification pipeline at reduced size: split, weights, metrics, persistence."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from remitlens.ml import fraud
from remitlens.plans.models import Warehouse
from remitlens.session import settle

FAST = fraud.Settings(trees=10, tree_depth=5, boosting_rounds=5, regression_iterations=50)


@pytest.fixture(scope="module")
def table(spark):
    return settle(
        spark, fraud.training_table(Warehouse.over(spark, "/root/testdata/sf0.01")["mart_fraud_prevention"]), "features"
    )


def test_split_is_disjoint_exhaustive_and_even_per_class(table):
    train, test = fraud.split(table)
    assert train.count() + test.count() == table.count()
    assert train.join(test, "user_id").count() == 0
    shares = table.groupBy("is_fraud").agg(
        F.avg(fraud.in_training_set(F.col("user_id")).cast("int")).alias("share"), F.count("*").alias("n")
    )
    for row in shares.collect():
        assert abs(row.share - 0.7) < 4 * (0.21 / row.n) ** 0.5


def test_weights_balance_the_classes(table):
    weights = fraud.class_weights(table).collect()
    assert len(weights) == 2
    assert sum(w.rows * w.class_weight for w in weights) == pytest.approx(table.count())
    assert len({round(w.rows * w.class_weight, 6) for w in weights}) == 1


def test_no_missing_features(table):
    nulls = table.agg(*[F.count_if(F.col(name).isNull()) for name in fraud.FEATURES]).first()
    assert set(nulls) == {0} and len(fraud.FEATURES) == 16


def test_models_learn_and_survive_saving(spark, table, tmp_path):
    train, test = fraud.split(table)
    models, scores, best = fraud.compare(train, test, settings=FAST)
    assert set(models) == set(fraud.MODEL_NAMES) and scores[best]["f1"] > 0.9
    report = fraud.metrics_table(spark, scores, best).collect()
    assert [row.model for row in report if row.is_best] == [best]
    for score in scores.values():
        assert all(0 <= value <= 1 for value in score.values())
    for name, model in models.items():
        path = str(tmp_path / name.replace(" ", "_"))
        fraud.save(model, path)
        before = fraud.predict(model, test).select("user_id", "prediction")
        after = fraud.predict(fraud.load(path), test).select("user_id", "prediction")
        assert before.exceptAll(after).isEmpty()
    importance = fraud.feature_importance(spark, models[fraud.FOREST]).collect()
    assert len(importance) == 16 and sum(r.importance for r in importance) == pytest.approx(1.0)
    assert fraud.feature_importance(spark, models[fraud.FOREST], top=5).count() == 5


def test_classifiers_are_fitted_at_the_same_time(table, monkeypatch):
    train, test = fraud.split(table)
    alone = {name: fraud.metrics(fraud.predict(fraud.fit(train, name, settings=FAST), test)) for name in fraud.MODEL_NAMES}
    fit, meeting, weighings = fraud.fit, threading.Barrier(len(fraud.MODEL_NAMES), timeout=60), []
    weights = fraud.class_weights
    monkeypatch.setattr(fraud, "fit", lambda *given: (meeting.wait(), fit(*given))[1])
    monkeypatch.setattr(fraud, "class_weights", lambda rows: (weighings.append(1), weights(rows))[1])
    _, scores, _ = fraud.compare(train, test, settings=FAST)
    assert len(weighings) == 1
    assert list(scores) == list(fraud.MODEL_NAMES)
    for name, score in scores.items():
        assert score == pytest.approx(alone[name])


def test_confusion_and_undefined_metrics(spark):
    rows = [(0, 0.0, 0.1), (0, 1.0, 0.9), (1, 1.0, 0.8), (1, 0.0, 0.2), (1, 1.0, 0.7)]
    predictions = spark.createDataFrame(rows, "is_fraud int, prediction double, rawPrediction double")
    assert tuple(fraud.confusion(predictions).first()) == (1, 1, 1, 2)
    scores = fraud.metrics(predictions)
    assert scores["accuracy"] == 0.6 and scores["precision"] == pytest.approx(2 / 3)
    safe_only = predictions.where("is_fraud = 0 AND prediction = 0")
    assert fraud.metrics(safe_only) == {"accuracy": 1.0, "precision": 0.0, "recall": 0.0, "f1": 0.0, "auc_roc": 0.0}

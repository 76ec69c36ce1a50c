"""Selection by counting, running totals, rank sums and exact splits against plain versions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from remitlens.ml import figures, fraud
from remitlens.operators import profiling, ranking, selection
from remitlens.plans.models import Warehouse

ROWS = "g string, v double"


def _values():
    rng = random.Random(4)
    groups = {
        "even": [rng.uniform(-5, 5) for _ in range(999)],
        "skewed": [10.0 ** rng.uniform(-200, 200) * rng.choice([-1, 1]) for _ in range(300)],
        "ties": [float(rng.choice([1, 1, 1, 2, 3])) for _ in range(400)],
        "one": [2.5],
        "flat": [7.25] * 50,
        "zeros": [0.0, -0.0, 1e-320, -1e-320, 0.0],
        None: [3.0, 1.0, 2.0],
    }
    return groups, [(g, v) for g, values in groups.items() for v in values] + [("even", None), ("nothing", None)]


def test_kth_values_are_exact(spark):
    groups, rows = _values()
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    wanted = lambda n: F.array(F.lit(0), F.lit(1), F.lit(3), F.call_function("div", n, F.lit(2)), n, n + 1)
    found = {(r.g, r.k): (r.n, r.value) for r in selection.kth_values(df, "g", "v", wanted).collect()}
    want = {}
    for g, values in groups.items():
        n = len(values)
        want |= {(g, k): (n, sorted(values)[k - 1]) for k in {1, 3, n // 2, n} if 1 <= k <= n}
    assert found == want


def test_a_hot_group_is_counted_and_not_sorted(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise("g").alias("g"), (F.col("id") * 1.5).alias("v"))
    found = {r.g: r.value for r in selection.kth_values(df, "g", "v", lambda n: F.array(n)).collect()}
    assert found == {"hot": 29_999 * 1.5, "g": 29_997 * 1.5}


def test_values_without_a_place_fail(spark):
    for value in (float("nan"), float("inf"), float("-inf")):
        df = spark.createDataFrame([("g", 1.0), ("g", value)], ROWS)
        with pytest.raises(Exception, match="no place in a range"):
            selection.kth_values(df, "g", "v", lambda n: F.array(n)).collect()
    empty = spark.createDataFrame([], ROWS)
    assert selection.kth_values(empty, "g", "v", lambda n: F.array(n)).count() == 0


def test_exact_boxes_agree_with_rounded_ones_and_keep_fine_values(spark):
    rng = random.Random(8)
    coarse = [(rng.choice("abc"), rng.randrange(1000) / 100) for _ in range(500)]
    df = spark.createDataFrame(coarse, ROWS)
    rounded = {r.g: r for r in profiling.box_statistics(df, "g", "v").collect()}
    for row in profiling.exact_box_statistics(df, "g", "v").collect():
        assert tuple(row)[1:] == pytest.approx(tuple(rounded[row.g])[1:], abs=1e-4)
    fine = spark.createDataFrame([("g", 1 + i * 1e-9) for i in range(5)], ROWS)
    row = profiling.exact_box_statistics(fine, "g", "v").first()
    assert (row.q1, row.median, row.q3) == (1 + 1e-9, 1 + 2e-9, 1 + 3e-9)


def test_running_totals_number_rows_and_add_up(spark):
    rng = random.Random(1)
    values = [(i, rng.choice([None, *range(40)]), rng.randrange(9)) for i in range(3000)]
    df = spark.createDataFrame(values, "i long, v long, w long").repartition(6)
    found = ranking.running_totals(df, [F.col("v").asc_nulls_last(), F.col("i")], {"place": F.lit(1), "before": F.col("w")})
    total = 0
    for place, (i, _, w) in enumerate(sorted(values, key=lambda r: (r[1] is None, r[1] or 0, r[0]))):
        values[i] = (place, total)
        total += w
    assert {r.i: (r.place, r.before) for r in found.collect()} == dict(enumerate(values))
    assert ranking.running_totals(df.where("false"), [F.col("i")], {"place": F.lit(1)}).count() == 0


def _plain_auc(rows):
    frauds, safe = [s for label, s in rows if label], [s for label, s in rows if not label]
    wins = sum((a > b) + 0.5 * (a == b) for a in frauds for b in safe)
    return wins / (len(frauds) * len(safe)) if frauds and safe else 0.0


def test_rank_sum_areas_with_ties(spark):
    rng = random.Random(6)
    rules = {
        "ties": [(rng.random() < 0.3, float(rng.randrange(5))) for _ in range(300)],
        "fine": [(rng.random() < 0.5, rng.random()) for _ in range(200)],
        "perfect": [(s > 0.4, s) for s in (rng.random() for _ in range(50))],
        "reversed": [(s < 0.4, s) for s in (rng.random() for _ in range(50))],
        "safe only": [(False, 1.0)] * 4,
        "frauds only": [(True, 1.0)] * 4,
        "all equal": [(i % 3 == 0, 1.0) for i in range(90)],
    }
    rows = [(rule, int(label), int(score > 0.5), score) for rule, own in rules.items() for label, score in own]
    scored = spark.createDataFrame(rows, "rule string, label int, prediction int, score double").repartition(4)
    table = {r.rule: r for r in figures.with_best(figures.figures(scored), list(rules)).collect()}
    for rule, own in rules.items():
        assert table[rule].auc == pytest.approx(_plain_auc(own), abs=1e-12)
        tp = sum(label and score > 0.5 for label, score in own)
        fp = sum(not label and score > 0.5 for label, score in own)
        positives = sum(label for label, _ in own)
        tn = len(own) - positives - fp
        assert (table[rule].true_fraud, table[rule].false_fraud, table[rule].true_safe) == (tp, fp, tn)
        assert table[rule].accuracy == pytest.approx((tp + tn) / len(own))
        assert table[rule].precision == pytest.approx(tp / (tp + fp) if tp + fp else 0.0)
        assert table[rule].recall == pytest.approx(tp / positives if positives else 0.0)
    assert [r.rule for r in table.values() if r.is_best] == ["frauds only"]
    top = max(r.f1 for r in table.values())
    assert table["frauds only"].f1 == top == 1.0


def test_the_first_listed_rule_wins_ties(spark):
    rows = [(rule, 1, 1, 1.0) for rule in ("b", "a", "c")] + [("d", 1, 0, 1.0)]
    scored = spark.createDataFrame(rows, "rule string, label int, prediction int, score double")
    best = figures.with_best(figures.figures(scored), ["c", "a", "b", "d"])
    assert [r.rule for r in best.collect() if r.is_best] == ["c"]


def test_classifiers_and_rules_have_the_same_figures(spark):
    """The rank-sum area of a fitted classifier is that of Spark's evaluator."""
    table = fraud.training_table(Warehouse.over(spark, "/root/testdata/sf0.01")["mart_fraud_prevention"])
    train, test = fraud.stratified_split(table)
    model = fraud.fit(train, fraud.LOGISTIC, fraud.HONEST_FEATURES, fraud.Settings(regression_iterations=20))
    predictions = fraud.predict(model, test)
    scores = fraud.metrics(predictions)
    row = figures.figures(figures.stacked_predictions({"m": predictions}, "is_fraud")).first()
    assert row.auc == pytest.approx(scores["auc_roc"], abs=1e-3)
    assert [row.accuracy, row.precision, row.recall, row.f1] == pytest.approx([scores[n] for n in ("accuracy", "precision", "recall", "f1")])


def test_the_training_share_is_exact_in_each_class(spark):
    table = fraud.training_table(Warehouse.over(spark, "/root/testdata/sf0.01")["mart_fraud_prevention"])
    train, test = fraud.stratified_split(table)
    assert train.columns == test.columns == table.columns
    counts = {r.is_fraud: (r.n, r.t) for r in fraud.stratified(table).groupBy("is_fraud").agg(
        F.count("*").alias("n"), F.sum(F.col("is_training").cast("int")).alias("t")).collect()}
    for n, trained in counts.values():
        assert trained == (7 * n + 5) // 10
    assert train.count() + test.count() == table.count() and train.join(test, "user_id").isEmpty()
    assert equal_rows(train, fraud.stratified_split(table.repartition(7))[0])
    assert fraud.stratified(table.where("false")).count() == 0


def equal_rows(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()

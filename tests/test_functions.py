"""Exact arithmetic, text cleaning and every classification at, below and above its thresholds."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from remitlens.functions import classify as C
from remitlens.functions import numeric as N
from remitlens.functions import text as X


def column(spark, kind, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def decimal_round(value: float, places: int) -> float:
    six = Decimal(repr(value)).quantize(Decimal("0.000001"), ROUND_HALF_UP)
    return float(six.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-(10**15), 10**15), min_size=1, max_size=200), st.integers(0, 4))
def test_rounding_matches_decimal_arithmetic(spark, micros, places):
    values = [m / 1e6 for m in micros] + [2.675, 1.005, 0.125, -2.675, -0.001, 0.0, 1e9, 1e9 + 0.005, 5e14]
    got = column(spark, "double", values, lambda v: N.round_half_up(v, places))
    assert [repr(g) for g in got] == [repr(decimal_round(v, places) + 0.0) for v in values]


def test_rounding_keeps_null(spark):
    assert column(spark, "double", [None], lambda v: N.round_half_up(v, 2)) == [None]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(-(10**9), 10**9), st.integers(1, 10**6)), min_size=1, max_size=100))
def test_ratios_round_half_away_from_zero(spark, pairs):
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a bigint, b bigint")
    got = [r[0] for r in rows.orderBy("i").select(N.fixed_ratio(F.col("a"), F.col("b"), 2)).collect()]
    for (a, b), value in zip(pairs, got):
        hundredths = abs(Fraction(a * 100, b))
        whole = (2 * hundredths.numerator + hundredths.denominator) // (2 * hundredths.denominator)
        assert value == (-whole if a < 0 else whole) / 100


def test_percent_of_nothing_is_null(spark):
    row = spark.range(0).agg(N.percent(F.count("*"), F.count("*")).alias("p"), N.exact_mean(F.lit(1.0)).alias("m"))
    assert row.first() == (None, None)


def test_sums_do_not_depend_on_order(spark):
    cents = [i * 37 % 100_003 for i in range(20_000)]
    values = spark.createDataFrame([(c / 100,) for c in cents], "v double")
    for parts in (1, 7):
        got = values.repartition(parts).agg(N.exact_sum(F.col("v")), N.micro_sum(F.col("v"))).first()
        assert tuple(got) == (sum(cents) / 100, sum(cents) / 100)


def test_means(spark):
    values = spark.createDataFrame([(1.25,), (None,), (-3.5,), (2.0,)], "v double")
    got = values.agg(N.exact_mean(F.col("v")), N.exact_mean(F.col("v"), 2, 1)).first()
    assert tuple(got) == (-0.08, -0.1)


@pytest.mark.parametrize("raw", ["  Ab c ", "\tAb c\n", " Ab c ", "Ab c", "\r\n Ab c \x0b"])
def test_white_space_of_any_kind_is_stripped(spark, raw):
    assert column(spark, "string", [raw], X.clean_upper) == ["AB C"]
    assert column(spark, "string", [raw], X.clean_lower) == ["ab c"]


def test_strip_edge_cases(spark):
    assert column(spark, "string", [None, "", "   ", "é", " ñ ", "\t"], X.strip_space) == [None, "", "", "é", "ñ", ""]


def test_corridors_need_both_ends(spark):
    rows = spark.createDataFrame([("A", "B"), (None, "B"), ("A", None)], "s string, r string")
    got = rows.select(X.corridor_name(F.col("s"), F.col("r")), X.raw_corridor_label(F.col("s"), F.col("r"))).collect()
    assert [tuple(r) for r in got] == [("A -> B", "A → B"), (None, None), (None, None)]


def test_labels(spark):
    values = [0.0, 12.4, 999.49, 999.5, 1000.0, 12_345.0, 99_999.0, 100_000.0, 250_499.0, 1_000_000.0, 12_345_678.0]
    assert column(spark, "double", values, X.currency_label) == [
        "$0", "$12", "$999", "$1,000", "$1.0K", "$12.3K", "$100.0K", "$100K", "$250K", "$1.00M", "$12.35M",
    ]
    assert column(spark, "double", [0.0, 33.333, 100.0], X.percent_label) == ["0.0%", "33.3%", "100.0%"]


def test_duration_buckets(spark):
    values = [None, 0, 1, 29, 30, 119, 120, 599, 600]
    assert column(spark, "bigint", values, C.duration_bucket) == [
        "no_connection", "no_connection", "very_short", "very_short", "short", "short", "medium", "medium", "long",
    ]


def test_quality_tiers_use_the_unrounded_score(spark):
    values = [None, 1.999, 2.0, 2.996, 3.0, 3.999, 4.0]
    assert column(spark, "double", values, C.quality_tier) == [
        "poor", "poor", "fair", "fair", "good", "good", "excellent",
    ]


def test_size_tiers_and_labels(spark):
    values = [None, 49.99, 50.0, 199.99, 200.0, 499.99, 500.0, 999.99, 1000.0]
    assert column(spark, "double", values, C.size_tier) == [
        "micro", "micro", "small", "small", "medium", "medium", "large", "large", "very_large",
    ]
    assert column(spark, "double", values[1:], C.size_label) == [
        "Micro (<$50)", "Small (<$200)", "Small (<$200)", "Medium (<$500)", "Medium (<$500)",
        "Large (<$1K)", "Large (<$1K)", "Very Large (≥$1K)",
    ]


def test_payment_success(spark):
    values = ["completed", "success", "paid", "pending", "failed", "refunded", None]
    assert column(spark, "string", values, C.payment_succeeded) == [True, True, True, False, False, False, False]


RISK_COLUMNS = "ft bigint, fk bigint, pct double, usd double, big bigint, tickets bigint"


@pytest.mark.parametrize(
    ("row", "level"),
    [
        ((1, 1, None, None, None, None), "CRITICAL_RISK"),
        ((1, 0, 99.0, 9999.0, 9, 9), "HIGH_RISK_FRAUD"),
        ((None, 2, None, None, None, None), "HIGH_RISK_FRAUD"),
        ((0, 0, 30.01, 0.0, 0, 0), "MEDIUM_RISK"),
        ((0, 0, 0.0, 900.01, 0, 0), "MEDIUM_RISK"),
        ((0, 0, 0.0, 0.0, 3, 0), "MEDIUM_RISK"),
        ((0, 0, 30.0, 900.0, 2, 0), "LOW_RISK"),
        ((0, 0, 15.01, 0.0, 0, 0), "LOW_RISK"),
        ((0, 0, 0.0, 0.0, 0, 6), "LOW_RISK"),
        ((0, 0, 15.0, 900.0, 2, 5), "SAFE"),
        ((None, None, None, None, None, None), "SAFE"),
    ],
)
def test_risk_levels(spark, row, level):
    df = spark.createDataFrame([row], RISK_COLUMNS)
    risk = C.fraud_risk_level(
        fraud_transfers=F.col("ft"),
        fraud_tickets=F.col("fk"),
        failure_pct=F.col("pct"),
        transfer_usd=F.col("usd"),
        very_large=F.col("big"),
        tickets=F.col("tickets"),
    )
    assert df.select(risk).first()[0] == level


@pytest.mark.parametrize(
    ("row", "score"),
    [
        ((None, None, None, None), 55.0),
        ((5.0, 5.0, 0.0, "SAFE"), 100.0),
        ((5.0, 5.0, 9.99, "LOW_RISK"), 100.0),
        ((5.0, 5.0, 10.0, "MEDIUM_RISK"), 75.0),
        ((5.0, 5.0, 24.99, "HIGH_RISK_FRAUD"), 65.0),
        ((5.0, 5.0, 25.0, "CRITICAL_RISK"), 55.0),
        ((5.0, 5.0, 49.99, None), 55.0),
        ((5.0, 5.0, 50.0, None), 50.0),
        ((3.33, 4.01, 0.0, "SAFE"), 86.7),
    ],
)
def test_health_scores(spark, row, score):
    df = spark.createDataFrame([row], "q double, s double, f double, r string")
    got = C.health_score(quality=F.col("q"), satisfaction=F.col("s"), failure_pct=F.col("f"), risk_level=F.col("r"))
    assert df.select(got).first()[0] == score


@pytest.mark.parametrize(
    ("row", "segment"),
    [
        ((500.01, 51, 21, 0.0), "VIP"),
        ((500.0, 51, 21, 0.0), "HIGH_VALUE"),
        ((200.01, 0, 0, 0.0), "HIGH_VALUE"),
        ((200.0, 0, 0, 500.01), "HIGH_VALUE"),
        ((200.0, 31, 0, 500.0), "ACTIVE"),
        ((0.0, 30, 11, 0.0), "ACTIVE"),
        ((0.0, 30, 10, 0.0), "REGULAR"),
        ((0.0, 0, 1, 0.0), "REGULAR"),
        ((None, None, None, None), "INACTIVE"),
    ],
)
def test_segments(spark, row, segment):
    df = spark.createDataFrame([row], "p double, c bigint, t bigint, u double")
    got = C.customer_segment(revenue=F.col("p"), calls=F.col("c"), transfers=F.col("t"), transfer_usd=F.col("u"))
    assert df.select(got).first()[0] == segment


@pytest.mark.parametrize(
    ("row", "risk"),
    [
        ((4, 2.99, 20.01), "HIGH_CHURN_RISK"),
        ((4, 2.99, 20.0), "MODERATE_CHURN_RISK"),
        ((4, 3.0, 99.0), "MODERATE_CHURN_RISK"),
        ((4, None, 99.0), "MODERATE_CHURN_RISK"),
        ((3, 5.0, 0.0), "MODERATE_CHURN_RISK"),
        ((2, 2.99, 0.0), "MODERATE_CHURN_RISK"),
        ((2, 3.0, 0.0), "STABLE"),
        ((None, None, None), "STABLE"),
    ],
)
def test_churn(spark, row, risk):
    df = spark.createDataFrame([row], "k bigint, s double, f double")
    got = C.churn_risk(tickets=F.col("k"), satisfaction=F.col("s"), failure_pct=F.col("f"))
    assert df.select(got).first()[0] == risk


@pytest.mark.parametrize(
    ("row", "risk"),
    [
        ((6, 0.01), "HIGH_RISK_CORRIDOR"),
        ((1, 10.01), "HIGH_RISK_CORRIDOR"),
        ((5, 10.0), "MONITOR_CORRIDOR"),
        ((0, 0.0), "SAFE_CORRIDOR"),
    ],
)
def test_corridor_risk(spark, row, risk):
    df = spark.createDataFrame([row], "n bigint, pct double")
    assert df.select(C.corridor_risk(F.col("n"), F.col("pct"))).first()[0] == risk


def test_unit_economics(spark):
    df = spark.createDataFrame([(10.0, 3), (10.0, 0), (10.0, None), (0.05, 2)], "t double, n bigint")
    assert [r[0] for r in df.select(C.unit_value(F.col("t"), F.col("n"))).collect()] == [3.33, 0.0, 0.0, 0.03]
    ltv = spark.createDataFrame([(10.0, None), (10.0, 0.1), (10.0, 0.09)], "p double, u double")
    assert [r[0] for r in ltv.select(C.lifetime_value(F.col("p"), F.col("u"))).collect()] == [10.0, 10.01, 10.0]


def test_signal_buckets_keep_their_off_by_one_labels(spark):
    values = [0, 1, 2, 3, 4, 5, 7, 8, 500]
    assert column(spark, "bigint", values, C.signal_bucket) == ["1", "2", "3", "4-5", "4-5", "6-8", "6-8", "9+", "9+"]


def test_severity_and_label(spark):
    values = ["CRITICAL_RISK", "HIGH_RISK_FRAUD", "MEDIUM_RISK", "LOW_RISK", "SAFE", None]
    assert column(spark, "string", values, C.severity_rank) == [0, 1, 2, 3, 99, 99]
    assert column(spark, "string", values, C.is_fraud_label) == [1, 1, 0, 0, 0, 0]


@pytest.mark.parametrize(
    ("value", "places", "expected"),
    [(2.0049995, 2, 2.01), (2.00499949, 2, 2.0), (-2.0049995, 2, -2.01), (1e13 + 0.5, 0, 1e13 + 1), (1e17, 2, 1e17), (None, 2, None)],
)
def test_one_rounding_rule_for_values_of_any_size(spark, value, places, expected):
    assert column(spark, "double", [value], lambda v: N.round_half_up(v, places)) == [expected]


@pytest.mark.parametrize("value", [float("nan"), float("inf"), float("-inf"), 1e19])
@pytest.mark.parametrize("function", [lambda v: N.round_half_up(v, 2), N.scaled, lambda v: N.scaled(v, 6), N.as_decimal])
def test_values_without_an_exact_number_fail_the_job(spark, value, function):
    with pytest.raises(Exception, match="no exact number for the value"):
        column(spark, "double", [value], function)


def test_large_amounts_are_summed_in_full(spark):
    values = spark.createDataFrame([(1e13,), (5.0,), (1e17,), (None,)], "v double")
    assert values.agg(N.micro_sum(F.col("v"))).first()[0] == 1e17 + 1e13 + 5
    with pytest.raises(Exception, match="no exact number"):
        values.agg(N.exact_sum(F.col("v"))).collect()
    small = values.where("v < 1e15")
    assert small.agg(N.exact_sum(F.col("v"))).first()[0] == 1e13 + 5

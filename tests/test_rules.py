"""Rule tables with boundary rows and every null pattern."""

import pytest
from pyspark.sql import functions as F

from actiflow.functions import rules


def evaluate(spark, schema, rows, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_at_risk_boundaries_and_nulls(spark):
    rows = [
        (30, "Unsatisfied", 3.0),   # days not over 30
        (31, "Unsatisfied", 4.5),   # level alone
        (31, "Satisfied", 3.79),    # rating alone
        (31, "Satisfied", 3.8),     # rating at threshold: not below
        (None, "Unsatisfied", 3.0), # unknown days -> false
        (31, None, 3.7),            # null level, low rating -> true (three-valued OR)
        (31, None, 4.0),            # null level, high rating -> unknown -> false
        (31, "Neutral", None),      # null rating -> false
    ]
    got = evaluate(spark, "d int, s string, r double", rows, rules.at_risk("d", "s", "r"))
    assert got == [False, True, True, False, False, True, False, False]


def test_classic_risk_has_no_rating_clause(spark):
    rows = [(31, "Unsatisfied"), (31, "Neutral"), (30, "Unsatisfied"), (None, "Unsatisfied")]
    df = spark.createDataFrame(rows, "d int, s string")
    assert df.filter(rules.at_risk_classic("d", "s")).count() == 1


def test_high_value(spark):
    got = evaluate(spark, "v double", [(999.99,), (1000.0,), (None,)], rules.high_value("v"))
    assert got == [0, 1, 0]


def test_age_groups(spark):
    got = evaluate(spark, "a int", [(34,), (35,), (50,), (51,), (None,)], rules.age_group("a"))
    assert got == ["Under 35", "Between 35-50", "Between 35-50", "Over 50", "Over 50"]
    got = evaluate(spark, "a int", [(None,)], rules.age_group("a", unknown_label="Unknown"))
    assert got == ["Unknown"]


@pytest.mark.parametrize("rating,days,expected", [
    (4.3, 28, "Satisfied"), (4.3, 29, "Neutral"), (4.29, 20, "Neutral"),
    (3.69, 20, "Unsatisfied"), (3.7, 38, "Neutral"), (3.7, 39, "Unsatisfied"),
    (4.5, None, "Neutral"), (3.0, None, "Unsatisfied"),
])
def test_satisfaction_rule_a(spark, rating, days, expected):
    got = evaluate(spark, "r double, d int", [(rating, days)], rules.satisfaction_a("r", "d"))
    assert got == [expected]


def test_satisfaction_rule_b(spark):
    got = evaluate(spark, "r double", [(4.1,), (4.0,), (3.9,), (None,)], rules.satisfaction_b("r"))
    assert got == ["Satisfied", "Neutral", "Unsatisfied", "Unsatisfied"]


def test_parse_bool(spark):
    rows = [("1",), (" TRUE ",), ("yes",), ("Y",), ("no",), ("",), ("maybe",), (None,)]
    got = evaluate(spark, "t string", rows, rules.parse_bool("t"))
    assert got == [True, True, True, True, False, False, False, False]


def test_clamp_keeps_null(spark):
    got = evaluate(spark, "x int", [(10,), (80,), (40,), (None,)], rules.clamp("x", 18, 70))
    assert got == [18, 70, 40, None]

"""Exact sums and means: the order and the split of rows change nothing."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from actiflow.functions import exact
from actiflow.operators import summaries
from actiflow.operators.enrich import enrich
from actiflow.plans.catalog import activity
from conftest import SF_SMALL


def plain(values, decimals=2):
    kept = [Decimal(repr(v)).quantize(Decimal("0.000001"), ROUND_HALF_UP) for v in values]
    if not kept:
        return None, None
    cent = Decimal(1).scaleb(-decimals)
    return (float(sum(kept).quantize(cent, ROUND_HALF_UP)),
            float((abs(sum(kept)) / len(kept)).quantize(cent, ROUND_HALF_UP).copy_sign(sum(kept))))


def test_exact_ties_round_up_in_every_order(spark):
    # 20 ratings that sum to 79.9: the mean is 3.995 exactly.
    ratings = [4.1, 3.9, 4.0, 4.0, 3.8, 4.2, 4.0, 3.7, 4.3, 4.0] * 2
    ratings[-1] = 3.9
    assert sum(Decimal(str(r)) for r in ratings) == Decimal("79.9")
    for parts in (1, 3, 7):
        for seed in (1, 2, 3):
            rows = spark.createDataFrame([(r,) for r in ratings], "average_rating DOUBLE")
            got = rows.repartition(parts, F.rand(seed)).agg(exact.mean("average_rating").alias("m")).first()
            assert got.m == 4.0


def test_summaries_do_not_depend_on_order_or_split(spark):
    events = enrich(activity(spark, SF_SMALL))
    results = []
    for parts, seed in ((1, 1), (5, 2), (16, 3)):
        mixed = events.repartition(parts, F.rand(seed))
        split = summaries.kpi_partials(mixed).unionByName(summaries.kpi_partials(mixed.limit(0)))
        halves = summaries.kpi_partials(mixed.filter(F.crc32("event_id") % 2 == 0)).unionByName(
            summaries.kpi_partials(mixed.filter(F.crc32("event_id") % 2 == 1)))
        results.append([sorted(map(str, df.collect())) for df in (
            summaries.batch_kpi(mixed), summaries.merge_kpi_partials(split), summaries.merge_kpi_partials(halves),
            summaries.city_summary(mixed), summaries.membership_summary(mixed))])
    assert results[0] == results[1] == results[2]
    assert results[0][0] == results[0][1] == results[0][2]


def test_segment_states_merge_to_the_whole(spark):
    from actiflow.operators.enrich import with_age_group
    events = with_age_group(activity(spark, SF_SMALL))
    for name, keys in summaries.SEGMENT_KEYS.items():
        states = events.groupBy(*keys, "batch_id").agg(*summaries.segment_state())
        got = summaries.merge_segment_state(states, keys)
        assert sorted(map(str, got.collect())) == sorted(map(str, getattr(summaries, name)(events).collect()))


@settings(max_examples=25, deadline=None)
@given(values=st.lists(st.one_of(
    st.floats(-10**9, 10**9), st.integers(-10**6, 10**6).map(lambda c: c / 100),
    st.integers(-10**4, 10**4).map(lambda c: c / 8)), max_size=30))
def test_against_plain_decimals(spark, values):
    rows = spark.createDataFrame([(float(v),) for v in values], "x DOUBLE").repartition(3)
    got = rows.agg(exact.rounded(exact.total("x")).alias("total"), exact.mean("x").alias("mean")).first()
    # Spark reads a double by its shortest decimal text, as plain() does.
    assert (got.total, got["mean"]) == plain([float(v) for v in values])


def test_values_without_a_decimal_do_not_count(spark):
    rows = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (float("inf"),), (1e30,), (2.0,)], "x DOUBLE")
    got = rows.agg(exact.rounded(exact.total("x")).alias("total"), exact.mean("x").alias("mean"),
                   exact.count("x").alias("n"), exact.mean("x", None).alias("raw")).first()
    assert tuple(got) == (3.0, 1.5, 2, 1.5)
    none = rows.limit(0).agg(exact.rounded(exact.total("x")).alias("total"), exact.mean("x").alias("mean")).first()
    assert tuple(none) == (None, None)

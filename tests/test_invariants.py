"""Invariants between results: nothing lost or invented."""

from pyspark.sql import functions as F

from actiflow.operators import ranking, summaries
from actiflow.operators.enrich import enrich, with_age_group
from actiflow.plans.catalog import activity
from conftest import SF_SMALL


def test_group_counts_sum_to_event_count(spark):
    ev = enrich(activity(spark, SF_SMALL)).cache()
    total = ev.count()
    assert summaries.city_summary(ev).agg(F.sum("event_count")).first()[0] == total
    assert summaries.membership_summary(ev).agg(F.sum("event_count")).first()[0] == total
    assert summaries.batch_kpi(ev).agg(F.sum("event_count")).first()[0] == total
    items = ev.agg(F.sum("items_purchased")).first()[0]
    assert summaries.customer_segments(with_age_group(ev)).agg(
        F.sum("total_items_purchased")).first()[0] == items
    ev.unpersist()


def test_at_risk_rows_are_events(spark):
    ev = enrich(activity(spark, SF_SMALL))
    risk = ranking.at_risk_ranked(ev)
    cols = risk.columns
    assert risk.exceptAll(ev.select(*cols)).count() == 0
    assert risk.count() == ev.filter(F.col("is_at_risk")).count()
    classic = ranking.at_risk_classic(ev)
    assert classic.exceptAll(ev.select(*classic.columns)).count() == 0

"""Every registered query equals its SQL oracle (DuckDB) on the smallest tables."""

import importlib.util
import os

import pytest

from conftest import ROOT, SF_SMALL


def _checker():
    spec = importlib.util.spec_from_file_location(
        "check_oracle", os.path.join(ROOT, "scripts", "check_oracle.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_every_query_has_an_oracle():
    from actiflow.plans.catalog import QUERIES
    from actiflow.plans.oracle_sql import ORACLES
    assert set(QUERIES) == set(ORACLES)


def test_all_queries_match_oracle(spark):
    from actiflow.plans.catalog import QUERIES
    result = _checker().compare(spark, SF_SMALL, set(QUERIES), verbose=True)
    bad = {k: v for k, v in result.items() if v != "OK"}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["city", "event_count", "avg_total_spend", "total_items_purchased"]
    assert df.count() > 0


def test_orders(spark):
    """The oracle comparison sorts both sides; here the sequences themselves."""
    import __spark_entry__ as E
    low, high = float("-inf"), float("inf")
    rows = E.queries()["ordered_events"](spark, SF_SMALL).collect()
    assert [(r.event_time, r.event_id) for r in rows] == sorted((r.event_time, r.event_id) for r in rows)
    rows = E.queries()["at_risk_ranked"](spark, SF_SMALL).collect()
    keys = [(-(r.days_since_last_purchase or low), r.average_rating, r.customer_id, r.event_time) for r in rows]
    assert keys == sorted(keys) and len(keys) > 100 and high not in keys[0]
    rows = E.queries()["city_summary"](spark, SF_SMALL).collect()
    keys = [(-r.event_count, r.city) for r in rows]
    assert keys == sorted(keys) or [r.city for r in rows] == sorted(r.city for r in rows)

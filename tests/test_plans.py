"""Plan shape: scans are pruned and filtered at the source; no cartesian or
nested-loop joins; top-k is a bounded per-task sort."""

import pytest

import __spark_entry__ as E
from actiflow.plans.catalog import QUERIES
from conftest import SF_SMALL

# Queries that run streams eagerly when called; their plans are reads of the store.
EAGER = {"stream_events", "stream_kpis", "stream_segments", "stream_city_segments", "late_events",
         "trigger_counts"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cartesian_or_nested_loop(spark, name):
    text = plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def formatted(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_orders_scan_reads_only_needed_columns(spark):
    text = formatted(E.queries()["city_summary"](spark, SF_SMALL))
    schemas = [line for line in text.splitlines()
               if line.startswith("ReadSchema") and "o_orderkey" in line]
    assert schemas, text
    for line in schemas:
        assert "o_orderpriority" not in line and "o_orderstatus" not in line
    assert "PushedFilters: [IsNotNull(o_custkey)]" in text


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(E.queries()["top_at_risk"](spark, SF_SMALL))

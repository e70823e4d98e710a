"""Plan shape of the training-data queries that are one plan: no cartesian or nested-loop joins."""

import pytest

from actiflow.llm.queries import QUERIES
from conftest import SF_SMALL


@pytest.mark.parametrize("name", ["op1_sentencepiece", "op6_secrets", "op9_mixing", "op10_quality_rules", "op11_ring",
                                  "op12_prefix_trie"])
def test_no_cartesian_or_nested_loop(spark, name):
    text = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text

"""Golden counts on the 350-row seed table.

The seed CSV is not part of this repository; point ACTIFLOW_SEED_CSV at it to
run the check (skipped otherwise).
"""

import os

import pytest
from pyspark.sql import functions as F

from actiflow.functions import rules
from actiflow.plans.synth import typed_seed
from actiflow.sources.events import read_seed

SEED = os.environ.get("ACTIFLOW_SEED_CSV", "")


@pytest.mark.skipif(not (SEED and os.path.exists(SEED)), reason="ACTIFLOW_SEED_CSV not set")
def test_seed_golden_counts(spark):
    seed = typed_seed(read_seed(spark, SEED)).cache()
    assert seed.count() == 350
    assert seed.filter(rules.at_risk()).count() == 118
    assert seed.filter(rules.at_risk_classic()).count() == 116
    assert seed.filter(F.col("total_spend") >= 1000).count() == 117
    assert seed.filter(F.col("discount_applied")).count() == 175
    by_city = {r[0]: r[1] for r in seed.groupBy("city").count().collect()}
    assert sorted(by_city.values()) == [58, 58, 58, 58, 59, 59]


def test_empty_seed_fails(spark, workdir):
    path = os.path.join(workdir, "empty.csv")
    with open(path, "w") as fh:
        fh.write("Customer ID,Gender\n")
    with pytest.raises(ValueError):
        read_seed(spark, path)


def test_seed_with_bom_and_text_booleans(spark, workdir):
    path = os.path.join(workdir, "seed.csv")
    header = ("Customer ID,Gender,Age,City,Membership Type,Total Spend,Items Purchased,"
              "Average Rating,Discount Applied,Days Since Last Purchase,Satisfaction Level\n")
    with open(path, "w", encoding="utf-8-sig") as fh:   # writes a BOM
        fh.write(header)
        fh.write("9001,Female,52,Springfield,Gold,64.5,2,1.5,TRUE,3,Neutral\n")
        fh.write("9002,Male,x,Shelbyville,Bronze,2.25,1,2.75,FALSE,99,\n")
    rows = typed_seed(read_seed(spark, path)).orderBy("customer_id").collect()
    assert [r["customer_id"] for r in rows] == [9001, 9002]
    assert rows[0]["discount_applied"] is True and rows[1]["discount_applied"] is False
    assert rows[1]["age"] is None                      # bad number -> null, row kept
    assert rows[1]["satisfaction_level"] is None       # blank level

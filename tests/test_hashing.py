"""Hashed uniforms equal an independent computation of their formula."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from actiflow.functions import hashing


def py_uniform(seed, index, tag):
    digest = hashlib.md5(f"{seed}:{index}:{tag}".encode()).hexdigest()
    return int(digest[:8], 16) / 2 ** 32


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), tag=st.sampled_from(["pick", "spend", "age", "x y"]))
def test_uniform_matches_formula(spark, seed, tag):
    df = spark.range(0, 300).select(F.col("id").alias("i"))
    got = {r["i"]: r["u"] for r in
           df.select("i", hashing.uniform(seed, "i", tag).alias("u")).collect()}
    assert got == {i: py_uniform(seed, i, tag) for i in range(300)}


def test_randint_and_choice_stay_in_range(spark):
    df = spark.range(1, 5001).select(F.col("id").alias("i"))
    r = df.agg(F.min(hashing.randint(1, "i", "t", -6, 8)), F.max(hashing.randint(1, "i", "t", -6, 8)),
               F.countDistinct(hashing.choice(1, "i", "c", ["a", "b", "c"]))).first()
    assert (r[0], r[1], r[2]) == (-6, 8, 3)

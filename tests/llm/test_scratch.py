"""Tables that operators store are deleted with their scope; the pipeline leaves its result only."""

import glob
import os

from pyspark.sql import functions as F

import corpus_pipeline
from actiflow.llm.common import scratch, stored
from actiflow.session import checkpoint_dir
from conftest import SF_SMALL


def tables(spark, purpose):
    return [p for p in glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/actiflow/{purpose}/*") if os.path.isdir(p)]


def test_scope_deletes_what_was_stored_in_it(spark):
    outside = stored(spark.range(3), "scratch_test")
    before = len(tables(spark, "scratch_test"))
    with scratch(spark):
        assert stored(spark.range(5), "scratch_test").count() == 5
        assert len(tables(spark, "scratch_test")) == before + 1
    assert len(tables(spark, "scratch_test")) == before and outside.count() == 3


def test_pipeline_leaves_its_result_only(spark):
    names = [f"pipeline_{n}" for n, _ in corpus_pipeline.STAGES] + ["links", "mix_sources", "mix_targets"]
    before = {n: len(tables(spark, n)) for n in names}
    result = corpus_pipeline.run(spark, SF_SMALL)
    assert result.count() > 0 and result.agg(F.count("text")).first()[0] > 0
    after = {n: len(tables(spark, n)) - before[n] for n in names}
    assert after == {n: int(n == names[len(corpus_pipeline.STAGES) - 1]) for n in names}


def test_pipeline_on_odd_tables(spark, tmp_path):
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    good = " ".join(f"w{i}" for i in range(40))
    rows = {"empty": [], "odd": [(1, None, "en", "a", None), (2, "", "en", "a", 0), (None, good, "en", None, 9),
                                 (3, good + " token=abcdef123456", "en", "b", 9), (3, good[::-1], "en", "b", 9),
                                 (4, good + " more", None, "b", 9)]}
    for name, table in rows.items():
        spark.createDataFrame(table, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert (len(out) > 0) == (name == "odd")
        assert all(len(r.piece_ids) > 0 and "abcdef123456" not in r.text for r in out)

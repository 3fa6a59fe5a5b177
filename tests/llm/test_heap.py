"""Stages of the pipeline begin with a heap that holds no garbage of the ones before."""

import corpus_pipeline
import pytest
from lakewarden.llm.common import return_heap

DOCS = [(1, "The keys lie under the mat beside the door of the house.", "en", "src1", 56), (2, None, None, None, None), (None, "", "en", None, 0), (3, "A short text.", "de", "src2", 13)]
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def full_collections(spark):
    """Full collections so far of the JVM, which here is the driver's and the executor's."""
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(b.getCollectionCount() for b in beans if any(x in b.getName() for x in ("Old", "MarkSweep")))


def test_all_garbage_is_collected(spark):
    before = full_collections(spark)
    return_heap(spark)
    assert full_collections(spark) > before


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_each_stage_begins_with_a_collection(spark, tmp_path, stage):
    docs = spark.createDataFrame(DOCS, COLUMNS)
    spark.createDataFrame([(1, 1, 0), (3, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "Where do the keys lie? Under the mat.")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    before = full_collections(spark)
    dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path))
    assert full_collections(spark) > before

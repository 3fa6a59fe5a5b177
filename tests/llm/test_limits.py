"""What must not depend on size, number or names."""

import numpy as np
import pyarrow as pa

from lakewarden.llm import langid, quality


def test_every_language_is_learned(spark):
    rows = [(100 * k + n, f"w{k}x" * 3 + f" q{k}z{n} w{k}x", f"l{k}") for k in range(130) for n in range(4 if k else 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    sample = {r["lang"] for r in langid.training_sample(docs, 600, 60_000).select("lang").distinct().collect()}
    assert sample == {f"l{k}" for k in range(130)}
    fewer = {r["lang"]: r["count"] for r in langid.training_sample(docs, 600, 130 * 10).groupBy("lang").count().collect()}
    assert len(fewer) == 130 and fewer["l0"] < 25


def test_distinct_words_of_long_texts_count_once():
    words = [f"word{n:04d}" for n in range(500)]
    short, long_ = " ".join(words * 200), " ".join(words * 640)
    assert len(short) < 1 << 20 < len(long_) // 2
    views = quality.text_view(pa.array([short, long_, "some other text", long_]))
    place = len(quality.KINDS)
    shares = views[:, place] * np.array([100_000, 320_000, 3, 320_000])
    assert np.allclose(shares, [500, 500, 3, 500], rtol=1e-3)


def test_a_clashing_column_of_the_quality_stage(spark):
    rows = [(n, f"text number {n} of many", "en", "s", 20, "mine", n) for n in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, _page_view string, last int")
    labels = spark.createDataFrame([(n, n % 2) for n in range(20)], "doc_id bigint, quality int")
    kept = quality.keep_good(docs, quality.fit(docs, labels), 0.0)
    assert kept.columns == docs.columns
    assert sorted(kept.collect()) == sorted(docs.collect())


def test_the_quality_stage_works_on_parts_of_a_batch(spark):
    rows = [(n, f"text number {n} of many " * (n % 7), "en", "s", n % 90) for n in range(2500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([(n, n % 2) for n in range(500)], "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    batch = docs.select("*", quality.page_view()).toArrow().combine_chunks().to_batches()[0]
    parts = list(quality._mark(model, 0.0, iter([batch])))
    assert [part.num_rows for part in parts] == [1000, 1000, 500]
    assert pa.Table.from_batches(parts).column("doc_id").to_pylist() == batch.column("doc_id").to_pylist()

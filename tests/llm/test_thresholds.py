"""Near duplicates at thresholds other than the default."""

import random

import pytest

import corpus_pipeline
from lakewarden.llm.neardup import LINKED, REGISTERS, bands_of, near_duplicates
from tests.llm import brute


def _pairs():
    """Texts of 104 words, 100 shingles, and copies whose last words differ: similarity (100 - k) / (100 + k)."""
    rng = random.Random(4)
    docs, expected = {}, {}
    for k in (5, 8, 9, 11, 12, 30):
        words = [f"term{rng.randrange(10**6)}" for _ in range(104)]
        number = 10 * len(expected)
        docs[number] = " ".join(words)
        docs[number + 1] = " ".join(words[: 104 - k] + [f"edit{rng.randrange(10**6)}" for _ in range(k)])
        expected[number] = (100 - k) / (100 + k)
    return docs, expected


@pytest.mark.parametrize("linked", [80, LINKED])
def test_pairs_around_the_threshold(spark, linked):
    docs, similarity = _pairs()
    sets = {n: set(brute.shingles(t)) for n, t in docs.items()}
    for n, x in similarity.items():
        assert len(sets[n] & sets[n + 1]) / len(sets[n] | sets[n + 1]) == pytest.approx(x)
    found = near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string"), linked).collect()
    together = {r["component_id"] for r in found if not r["kept"]}
    assert together == {n for n, x in similarity.items() if x >= linked / 100}


@pytest.mark.parametrize("linked", [80, LINKED])
def test_stage_drops_pairs_from_its_threshold_on(spark, linked):
    docs, similarity = _pairs()
    left = corpus_pipeline.near_dedup_stage(spark, spark.createDataFrame(list(docs.items()), "doc_id bigint, text string"), "", linked)
    assert {r["doc_id"] for r in left.collect()} == set(docs) - {n + 1 for n, x in similarity.items() if x >= linked / 100}


@pytest.mark.parametrize("linked", [50, 80, 85, 95])
def test_bands_miss_next_to_no_pair(linked):
    bands, rows = bands_of(linked)
    assert bands * rows == REGISTERS and (1 - (linked / 100) ** rows) ** bands <= 1e-6

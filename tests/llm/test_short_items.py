"""Benchmark items of few words, with numbers, and in scripts without spaces."""

import pytest

from lakewarden.llm.decontaminate import contaminated, keep_clean

FILL = "words of a long document about the weather that goes on and on without an end in sight. " * 3
HAN = "\u4e2d\u56fd\u7684\u9996\u90fd\u662f\u54ea\u91cc\uff1f\u5317\u4eac\u3002"
ITEMS = [
    (1, "Photosynthesis chlorophyll"),
    (2, "What is 12 * 7? 84"),
    (3, "A train with forty blue wagons leaves the old town at noon and drives 360 kilometres in 4 hours without a stop on the way. How fast is it? 90"),
    (4, HAN),
    (5, "1789"),
]
TEXTS = {
    1: "the photosynthesis, chlorophyll",
    2: "what is 12 * 7? 84",
    3: ITEMS[2][1],
    4: "\u6211\u5728\u6b64" + HAN + "\u5929\u6c14",
    5: "in 1789",
    # Clean: other words, order or numbers.
    11: "chlorophyll and then photosynthesis",
    12: "what is 12 * 7? 85",
    13: ITEMS[2][1].replace("360", "450").replace("90", "112"),
    14: "\u4eca\u5929\u5929\u6c14\u5f88\u597d\u3002\u5317\u4eac",
    15: "in 17890",
}


@pytest.fixture(scope="module")
def tables(spark):
    docs = [(n, f"{FILL}{text} {FILL}") for n, text in TEXTS.items()]
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(ITEMS, "item_id bigint, text string")


def test_items_are_found_with_their_own_numbers_only(tables):
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(*tables).collect()} == {(n, n) for n, _ in ITEMS}


def test_clean_documents_stay(tables):
    assert {r["doc_id"] for r in keep_clean(*tables).collect()} == {n for n in TEXTS if n > 10}

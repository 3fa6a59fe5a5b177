"""Every operator and stage on odd rows, empty tables and clashing columns."""

import math
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lakewarden.llm.queries import ORACLE, QUERIES
from tests.llm import brute


def _documents(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def rows(spark, odd_dir):
    return _documents(spark, odd_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables_give_no_rows(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == 0


@pytest.mark.parametrize("name", ["op1_toxicity", "op4_language_id", "op6_quality"])
def test_every_row_is_scored(spark, odd_dir, rows, name):
    found = QUERIES[name](spark, odd_dir).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(n for n, _ in rows)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_texts_without_letters_is_unknown(spark, odd_dir, rows):
    found = {r["doc_id"]: r for r in QUERIES["op4_language_id"](spark, odd_dir).collect()}
    for number, text in rows:
        if number is not None:
            assert (found[number]["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))


def test_token_files_hold_all_documents(spark, odd_dir, rows):
    found = QUERIES["op2_token_files"](spark, odd_dir).orderBy("start").collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = defaultdict(set)
    for number, text in rows:
        ids[number].add(tuple([*library.encode(text or "", add_special_tokens=False).ids, 1]))
    assert Counter(r["doc_id"] for r in found) == Counter(n for n, _ in rows)
    numbers = [r["doc_id"] for r in found]
    assert numbers == sorted(numbers, key=lambda n: (n is not None, n))
    start = 0
    for r in found:
        assert (r["n_tokens"], r["ids_crc32"]) in {(len(i), brute.crc(i)) for i in ids[r["doc_id"]]}
        assert r["start"] == start
        start += r["n_tokens"]


def test_contamination_of_planted_items(spark, odd_dir, rows):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{odd_dir}/benchmark.parquet").collect() if r["text"]}
    planted = {(n, i) for n, text in rows for i, item in items.items() if text and len(item) > 40 and item in text}
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op3_decontaminate"](spark, odd_dir).collect()}
    assert planted and planted == found


def test_personal_data_of_every_row(spark, odd_dir, rows):
    found = {r["doc_id"]: r for r in QUERIES["op5_pii"](spark, odd_dir).collect()}
    for number, text in rows:
        spans = brute.base_spans(text)
        own = [s for s in found[number]["spans"].split(",") if s and s.split(":")[0] in brute.PATTERNS]
        assert own == spans
        counts = [found[number][f"n_{kind}"] for kind in brute.PATTERNS]
        assert counts == [sum(s.startswith(kind) for s in spans) for kind in brute.PATTERNS]


def test_near_duplicates_of_every_row(spark, odd_dir, rows):
    expected = brute.components({n: t for n, t in rows if n is not None})
    found = QUERIES["op7_near_duplicates"](spark, odd_dir).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for r in found:
        assert r["n_shingles"] == len(brute.shingles(texts[r["doc_id"]]))
        assert r["component_id"] == expected.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] is None or expected[r["doc_id"]] == r["doc_id"])


def test_top_k_against_all_products(spark, odd_dir):
    vectors = {}
    for r in spark.read.parquet(f"{odd_dir}/embeddings.parquet").collect():
        v = r["embedding"]
        if r["vec_id"] is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors[r["vec_id"]] = [math.floor(256 * x) for x in v]
    expected = set()
    for q, a in vectors.items():
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), c) for c, b in vectors.items() if c != q)
            expected |= {(q, k + 1, c, -s) for k, (s, c) in enumerate(scored[:5])}
    found = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in QUERIES["op8_top_k"](spark, odd_dir).collect()]
    assert set(found) == expected and len(found) == len(expected)


def test_packing_of_every_row(spark, odd_dir, rows):
    found = QUERIES["op9_best_fit_packing"](spark, odd_dir).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {(n, t): [*library.encode(t or "", add_special_tokens=False).ids, 0] for n, t in rows}
    expected = Counter()
    for (number, text), copies in Counter(rows).items():
        own = ids[number, text]
        bounds = [0, *range(len(own) % 2048 or 2048, len(own) + 1, 2048)]
        for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            expected[number, k, a, b - a, brute.crc(own[a:b])] += copies
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == expected
    places = defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048


def test_repeated_passages_of_every_row(spark, odd_dir, rows):
    found = QUERIES["op10_substring_dedup"](spark, odd_dir).collect()
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found)
    assert got == Counter(brute.repeats(rows))


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stages_keep_columns_and_take_empty_tables(spark, odd_dir, empty_dir, stage):
    function = dict(corpus_pipeline.STAGES)[stage]
    for folder in (odd_dir, empty_dir):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        out = function(spark, docs, folder)
        assert stage == "packing" or out.columns == docs.columns
        assert (out.count() > 0) == (folder == odd_dir)


def test_stages_drop_what_their_operators_find(spark, odd_dir, rows):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    expected = brute.components({n: t for n, t in rows if n is not None}, 80)
    left = Counter(r["doc_id"] for r in stages["near_dedup"](spark, docs, odd_dir).collect())
    assert left == Counter(n for n, _ in rows if n is None or expected[n] == n)
    bad = {r["doc_id"] for r in QUERIES["op3_decontaminate"](spark, odd_dir).collect()}
    left = Counter(r["doc_id"] for r in stages["decontamination"](spark, docs, odd_dir).collect())
    assert left == Counter(n for n, _ in rows if n not in bad)


def test_personal_data_is_replaced_and_clean_texts_stay(spark, odd_dir, rows):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    out = Counter((r["doc_id"], r["text"]) for r in dict(corpus_pipeline.STAGES)["pii"](spark, docs, odd_dir).collect())
    clean = Counter((n, t) for n, t in rows if not brute.base_spans(t))
    assert clean <= out and sum(out.values()) == len(rows)
    new = dict(out.keys() - clean.keys())
    assert new and not any(brute.base_spans(t) for t in new.values())


def test_pipeline_runs_on_odd_and_empty_tables(spark, odd_dir, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0
    pieces = corpus_pipeline.run(spark, odd_dir)
    assert 0 < pieces.count()


def test_top_k_oracle_is_registered():
    assert set(ORACLE) <= set(QUERIES)


def test_near_copies_of_every_degree(spark):
    rng = random.Random(11)
    texts = dict(enumerate(t for _ in range(6) for t in brute.family(rng) * 2))
    from lakewarden.llm.neardup import near_duplicates

    found = near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == brute.components(texts)

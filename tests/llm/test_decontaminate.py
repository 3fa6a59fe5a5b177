"""Retrieval against a search without bounds, shards, edited copies and numbers."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lakewarden.llm import decontaminate as dc

RNG = random.Random(31)
WORDS = ["".join(RNG.choice("bcdfglmnprst") + RNG.choice("aeiou") for _ in range(3)) for _ in range(400)] + ["the", "of", "a"] * 60


def _sentence(count):
    return " ".join(RNG.choice(WORDS) for _ in range(count))


ITEMS = [(n, f"{_sentence(RNG.randint(4, 150))}? {_sentence(RNG.randint(1, 8))}.") for n in range(90)]


def _edited(text, share, rng):
    words = text.split()
    for place in rng.sample(range(len(words)), round(share * len(words))):
        words[place] = "edit" + "".join(rng.choice("abcdefgh") for _ in range(6))
    return " ".join(words)


def _documents(share, count=60):
    rng = random.Random(32)
    return {n: f"{_sentence(150)} {_edited(ITEMS[n][1], share, rng)} {_sentence(90)}" for n in range(count)}


def test_retrieval_is_that_of_a_search_without_bounds(monkeypatch):
    monkeypatch.setattr(dc, "BOTH", 0.0)
    index, texts = dc.build_index(ITEMS, 0.3), list(_documents(0.4).values())
    found = {(row, item): score for row, item, score, *_ in dc._matches(index, index.slots(), pa.array(texts), 0.3)}
    # Every passage against every segment, from the definition.
    pieces = [(at, piece) for at, (_, text) in enumerate(ITEMS) for piece in dc.segments_of(dc.word_hashes(text))]
    df = defaultdict(int)
    for _, piece in pieces:
        for term in set(piece.tolist()):
            df[term] += 1
    mean = sum(len(p) for _, p in pieces) / len(pieces)
    expected = {}
    for row, text in enumerate(texts):
        hashes = dc.word_hashes(text).tolist()
        for start in range(0, len(hashes), dc.SEGMENT):
            here = set(hashes[start : start + 2 * dc.SEGMENT])
            for at, piece in pieces:
                own = piece.tolist()
                weight = {
                    t: np.log1p((len(pieces) - df[t] + 0.5) / (df[t] + 0.5)) * own.count(t) * 2.2 / (own.count(t) + 1.2 * (0.25 + 0.75 * len(own) / mean))
                    for t in set(own)
                }
                share = sum(w for t, w in weight.items() if t in here) / sum(weight.values())
                if share >= 0.3:
                    expected[row, at] = max(expected.get((row, at), 0), share)
    assert found.keys() == expected.keys() and len(found) > 60
    assert all(found[k] == pytest.approx(v) for k, v in expected.items())


def test_shards_do_not_change_the_result(spark):
    docs = spark.createDataFrame(list(_documents(0.1).items()), "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS[:12], "item_id bigint, text string")
    results = []
    for shard in (2, 20_000):
        rows = dc.contaminated(docs, items, shard=shard).collect()
        results.append({(r["doc_id"], r["item_id"]): (round(r["score"], 9), r["question_share"], r["answer_share"]) for r in rows})
    assert results[0] == results[1] and len(results[0]) >= 10


@pytest.mark.parametrize(("share", "least"), [(0.0, 1.0), (0.05, 0.95), (0.1, 0.95)])
def test_edited_copies_are_found(share, least):
    index, docs = dc.build_index(ITEMS), _documents(share)
    found = {(row, index.items[item]) for row, item, *_ in dc._matches(index, index.slots(), pa.array(list(docs.values())), dc.THRESHOLD)}
    assert sum((n, n) in found for n in docs) >= least * len(docs)
    assert all(row == item for row, item in found)


def test_numbers_are_one_word_however_they_are_written():
    assert dc.word_hashes("sold 12,000 cars, 1,234,567 in all").tolist() == dc.word_hashes("sold 12000 cars 1234567 in all").tolist()
    assert dc.word_hashes("in 1,2 or 3,4567").tolist() == dc.word_hashes("in 1 2 or 3 4567").tolist()
    item = "The yearly output of the plant rose to 12,000 units in the second year after the new line had been opened there. How many units were that? 12,000"
    index = dc.build_index([(1, item), *ITEMS])
    leaked = f"{_sentence(60)} {item.replace('12,000', '12000')} {_sentence(60)}"
    other = leaked.replace("12000", "15000")
    found = {(row, index.items[i]) for row, i, *_ in dc._matches(index, index.slots(), pa.array([leaked, other]), dc.THRESHOLD)}
    assert found == {(0, 1)}


@pytest.mark.parametrize("blocks", [1, 7, 10_000])
@pytest.mark.parametrize("threshold", [0.15, 0.4, 0.8])
def test_pivots_find_what_scoring_every_segment_finds(monkeypatch, blocks, threshold):
    monkeypatch.setattr(dc, "BLOCKS", blocks)
    index, rng = dc.build_index([*ITEMS, *[(100 + n, text) for n, text in ITEMS[:5]]], threshold), random.Random(33)
    count = len(index.owner)
    numbers, terms, expected = [], [], {}
    for number in range(3, 400, 2):
        at = rng.randrange(count)
        there = np.flatnonzero(index.segments == at)
        own = np.searchsorted(index.starts, there, side="right") - 1
        own = own[[rng.random() < 0.5 for _ in own]].tolist() + rng.choices(range(len(index.terms)), k=30)
        own = np.unique(own)
        scores = np.zeros(count)
        for term in own:
            postings = slice(index.starts[term], index.starts[term + 1])
            scores[index.segments[postings]] += index.weights[postings]
        best = {}
        for segment in np.flatnonzero(scores >= threshold):
            item = int(index.owner[segment])
            best[item] = max(best.get(item, 0), scores[segment])
        if best:
            expected[number] = best
        numbers += [number] * len(own)
        terms += own.tolist()
    found = dict(dc._retrieve(index, np.array(numbers), np.array(terms), threshold))
    assert expected and {n: found[n].keys() for n in found} == {n: expected[n].keys() for n in expected}
    assert all(found[n][item] == pytest.approx(score) for n, best in expected.items() for item, score in best.items())

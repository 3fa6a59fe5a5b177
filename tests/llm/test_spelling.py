"""Spelling variants against pairs found by leaving letters out."""

import random
import zlib

import numpy as np
import pytest

from lakewarden.llm import spelling
from lakewarden.llm.queries import QUERIES
from tests.llm import brute


def test_every_word_of_the_odd_table(spark, odd_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{odd_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op13_spelling_variants"](spark, odd_dir).collect()
    expected = brute.spellings(rows)
    assert len(found) == len(expected) > 500
    assert {r["word"]: tuple(r)[1:] for r in found} == expected


def test_long_texts_long_words_and_letters_beyond_ascii(spark):
    rows = [
        (None, "Straßenbahn " * 40 + "straßenbahm " * 6),
        (None, None),
        (1, "y" * 3_000_000 + " " + ("z" * 70 + " ") * 9 + ("z" * 71 + " ") * 50),
        (2, "Éa×÷ïöß " * 30 + "éa×÷ïöß" + " éa×÷ïöx" * 200),
        (3, "chains " * 5 + "chainss " * 30 + "chainsss " * 160 + "chainssss " * 900),
        (3, "abcdef " * 6),
        (3, "abcdef " * 6),
    ]
    found = spelling.spelling_variants(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["word"]: tuple(r)[1:] for r in found} == brute.spellings(rows)
    assert {r["root"] for r in found if r["word"].startswith("chain")} == {"chainssss"}


@pytest.mark.parametrize("part", [3, 50])
def test_cells_of_many_words_are_split(spark, monkeypatch, part):
    monkeypatch.setattr(spelling, "PART", part)
    monkeypatch.setattr(spelling, "SPLIT_CELLS", 10**6)
    rng = random.Random(5)
    names = {"".join(rng.choice("agms") for _ in range(rng.choice([6, 7]))) for _ in range(700)}
    words = spark.createDataFrame([(w, rng.randint(5, 900)) for w in sorted(names)], "word string, n bigint")
    n = dict(map(tuple, words.collect()))
    found = {r["word"]: tuple(r)[1:] for r in spelling.near_words(words).collect()}

    def edit(a, b):
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    for word in n:
        near = [w for w in n if edit(word, w)]
        best = min(near, key=lambda w: (-n[w], w), default=None)
        assert found.get(word) == ((len(near), best, n[best]) if near else None)


def test_hash_of_prefix_and_word():
    rng = random.Random(6)
    words = [bytes(rng.randrange(256) for _ in range(rng.randrange(65))) for _ in range(200)]
    prefix = [b"%d:" % rng.randrange(10**12) for _ in words]
    own, before = (np.array([zlib.crc32(x) for x in some], np.uint32) for some in (words, prefix))
    got = spelling.crc_after(before, np.array([len(w) for w in words]), own)
    assert got.tolist() == [zlib.crc32(p + w) for p, w in zip(prefix, words, strict=True)]

"""Packing by minimum bin slack against enumeration, plain encoding and its own promises."""

import itertools
import random
from collections import Counter, defaultdict

import public_tokenizers
from tokenizers import Tokenizer

from lakewarden.llm import slack
from lakewarden.llm.queries import QUERIES
from tests.llm import brute


def test_fill_is_the_closest_sum():
    rng = random.Random(2)
    for _ in range(400):
        counts = {rng.randint(1, 40): rng.randint(1, 4) for _ in range(rng.randint(0, 6))}
        room = rng.randint(0, 120)
        taken = slack.closest_fill(counts, room)
        sums = (sum(map(int.__mul__, counts, own)) for own in itertools.product(*[range(c + 1) for c in counts.values()]))
        assert all(0 < times <= counts[n] for n, times in taken.items())
        assert sum(n * times for n, times in taken.items()) == max(s for s in sums if s <= room)


def _packed(lengths, capacity, waiting):
    pieces = ((number, 0, n) for number, n in enumerate(lengths))
    return list(slack.windows(pieces, capacity, waiting))


def test_no_sequence_is_padded_and_no_id_lost():
    rng = random.Random(3)
    for lengths in ([], [1], [1500] * 900, [rng.randint(1, 2048) for _ in range(3000)], [2048] * 3, [7] * 5000, [2047, 2047]):
        out = _packed(lengths, 2048, 50_000)
        sizes = [sum(p[2] for p in own) for own in out]
        assert all(s == 2048 or s & (s - 1) == 0 for s in sizes) and sum(sizes) == sum(lengths)
        assert sum(s < 2048 for s in sizes) <= 11
        parts = defaultdict(list)
        for own in out:
            for number, start, length in own:
                parts[number].append((start, length))
        for number, n in enumerate(lengths):
            end = 0
            for start, length in sorted(parts[number]):
                assert start == end and length > 0
                end += length
            assert end == n


def test_few_documents_are_cut():
    rng = random.Random(4)
    lengths = [rng.randint(1, 1000) for _ in range(5000)]
    assert sum(len(own) for own in _packed(lengths, 2048, 500_000)) <= len(lengths) + 20


def test_pieces_hold_the_ids_of_every_row(spark, odd_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{odd_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op12_slack_packing"](spark, odd_dir).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = defaultdict(set)
    for number, text in rows:
        ids[number].add(tuple([*library.encode(text or "", add_special_tokens=False).ids, 1]))
    covered, places = Counter(), defaultdict(list)
    for r in found:
        own = {i for i in ids[r["doc_id"]] if len(i) == r["doc_tokens"]}
        crcs = {brute.crc(i[r["start"] : r["start"] + r["length"]]) for i in own}
        assert r["ids_crc32"] in crcs
        covered[r["doc_id"], r["doc_tokens"]] += r["length"]
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    expected = Counter()
    for number, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids) + 1
        expected[number, n] += n
    assert covered == expected
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end == 2048 or (end < 2048 and end & (end - 1) == 0)

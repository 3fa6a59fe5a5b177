"""Links at the threshold, and groups whose members all but link."""

import random
import time
from collections import Counter

from lakewarden.llm import neardup


def test_no_pair_at_the_threshold_is_lost(spark):
    rng = random.Random(21)
    rows = []
    for pair in range(30_000):
        # 34 of 40 shingles are shared.
        common = " ".join(f"w{rng.randrange(10**9)}" for _ in range(38))
        rows += [(2 * pair + k, common + f" x{pair}{k} y{pair}{k} z{pair}{k}") for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    found = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, 85).collect()}
    assert all(found[n] == n - n % 2 for n in found) and len(found) == len(rows)


def test_a_large_template_group_below_the_threshold(spark):
    rng = random.Random(22)
    template = " ".join(f"t{n}" for n in range(104))
    # Any two share 100 of 122 shingles. Copies of one text, and one family above the threshold, stand among them.
    texts = [template + "".join(f" o{rng.randrange(10**9)}" for _ in range(11)) for _ in range(20_000)]
    family = [f"{texts[0]} e{n}" for n in range(300)]
    rows = list(enumerate(texts + family + texts[5:8] * 50))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    start = time.time()
    found = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, 85).collect()}
    sizes = Counter(found.values())
    assert sizes[0] == 301 and all(sizes[n] == 51 for n in (5, 6, 7)) and len(sizes) == 20_000
    assert time.time() - start < 300


def test_slack_is_wide_enough_for_every_threshold():
    for linked in (80, 85, 90, 95):
        assert 0.1 < neardup.slack_of(linked) < 0.25

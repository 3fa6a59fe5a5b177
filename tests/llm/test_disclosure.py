"""Terms that give personal data away by what values share, at any length, in every document."""

import random

from lakewarden.llm import pii


def _spans(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(docs).collect()}
    return found, {r["doc_id"]: r["text"] for r in pii.sanitize(docs).collect()}


def _others(count=400):
    return [(1000 + i, f"common words about weather, the clerk wrote today, thanks and text {i}") for i in range(count)]


def test_values_of_one_domain_are_evidence_together(spark):
    rows = [(i, f"text {i} about weather. The zanzibarian clerk wrote and person{i}@corp.example wrote today, thanks") for i in range(6)]
    rows.append((50, "text about weather, the zanzibarian clerk wrote today"))
    found, clean = _spans(spark, rows + _others())
    start = rows[0][1].index("zanzibarian")
    assert f"remove:{start}:{start + 11}" in found[0].split(",")
    # No value stands here, but the term still points at the domain.
    start = rows[-1][1].index("zanzibarian")
    assert found[50] == f"remove:{start}:{start + 11}"
    assert clean[50] == "text about weather, the  clerk wrote today"
    assert not any(found[n] for n, _ in _others())


def test_short_and_distant_terms(spark):
    gap = "common words about the weather and text, thanks. " * 4
    rows = [(i, f"text {i} Bob {gap} and +44 20 7946 0{i}58 wrote") for i in range(6)]
    rows += [(20 + i, f"text {i} \u674e wrote, 10.20.{i}.7 wrote") for i in range(6)]
    found, _ = _spans(spark, rows + _others())
    assert all(f"remove:7:{end}" in found[n].split(",") for n, end in ((0, 10), (20, 8)))


def test_one_text_ties_nothing(spark):
    rows = [(i, "the zanzibarian clerk wrote ann@corp.example today") for i in range(3)]
    found, _ = _spans(spark, rows + _others())
    assert all("remove" not in s and "generalise" not in s for s in found.values())


def test_common_words_near_values_stay(spark):
    rows = [(i, f"please contact us at person{i}@example.com for the match report number {i}") for i in range(50)]
    clean = [(500 + i, f"players contact the ball in the match and text {i}") for i in range(60)]
    found, texts = _spans(spark, rows + clean + _others(2900))
    assert not any(found[n] for n, _ in clean)
    assert all(texts[n] == text for n, text in clean)


def test_near_copies_are_one_piece_of_evidence(spark):
    rng = random.Random(9)
    base = [f"rare{chr(97 + n // 26)}{chr(97 + n % 26)}word" for n in range(60)]
    rows = []
    for i in range(40):
        words = list(base)
        words[rng.randrange(60)] = "edited"
        rows.append((i, " ".join([*words[:30], "ann@corp.example and +44 20 7946 0958", *words[30:]]) + f" {i}"))
    # Some rows hold words of the passage and no value.
    clean = [(500 + i, f"common words and {base[i]} {base[i + 1]} here {i}") for i in range(6)]
    found, texts = _spans(spark, rows + clean + _others())
    assert all(texts[n] == text for n, text in clean)
    assert all("remove" not in found[n] and "generalise" not in found[n] for n, _ in rows)


def test_few_clean_documents_change(spark):
    # A term that points at a value in four of five documents is acted on; one that does in half of them is not.
    rows = [(i, f"text {i}. The zanzibarian halfling wrote and person{i}@corp.example wrote today") for i in range(12)]
    rows += [(100 + i, f"the zanzibarian clerk {i}") for i in range(2)] + [(200 + i, f"a halfling clerk {i}") for i in range(12)]
    found, _ = _spans(spark, rows + _others())
    assert all("remove" in found[i] for i in range(12)) and all(found[n] for n in (100, 101))
    assert not any(found[200 + i] for i in range(12))


def test_private_characters_and_clashing_columns_are_kept(spark):
    text = "odd \ue000 sign, a.b@corp.example and more \ue000"
    docs = spark.createDataFrame([(1, text, "k", "n", "r")], "doc_id bigint, text string, _key string, _new string, row string")
    out = pii.sanitize(docs)
    assert out.columns == docs.columns
    assert tuple(out.first()) == (1, text.replace("a.b@corp.example", "[EMAIL]"), "k", "n", "r")

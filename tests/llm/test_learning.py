"""Models on documents they have not seen, sketches and plans against exact values."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakewarden.llm import boosting, common, neardup, packing, pii, superkmers, tokenfile
from lakewarden.llm.queries import ORACLE, QUERIES
from lakewarden.llm.shingles import shingle_sets
from lakewarden.llm.tokens import encoder

SF = "/root/testdata/sf0.1"


def _held_out(spark, name, label):
    scored = QUERIES[name](spark, SF).where("held_out").select("doc_id", "score", "predicted")
    truth = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    return scored.join(truth, "doc_id").toPandas()


def _area(score, label):
    rank = score.rank().to_numpy()
    good = label.to_numpy() == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_toxicity_of_unseen_documents(spark):
    rows = _held_out(spark, "op1_toxicity", "toxic")
    assert _area(rows["score"], rows["toxic"]) > 0.97
    assert (rows["toxic"][rows["predicted"] == 1] == 1).mean() > 0.95


def test_quality_of_unseen_documents(spark):
    rows = _held_out(spark, "op6_quality", "quality")
    assert _area(rows["score"], rows["quality"]) > 0.97
    assert (rows["predicted"][rows["quality"] == 1] == 1).mean() > 0.99


def test_language_of_unseen_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op4_language_id"](spark, SF).where("held_out").join(docs, "doc_id")
    assert rows.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.99


def test_top_k_matches_sql(spark):
    found = {tuple(r) for r in QUERIES["op8_top_k"](spark, SF).select("query_id", "rank", "vec_id", "score").collect()}
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert found == set(connection.execute(ORACLE["op8_top_k"]).fetchall())


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_encoding_equals_the_library(name):
    rng = random.Random(1)
    pieces = ["a", "B", "é", "É", " ", "  ", "\n", "\t", ",", ".", "'s", "'", "1", "²", "İ", "ſ", "Σ", "ñ", "<|endoftext|>", "\x1c", "!!", "中", " the", "|", "\r\n", "\x01", "##", "AAAA", " ", "é"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(4000)] + ["", "x " * 30]
    library = Tokenizer.from_file(public_tokenizers.path(name))
    expected = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    ids, counts = map(np.concatenate, zip(*encoder(public_tokenizers.path(name)).encode(pa.array(texts)), strict=True))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == expected


@pytest.mark.parametrize("width", [1, 5, 8, 13, 16, 17, 24, 32])
@pytest.mark.parametrize("count", [0, 1, 7, 8, 1001])
def test_bits_come_back(width, count):
    ids = np.random.default_rng(width).integers(0, 1 << width, count, dtype=np.uint64).astype(np.uint32)
    packed = tokenfile.pack(ids, width)
    assert len(packed) == -(-count // 8) * width
    assert (tokenfile.unpack(packed, count, width) == ids).all()


def test_random_access_into_a_token_file(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = [(i, " ".join(f"w{i * k}" for k in range(i * 37))) for i in range(120)]
    tokenfile.write(spark.createDataFrame(docs, "doc_id bigint, text string"), str(tmp_path / "f"), path, 1, 40_000)
    files = sorted((tmp_path / "f").glob("part-*"))
    assert len(files) > 1
    library, seen = Tokenizer.from_file(path), []
    for file in files:
        tokens = tokenfile.TokenFile(file.read_bytes())
        for n in range(len(tokens.doc_ids)):
            text = docs[tokens.doc_ids[n]][1]
            assert tokens.document(n).tolist() == [*library.encode(text, add_special_tokens=False).ids, 1]
        seen += tokens.doc_ids.tolist()
    assert seen == list(range(120))


@pytest.mark.parametrize("seed", range(4))
def test_plans_place_every_piece_once(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 2048): rng.randint(1, 50) for _ in range(rng.choice([1, 40, 900]))}
    runs, sequences = packing.make_plan(histogram)
    ranks, places = {}, {}
    for r in runs:
        for k in range(r.count):
            ranks.setdefault(r.length, []).append(r.rank + k)
            places.setdefault(r.sequence + k, []).append((r.offset, r.length))
    assert {n: sorted(x) for n, x in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}
    assert sorted(places) == list(range(sequences))
    for own in places.values():
        ends = [0]
        for offset, length in sorted(own):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048
    if len(histogram) > 800:
        assert sequences <= 1.02 * -(-sum(n * c for n, c in histogram.items()) // 2048)


def test_sketches_estimate_and_merge():
    words = [f"w{i}" for i in range(2000)]
    texts = pa.array([" ".join(words[:1000]), " ".join(words[50:1050]), " ".join(words[:1050])])
    (hashes, counts), = shingle_sets(texts)
    a, b, union = np.split(hashes, np.cumsum(counts)[:-1])
    registers = neardup.registers_of(hashes, counts)
    exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    estimate = neardup.joint_estimate(registers[:1], registers[1:2], counts[:1].astype(float), counts[1:2].astype(float))[0]
    assert abs(estimate - exact) < 0.1
    assert (neardup.merged(registers[0], registers[1]) == registers[2]).mean() > 0.95


def test_minimisers_are_the_leftmost_smallest():
    values = np.random.default_rng(0).integers(0, 9, 300).astype(np.uint64)
    for width in (1, 2, 7, 31):
        at = superkmers.leftmost_minima(values, width)
        assert at.tolist() == [i + int(values[i : i + width].argmin()) for i in range(len(values) - width + 1)]


def test_isotonic_steps_do_not_fall():
    rng = np.random.default_rng(2)
    x = rng.normal(size=400)
    points, levels = boosting.isotonic(x, (rng.random(400) < common.sigmoid(2 * x)).astype(float))
    assert (np.diff(points) >= 0).all() and (np.diff(levels) >= 0).all()


def test_terms_that_give_an_entity_away(spark):
    rows = [(i, f"{i} text about weather. The zanzibarian clerk wrote to ann@corp.example today, thanks {i}") for i in range(6)]
    rows += [(100 + i, f"common words about weather, the clerk wrote today, thanks and text {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(docs).collect()}
    text = rows[0][1]
    start = text.index("zanzibarian")
    assert found[0].split(",")[1:] == [f"remove:{start}:{start + 11}"]
    assert not any(found[100 + i] for i in range(200))
    clean = {r["doc_id"]: r["text"] for r in pii.sanitize(docs).collect()}
    assert clean[0] == text.replace("zanzibarian", "").replace("ann@corp.example", "[EMAIL]")
    assert clean[100] == rows[6][1]

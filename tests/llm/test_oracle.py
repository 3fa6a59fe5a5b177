"""Operators that SQL can express against DuckDB on the same tables."""

import hashlib
import random
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from lakewarden.llm.queries import ORACLE, QUERIES
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    duck = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    answer = duck.execute(ORACLE[name])
    columns = [column[0] for column in answer.description]
    expected = Counter(tuple(row) for row in answer.fetchall())
    found = Counter(tuple(row) for row in QUERIES[name](spark, SF_DIR).select(*columns).collect())
    assert sum(found.values()) > 0
    assert found == expected


@pytest.fixture(scope="module")
def odd():
    """A connection with odd texts and near copies as its documents, and their rows."""
    rows = list(enumerate([*brute.ODD_TEXTS, *brute.family(random.Random(4))]))
    rows += [(None, "A text without an id, of more than five words.")]
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    return duck, rows


def test_sql_of_personal_data_against_brute_force(odd):
    duck, rows = odd
    found = duck.execute(f"SELECT doc_id, base_sha256, spans, n_spans FROM ({ORACLE['op5_pii']})").fetchall()
    spans = [(number, brute.base_spans(text)) for number, text in rows]
    assert Counter(found) == Counter((n, hashlib.sha256(",".join(s).encode()).hexdigest(), ",".join(s), len(s)) for n, s in spans)


def test_sql_of_near_duplicates_against_brute_force(odd):
    duck, rows = odd
    found = duck.execute(f"SELECT doc_id, n_shingles, component_id, kept FROM ({ORACLE['op7_near_duplicates']})").fetchall()
    least = brute.components({n: t for n, t in rows if n is not None})
    sizes = [(n, len(brute.shingles(t))) for n, t in rows]
    assert Counter(found) == Counter((n, size, least.get(n), n is None or least[n] == n) for n, size in sizes)


def test_sql_of_repeated_passages_against_brute_force(odd):
    duck, rows = odd
    found = duck.execute(f"SELECT doc_id, n_words, n_removed, kept_sha256 FROM ({ORACLE['op10_substring_dedup']})").fetchall()
    assert Counter(found) == Counter(brute.repeats(rows))

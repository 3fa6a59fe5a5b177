"""Objects read in pieces."""

import pytest
from pyspark.sql import functions as F

from lakewarden import inputs, queries
from lakewarden.sources.files import scan_binary, scan_objects

OBJECTS = {
    "a b%20c#.csv": "é€😀x\n" * 40,
    "x/plain.csv": "one\ntwo",
    "x/_hidden.csv": "hidden\n",
    "x/empty.csv": "",
    "x/bytes.bin": None,
}


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "root %41"
    (root / "x").mkdir(parents=True)
    for name, text in OBJECTS.items():
        (root / name).write_bytes(bytes(range(128, 192)) * 3 if text is None else text.encode())
    return root


def joined(rows):
    out, places = {}, {}
    for row in sorted(rows, key=lambda row: (row.path, row.start, len(row.content))):
        assert row.start == places.get(row.path, 0)
        out[row.path] = out.get(row.path, b"") + bytes(row.content)
        places[row.path] = len(out[row.path])
    return out


@pytest.mark.parametrize("size", [1, 2, 5, 64, 1 << 20])
def test_pieces_join_to_whole_objects(spark, tree, size):
    rows = scan_objects(spark, f"file://{tree}".replace("%", "%25").replace(" ", "%20"), None, size).collect()
    assert joined(rows) == {name: (tree / name).read_bytes() for name in OBJECTS}
    assert max(len(row.content) for row in rows) <= size + 3
    for row in rows:
        if row.path.endswith(".csv"):
            bytes(row.content).decode()


@pytest.mark.parametrize("size", [2, 64])
def test_pieces_of_listed_names(spark, tree, size):
    whole = {row.path: bytes(row.content) for row in scan_binary(spark, str(tree), "*.csv").collect()}
    rows = scan_binary(spark, str(tree), "*.csv", size).collect()
    assert joined(rows) == whole and len(whole) == 2
    assert max(len(row.content) for row in rows) <= size + 3


def test_pieces_need_a_size(spark, tree):
    with pytest.raises(ValueError, match="0 bytes"):
        scan_binary(spark, str(tree), piece_bytes=0)


def test_no_query_holds_a_whole_order_file(spark, tmp_path, monkeypatch):
    folder = tmp_path / "landed" / "order_year=1995"
    folder.mkdir(parents=True)
    (folder / "part-0.csv").write_text("1,é\n" * 2_000_000)
    monkeypatch.setattr(inputs, "landed_sales", lambda *_: f"file://{tmp_path}/landed")
    read, seen = {"scan_binary": scan_binary, "scan_objects": scan_objects}, []
    for name, scan in read.items():
        monkeypatch.setattr(queries, name, lambda *args, scan=scan: (seen.append(scan(*args)), seen[-1])[1])
    for query in (queries.binary_scan, queries.copy_objects_whole):
        assert [tuple(row) for row in query(spark, "").collect()] == [(1995, 10_000_000, 2_000_000)]
    assert max(objects.agg(F.max(F.octet_length("content"))).first()[0] for objects in seen) < 5_000_000

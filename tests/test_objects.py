"""Live listings and whole objects: nothing left out, nothing half done."""

import zlib

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from lakewarden.plans.housekeeping import find_empty_folders
from lakewarden.sinks.objects import copy_objects, delete_objects, put_objects
from lakewarden.sources.files import scan_objects
from lakewarden.sources.tree import list_tree

FILES = {"a/b/one.csv": b"x,y\n", "a/_hidden": b"h", "a/.dot": b"", "empty.bin": b"", "a/b/c/deep": b"\x00\xff" * 5000}
FOLDERS = {"a", "a/b", "a/b/c", "void", "void/inner", "_sys"}


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "tree"
    for name in FOLDERS:
        (root / name).mkdir(parents=True, exist_ok=True)
    for name, content in FILES.items():
        (root / name).write_bytes(content)
    return root


def _tree(spark, root):
    rows = list_tree(spark, str(root)).collect()
    return {r.path: (r.is_dir, r.length) for r in rows}, len(rows)


EXPECTED = {name: (True, 0) for name in FOLDERS} | {name: (False, len(content)) for name, content in FILES.items()}


def test_everything_is_listed_once(spark, tree):
    assert _tree(spark, tree) == (EXPECTED, len(EXPECTED))
    empty = {r.path for r in find_empty_folders(list_tree(spark, str(tree))).collect()}
    assert empty == {"void", "void/inner", "_sys"}


def test_an_empty_root_and_a_missing_one(spark, tmp_path):
    (tmp_path / "root").mkdir()
    assert list_tree(spark, str(tmp_path / "root")).count() == 0
    with pytest.raises(PythonException):
        list_tree(spark, str(tmp_path / "missing")).count()


def test_objects_of_any_kind_arrive_whole(spark, tree, tmp_path):
    target = tmp_path / "copy"
    result = copy_objects(spark, f"file://{tree}", str(target), move=True)
    assert _tree(spark, target)[0] == EXPECTED
    assert all((target / name).read_bytes() == content for name, content in FILES.items())
    assert {r.path: r.crc32 for r in result.written.where("NOT is_dir").collect()} == {n: zlib.crc32(c) for n, c in FILES.items()}
    deleted = {r.path: r.deleted for r in delete_objects(result.removable).collect()}
    assert deleted == {f"file://{tree}/{name}": True for name in FILES}
    assert not any(is_dir is False for is_dir, _ in _tree(spark, tree)[0].values())
    assert not any(r.deleted for r in delete_objects(result.removable).collect())


def test_an_existing_target_is_kept_or_replaced_whole(spark, tree, tmp_path):
    target = tmp_path / "copy"
    target.mkdir()
    (target / "old").write_text("old")
    with pytest.raises(ValueError, match="exists"):
        copy_objects(spark, str(tree), str(target))
    assert (target / "old").read_text() == "old"
    copy_objects(spark, str(tree), str(target), remove_target=True)
    assert _tree(spark, target)[0] == EXPECTED


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    target = tmp_path / "out"
    rows = spark.createDataFrame([("good", b"1"), ("../escape", b"2"), ("also/good", b"3")], "path string, content binary")
    with pytest.raises(PythonException, match="no path below"):
        put_objects(rows, str(target))
    assert list(tmp_path.iterdir()) == []


def test_objects_are_read_with_the_empty_ones(spark, tree):
    found = {r.path: bytes(r.content) for r in scan_objects(spark, str(tree)).collect()}
    assert found == FILES
    some = {r.path for r in scan_objects(spark, str(tree), F.col("path").startswith("a/b/")).collect()}
    assert some == {"a/b/one.csv", "a/b/c/deep"}

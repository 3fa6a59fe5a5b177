import random

import pytest
from pyspark.sql import functions as F

from lakewarden.functions.paths import with_path_levels
from lakewarden.operators import inventory as inv
from lakewarden.plans.housekeeping import directory_sizes, find_empty_folders
from tests.helpers import inventory_of


def _paths(df, column="path"):
    return [row[column] for row in df.collect()]


def test_empty_chain_is_found_deepest_first(spark):
    listing = inventory_of(spark, {"r/full/x.csv": 5}, ["r", "r/full", "r/a", "r/a/b", "r/a/b/c", "r/d"])
    assert _paths(find_empty_folders(listing)) == ["r/a/b/c", "r/a/b", "r/a", "r/d"]


def test_zero_byte_file_keeps_its_folders(spark):
    listing = inventory_of(spark, {"r/done/_SUCCESS": 0}, ["r", "r/done", "r/empty"])
    assert _paths(find_empty_folders(listing)) == ["r/empty"]


def test_same_folder_name_under_two_parents(spark):
    listing = inventory_of(spark, {"r/x": 1}, ["r", "r/a", "r/b", "r/a/k", "r/b/k"])
    assert _paths(find_empty_folders(listing)) == ["r/a/k", "r/b/k", "r/a", "r/b"]


def test_root_limits_the_search_to_what_lies_below_it(spark):
    folders = ["orders", "orders/empty", "orders_old", "orders_old/empty"]
    listing = inventory_of(spark, {}, folders)
    assert _paths(find_empty_folders(listing, "orders")) == ["orders/empty"]
    assert _paths(find_empty_folders(listing, "orders/")) == ["orders/empty"]


def test_unlisted_ancestors_are_not_reported(spark):
    assert _paths(find_empty_folders(inventory_of(spark, {}, ["a/b/c"]))) == ["a/b/c"]


def test_repeated_listing_rows_give_one_folder(spark):
    assert _paths(find_empty_folders(inventory_of(spark, {}, ["a", "a", "a/b", "a/b"]))) == ["a/b", "a"]


def test_a_row_of_unknown_kind_counts_as_a_file(spark):
    rows = [("a", True, 0), ("a/x", None, 5), ("b", True, 0)]
    listing = spark.createDataFrame(rows, "path string, is_dir boolean, length bigint")
    assert _paths(find_empty_folders(listing)) == ["b"]
    assert inv.directory_size(listing, "a").first()["bytes"] == 5
    assert {tuple(row) for row in inv.top_level_sizes(listing).collect()} == {("a", 5), ("b", 0)}


def test_empty_inventory(spark):
    listing = inventory_of(spark)
    assert _paths(find_empty_folders(listing)) == []
    assert inv.max_depth(listing).first()["max_depth"] == 0
    assert inv.directory_size(listing, "x").first().asDict() == {"dir": "x", "bytes": 0, "size": 0.0}


def test_directory_size_ignores_siblings_with_the_same_prefix(spark):
    gib = 1024**3
    listing = inventory_of(spark, {"orders/a": gib, "orders/y/b": gib // 2, "orders_old/c": 7, "d": 1}, ["orders"])
    assert inv.directory_size(listing, "orders").first().asDict() == {"dir": "orders", "bytes": gib + gib // 2, "size": 1.5}
    sizes = {row.dir: row.bytes for row in directory_sizes(listing, "MB").collect()}
    assert sizes == {"orders": gib + gib // 2, "orders/y": gib // 2, "orders_old": 7}


def test_level_values_and_level_order(spark):
    listing = inventory_of(spark, {"b/x": 1, "a": 1, "a/y/z": 1})
    assert {row.value for row in inv.level_values(listing, 1).collect()} == {"x", "y"}
    assert {tuple(row) for row in inv.level_values(listing).collect()} == {
        (0, "a"), (0, "b"), (1, "x"), (1, "y"), (2, "z"),
    }
    ordered = inv.sort_by_levels(with_path_levels(listing, 3), 3)
    assert _paths(ordered) == ["a/y/z", "a", "b/x"]


def test_flags(spark):
    df = inv.with_flag(spark.range(3), "seen")
    rows = inv.set_where(df, "seen", F.col("id") == 1).orderBy("id").collect()
    assert [row.seen for row in rows] == [False, True, False]


@pytest.mark.parametrize("few", [True, False])
def test_existence_keeps_every_request(spark, few):
    listing = inventory_of(spark, {"a/x": 1, "a/y": 0}, ["a"])
    requests = spark.createDataFrame([("a/x",), ("a/x",), ("a",), ("a/z",), (None,)], "path string")
    rows = sorted((tuple(row) for row in inv.probe_existence(requests, listing, few_requests=few).collect()), key=str)
    assert rows == sorted([("a/x", True), ("a/x", True), ("a", True), ("a/z", False), (None, False)], key=str)


def _random_tree(seed):
    rng = random.Random(seed)
    folders, files = set(), {}
    for _ in range(120):
        parts = [rng.choice("abc") for _ in range(rng.randint(1, 5))]
        path = "/".join(parts)
        folders.update("/".join(parts[:i]) for i in range(1, len(parts)))
        if rng.random() < 0.15:
            files[path + "/f" + str(rng.randrange(9))] = rng.randrange(1000)
        folders.add(path)
    return files, sorted(folders)


def test_against_brute_force(spark):
    for seed in range(3):
        files, folders = _random_tree(seed)
        listing = inventory_of(spark, files, folders)
        empty = {d for d in folders if not any(f.startswith(d + "/") for f in files)}
        found = _paths(find_empty_folders(listing))
        assert set(found) == empty and len(found) == len(empty)
        assert [p.count("/") for p in found] == sorted((p.count("/") for p in found), reverse=True)

        stats = {row.dir: row for row in inv.level_stats(listing).collect()}
        sizes = {row.dir: row.bytes for row in inv.directory_sizes(listing).collect()}
        assert stats.keys() == sizes.keys() == set(folders)
        entries = list(files.items()) + [(d, 0) for d in folders]
        for folder in folders:
            below = [(p, n) for p, n in entries if p == folder or p.startswith(folder + "/")]
            assert stats[folder]["rows"] == len(below)
            assert stats[folder].max_length == max(n for _, n in below)
            assert sizes[folder] == sum(n for _, n in below)


def test_parent_is_at_least_as_large_as_child(spark):
    files, folders = _random_tree(11)
    sizes = {row.dir: row.bytes for row in inv.directory_sizes(inventory_of(spark, files, folders)).collect()}
    for folder, size in sizes.items():
        if "/" in folder:
            assert sizes[folder.rsplit("/", 1)[0]] >= size

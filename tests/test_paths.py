import random

import pytest
from pyspark.sql import functions as F

from lakewarden.functions import paths
from tests.helpers import one

PATH = "abfss://raw@lakeone.dfs.core.windows.net/landing/2024/orders/"


def test_abfss_url(spark):
    url = paths.abfss_url(F.col("c"), F.col("a"))
    assert one(spark, url, c="bronze", a="acct") == "abfss://bronze@acct.dfs.core.windows.net"
    assert one(spark, url, c="bronze", a=None) is None


def test_join_path(spark):
    assert one(spark, paths.join_path(F.col("b"), F.col("n")), b="base", n="orders/a.csv") == "base/orders/a.csv"
    assert one(spark, paths.join_path(F.col("b"), F.col("n")), b=None, n="x") is None


@pytest.mark.parametrize(
    ("path", "expected"),
    [
        (PATH, ("raw", "landing/2024/orders/", "abfss://raw@lakeone.dfs.core.windows.net/")),
        ("abfss://Dev@lake.example.com/House/Files", ("Dev", "House/Files", "abfss://Dev@lake.example.com/")),
        ("abfss://c@acct.dfs.core.windows.net/", ("c", "", "abfss://c@acct.dfs.core.windows.net/")),
        ("abfss://c@acct.dfs.core.windows.net/a@b/c", ("c", "a@b/c", "abfss://c@acct.dfs.core.windows.net/")),
        ("abfss://c@acct.dfs.core.windows.net/two\nlines", ("c", "two\nlines", "abfss://c@acct.dfs.core.windows.net/")),
        ("abfss://c@acct.dfs.core.windows.net", None),
        ("abfss://acct.dfs.core.windows.net/no/container", None),
        ("relative/path", None),
        (None, None),
    ],
)
def test_split_path_to_parts(spark, path, expected):
    parts = one(spark, paths.split_path_to_parts(F.col("p").cast("string")), p=path)
    assert (tuple(parts) if parts is not None else None) == expected


def test_location_to_https(spark):
    parsed = paths.location_to_https(F.col("p").cast("string"))
    location = "abfss://gold@acct.dfs.core.windows.net/dwh/tables/x"
    assert tuple(one(spark, parsed, p=location)) == (
        "gold",
        "acct.dfs.core.windows.net",
        "dwh/tables/x",
        "https://acct.dfs.core.windows.net/gold",
    )
    assert one(spark, parsed, p="abfss://acct.dfs.core.windows.net/dwh") is None
    assert one(spark, parsed, p="s3://gold@acct/dwh") is None
    assert one(spark, parsed, p=None) is None


def test_parts_parent_and_depth(spark):
    assert one(spark, paths.path_parts(F.col("p")), p="a/b/c") == ["a", "b", "c"]
    assert one(spark, paths.path_depth(F.col("p")), p="a/b/c") == 3
    assert one(spark, paths.parent_path(F.col("p")), p="a/b/c") == "a/b"
    assert one(spark, paths.parent_path(F.col("p")), p="a") is None


@pytest.mark.parametrize(
    ("root", "path"),
    [
        ("/data/lake", "file:/data/lake/x/y.csv"),
        ("/data/lake/", "file:/data/lake/x/y.csv"),
        ("file:/data/lake", "file:/data/lake/x/y.csv"),
        ("file:///data/lake", "file:/data/lake/x/y.csv"),
        ("/lake", "hdfs://lake/lake/x/y.csv"),
        ("abfss://c@acct/lake", "abfss://c@acct/lake/x/y.csv"),
        ("abfss://c@acct/", "abfss://c@acct/x/y.csv"),
        ("/", "file:/x/y.csv"),
    ],
)
def test_relative_path(spark, root, path):
    assert one(spark, paths.relative_path(F.col("p"), root), p=path) == "x/y.csv"


def test_relative_path_needs_an_absolute_root():
    with pytest.raises(ValueError, match="absolute"):
        paths.relative_path(F.lit("x"), "lake")


def test_path_levels_pad_with_null(spark):
    df = spark.createDataFrame([("a/b/c",), ("d",)], "path string")
    rows = paths.with_path_levels(df, 3).select("L0", "L1", "L2").collect()
    assert {tuple(row) for row in rows} == {("a", "b", "c"), ("d", None, None)}


@pytest.mark.parametrize("unit", ["GB", "MB"])
def test_bytes_to_unit_rounds_as_python_does(spark, unit):
    per_unit = paths.BYTES_PER_UNIT[unit]
    rng = random.Random(7)
    sizes = [0, 1, per_unit, per_unit // 8, 3 * per_unit // 8, 5 * per_unit // 8, 7 * per_unit // 8]
    sizes += [per_unit * k // 8 for k in range(64)]
    sizes += [rng.randrange(10**k) for k in range(1, 16) for _ in range(40)]
    df = spark.createDataFrame([(size,) for size in sizes], "size bigint")
    rows = df.select("size", paths.bytes_to_unit(F.col("size"), unit).alias("shown")).collect()
    assert [row.shown for row in rows] == [round(row["size"] / per_unit, 2) for row in rows]


def test_bytes_to_unit_at_any_size(spark):
    # 9 EB: no overflow in the intermediate steps.
    assert one(spark, paths.bytes_to_unit(F.col("n"), "MB"), n=2**63 - 1) == round((2**63 - 1) / 1024**2, 2)


def test_unknown_unit_is_an_error():
    with pytest.raises(ValueError, match="TB"):
        paths.bytes_to_unit(F.lit(1), "TB")

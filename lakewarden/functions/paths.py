"""Storage paths: building, splitting and sizing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Shape of a storage URL and the number of bytes per reporting unit.
URL_SCHEME = "abfss://"
HOST_SUFFIX = ".dfs.core.windows.net"
BYTES_PER_UNIT = {"GB": 1024**3, "MB": 1024**2}

_SCHEME_AND_HOST = "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def abfss_url(container: Column, account: Column) -> Column:
    """``abfss://<container>@<account>.dfs.core.windows.net``; null if either part is null."""
    return F.concat(F.lit(URL_SCHEME), container, F.lit("@"), account, F.lit(HOST_SUFFIX))


def join_path(base: Column, name: Column) -> Column:
    """``base/name``; null if either part is null."""
    return F.concat(base, F.lit("/"), name)


def leading_parts(path: Column, count: Column) -> Column:
    """The first ``count`` components of a path, joined by ``/`` again."""
    return F.call_function("substring_index", path, F.lit("/"), count)


def path_parts(path: Column) -> Column:
    return F.split(path, "/")


def path_depth(path: Column) -> Column:
    """Number of components, counted without splitting the text."""
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))) + 1


def parent_path(path: Column) -> Column:
    """The folder holding ``path``; null at the top level."""
    name = F.substring_index(path, "/", -1)
    return F.nullif(F.left(path, F.length(path) - F.length(name) - 1), F.lit(""))


def strip_trailing_slash(path: Column) -> Column:
    return F.rtrim(path, F.lit("/"))


def relative_path(path: Column, root: str) -> Column:
    """The part of ``path`` below the folder ``root``; either may name a scheme and a host."""
    folder = re.sub(_SCHEME_AND_HOST, "", root).rstrip("/")
    if not root.startswith("/") and folder == root.rstrip("/"):
        raise ValueError(f"{root!r} is not an absolute path")
    return F.substr(F.regexp_replace(path, _SCHEME_AND_HOST, ""), F.lit(len(folder) + 2))


def _url_prefix(path: Column, scheme: str) -> Column:
    # Everything up to and including the slash after the host; null when there is none.
    prefix = F.regexp_extract(path, f"^{scheme}//[^@/]+@[^/]+/", 0)
    return F.nullif(prefix, F.lit(""))


def _between(text: Column, after: str, before: str) -> Column:
    return F.substring_index(F.substring_index(text, before, 1), after, -1)


def split_path_to_parts(path: Column) -> Column:
    """Absolute path -> struct(container, directory, url); null if it is not such a path."""
    url = _url_prefix(path, "[^/@]+:")
    return F.when(
        url.isNotNull(),
        F.struct(
            _between(url, "//", "@").alias("container"),
            F.substr(path, F.length(url) + 1).alias("directory"),
            url.alias("url"),
        ),
    )


def location_to_https(location: Column) -> Column:
    """Table location -> struct(container, account, subpath, https); null if it cannot be parsed."""
    url = _url_prefix(location, "abfss:")
    container = _between(url, "//", "@")
    account = F.rtrim(F.substring_index(url, "@", -1), F.lit("/"))
    return F.when(
        url.isNotNull(),
        F.struct(
            container.alias("container"),
            account.alias("account"),
            F.substr(location, F.length(url) + 1).alias("subpath"),
            F.concat(F.lit("https://"), account, F.lit("/"), container).alias("https"),
        ),
    )


def with_path_levels(df: DataFrame, depth: int, path: str = "path") -> DataFrame:
    """Add columns ``L0 .. L<depth-1>``, null beyond a path's own depth."""
    parts = path_parts(F.col(path))
    return df.select("*", *[F.get(parts, F.lit(i)).alias(f"L{i}") for i in range(depth)])


def bytes_to_unit(size: Column, unit: str) -> Column:
    """Bytes as GB or MB with two decimals, halves rounded to the even hundredth.

    Integer arithmetic keeps the rounding exact: a byte count over a power of two can fall exactly
    on a half, where rounding the decimal text of the double would go the wrong way.
    """
    if unit not in BYTES_PER_UNIT:
        raise ValueError(f"unit {unit!r} is not one of {sorted(BYTES_PER_UNIT)}")
    per_unit = F.lit(BYTES_PER_UNIT[unit]).cast("bigint")
    size = size.cast("bigint")
    scaled = (size % per_unit) * 100
    hundredths = F.call_function("div", scaled, per_unit)
    twice_left = (scaled % per_unit) * 2
    round_up = (twice_left > per_unit) | ((twice_left == per_unit) & (hundredths % 2 == 1))
    total = F.call_function("div", size, per_unit) * 100 + hundredths + round_up.cast("bigint")
    return total / F.lit(100.0)

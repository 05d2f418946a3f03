"""URL expressions: network location, path and path features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SCHEME = "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?"


def netloc(url: Column) -> Column:
    """Host with port and user info; empty where the URL has none."""
    return F.regexp_extract(url, _SCHEME + "//([^/?#]*)", 1)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, _SCHEME + "(?://[^/?#]*)?([^?#]*)", 1)


def path_segments(url: Column) -> Column:
    return F.filter(F.split(url_path(url), "/"), lambda s: s != "")


def with_path_features(df: DataFrame, url_col: str = "loc") -> DataFrame:
    """Add ``section``, ``subsection`` and ``path_depth`` from the URL path."""
    segs = path_segments(F.col(url_col))
    return df.withColumns(
        {
            "section": F.get(segs, F.lit(0)),
            "subsection": F.get(segs, F.lit(1)),
            "path_depth": F.size(segs),
        }
    )

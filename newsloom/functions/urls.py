"""Addresses: network location, origin key and resolution against a base."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def netloc(address: Column) -> Column:
    """Everything between '//' and the path: host, port and user part."""
    return F.regexp_extract(address, _SCHEME + r"//([^/?#]*)", 1)


def origin_key(source: Column) -> Column:
    """The name an origin is looked up by: the site of an address, else the source."""
    site = F.regexp_replace(netloc(source), r"^www\.", "")
    return F.when(source.startswith("http"), site).otherwise(source)


def _without_dots(path: Column) -> Column:
    """Fold '.' and '..' segments of an absolute path."""
    segments = F.split(path, "/")
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.concat(done, F.array(part))),
    )
    ending = F.when(path.rlike(r"/\.\.?\z"), "/").otherwise("")
    return F.when(
        path.rlike(r"/\.\.?(/|\z)"), F.concat(F.array_join(folded, "/"), ending)
    ).otherwise(path)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` as found on the page at ``base``."""
    scheme = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.\\-]*):", 1)
    root = F.concat(scheme, F.lit("://"), netloc(base))
    base_path = F.regexp_extract(base, _SCHEME + r"//[^/?#]*([^?#]*)", 1)
    base_query = F.regexp_extract(base, _SCHEME + r"//[^/?#]*([^#]*)", 1)
    folder = F.when(base_path == "", "/").otherwise(F.regexp_replace(base_path, r"[^/]*\z", ""))
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    rest = F.substring(href, F.length(path) + 1, F.length(href))
    return (
        F.when(href == "", base)
        .when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("#"), F.concat(root, base_query, href))
        .when(href.startswith("?"), F.concat(root, base_path, href))
        .when(href.startswith("/"), F.concat(root, _without_dots(path), rest))
        .otherwise(F.concat(root, _without_dots(F.concat(folder, path)), rest))
    )

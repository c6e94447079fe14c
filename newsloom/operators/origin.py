"""Display name of the site or source an article comes from."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.functions.urls import origin_key


def origin_of(source: Column, names: dict[str, str] | None = None) -> Column:
    """Look the origin key up in a small map; a miss keeps the key, null stays null."""
    names = fixed.ORIGIN_NAMES if names is None else names
    key = origin_key(source)
    lookup = F.from_json(F.lit(json.dumps(names)), "map<string, string>")
    return F.coalesce(F.try_element_at(lookup, key), key)


def with_origin(df: DataFrame, names: DataFrame, source: str = "source") -> DataFrame:
    """The same against a table ``(domain, origin)`` of any size; of several names the first by alphabet.

    Spark broadcasts the table only when it is small enough.
    """
    keyed = df.withColumn("domain", origin_key(F.col(source)))
    named = names.groupBy("domain").agg(F.min("origin").alias("_name"))
    joined = keyed.join(named, "domain", "left")
    return joined.withColumn("origin", F.coalesce("_name", "domain")).drop("domain", "_name")

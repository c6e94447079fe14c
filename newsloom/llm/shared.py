"""What several operators share: words, shingle sets, scratch tables, components.

Documents come as (doc_id, text) in any table; other columns are ignored or
passed on.  A word is a run of bytes other than blank and control whitespace
(0x20, 0x09-0x0D); for shingles A-Z are lower-cased first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.session import apply_settings, scratch_path

#: Words in a shingle.
SHINGLE_WORDS = 5
#: Rows that one Arrow batch holds; texts can be long.
BATCH_ROWS = 512

SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
    # Joins that need the text of a few documents only: Spark filters the large
    # side by a Bloom filter of the keys before it is shuffled.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "32MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64MB",
}


def settle(spark: SparkSession) -> SparkSession:
    """The session with the settings the operators rely on."""
    apply_settings(spark)
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared folder and read it: its lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame) -> DataFrame:
    """The two columns the operators read, typed."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def wanted(keys: DataFrame, column: str = "doc_id") -> DataFrame:
    """The keys under a condition that every key meets.

    It makes them worth a Bloom filter to Spark, which then drops the rows of the
    other side of a join before they are shuffled.
    """
    return keys.where(F.col(column) >= F.lit(-(1 << 63)))


def unused(df: DataFrame, prefix: str) -> str:
    """The prefix, with as many underscores before it as no column of ``df`` begins with."""
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = "_" + prefix
    return prefix


_P1 = np.uint64(0x9E3779B97F4A7C15)
_P2 = np.uint64(0xC2B2AE3D27D4EB4F)
_S32 = np.uint64(32)
_S29 = np.uint64(29)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    shifted = values >> _S32
    found = values ^ shifted
    found *= _P1
    np.right_shift(found, _S29, out=shifted)
    found ^= shifted
    found *= _P2
    np.right_shift(found, _S32, out=shifted)
    found ^= shifted
    return found


def word_ids(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_ids(ids: np.ndarray, width: int) -> np.ndarray:
    """The id of each run of ``width`` word ids."""
    n = len(ids) - width + 1
    found = np.full(n, np.uint64(width))
    for k in range(width):
        found = mixed(found ^ ids[k : k + n]) + np.uint64(k)
    return found


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct shingles of a text, as 64-bit ids.

    With fewer words than a shingle the whole sequence is one; without words
    the set is empty.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_ids(word_ids(words), min(len(words), SHINGLE_WORDS)))


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """One output batch for each input batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (made := work(batch)) is not None:
                yield made

    return df.mapInArrow(run, schema)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each node of an edge and the smallest node it reaches.

    Each round every node moves to the smallest of itself and its neighbours,
    and edges are redrawn between the places moved to, so paths shrink until no
    edge is left.  Tables of a round are written; nothing comes to the driver
    but the number of edges.
    """
    edges = cut(
        edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u < v").distinct(), "edges"
    )
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    places = nodes.withColumn("component", F.col("node"))
    while not edges.isEmpty():
        both = edges.union(edges.select("v", "u"))
        moved = cut(
            both.groupBy(F.col("u").alias("place")).agg(F.min("v").alias("lower")).select(
                "place", F.least("place", "lower").alias("target")
            ),
            "moved",
        )
        places = cut(
            places.join(moved, places.component == moved.place, "left").select(
                "node", F.coalesce("target", "component").alias("component")
            ),
            "places",
        )
        to_u, to_v = moved.toDF("u", "pu"), moved.toDF("v", "pv")
        edges = cut(
            edges.join(to_u, "u").join(to_v, "v")
            .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v"))
            .where("u < v")
            .distinct(),
            "edges",
        )
    return places

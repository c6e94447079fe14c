"""Incremental ingest: every id reaches the table once."""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructType

from newsloom.operators import key_index as I
from newsloom.operators import keys as K

QUERY, BATCH = "query_id", "batch_id"
FOLDER = re.compile(f"/{QUERY}=([^/]+)/{BATCH}=(-?[0-9]+)/")
#: Filters of the folders' keys, out of sight of readers of the table.
INDEX = "_keys"


def _wide(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add(QUERY, StringType()).add(BATCH, LongType())


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The ingested table, with the query and the batch that brought each row."""
    return spark.read.schema(_wide(schema)).parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The filters of the table's folders."""
    schema = f"{I.FILTER}, {QUERY} string, {BATCH} long"
    try:
        return spark.read.schema(schema).parquet(f"{path}/{INDEX}")
    except AnalysisException:  # before the first batch there is none
        return spark.createDataFrame([], schema)


def folders_of(table: DataFrame) -> set[tuple[str, int]]:
    """The folders of a table, from the list of its files; no file is read."""
    found = {FOLDER.search(unquote(f)) for f in table.inputFiles()}
    return {(m[1], int(m[2])) for m in found if m}


def index_folder(spark: SparkSession, path: str, folder: tuple[str, int], schema: StructType, key: str) -> None:
    """Write the filter of one folder's keys, from the rows that are there."""
    place = f"{QUERY}={folder[0]}/{BATCH}={folder[1]}"
    own = spark.createDataFrame([folder], f"{QUERY} string, {BATCH} long")
    keys = spark.read.schema(schema).parquet(f"{path}/{place}").select(key, F.lit(folder[0]).alias(QUERY), F.lit(folder[1]).cast("long").alias(BATCH))
    I.filters_of(keys, key, own).drop(QUERY, BATCH).write.mode("overwrite").parquet(f"{path}/{INDEX}/{place}")


def index_table(spark: SparkSession, path: str, schema: StructType, key: str) -> None:
    """Write the filters of all folders in one job, for a table that has none yet."""
    table = read_table(spark, path, schema)
    folders = spark.createDataFrame(sorted(folders_of(table)), f"{QUERY} string, {BATCH} long")
    filters = I.filters_of(table.select(key, QUERY, BATCH), key, folders)
    filters.write.mode("overwrite").partitionBy(QUERY, BATCH).parquet(f"{path}/{INDEX}")


def known_part(spark: SparkSession, path: str, schema: StructType, keys: DataFrame, key: str) -> DataFrame:
    """The folders of the table that can hold one of the keys; the others are not read.

    A folder without a whole filter, left by a batch that failed before it wrote one,
    is read in any case.
    """
    every = folders_of(read_table(spark, path, schema))
    index = read_index(spark, path)
    rows = I.whole_filters(index, QUERY, BATCH).collect()  # one short row for each folder, as the list of files
    whole = {tuple(r) for r in rows}
    met = {tuple(r) for r in I.folders_with(index, keys, key, QUERY, BATCH).collect()}
    chosen = sorted((every - whole) | (every & met))
    if not chosen:
        return spark.createDataFrame([], _wide(schema))
    places = [f"{path}/{QUERY}={query}/{BATCH}={batch}" for query, batch in chosen]
    return spark.read.schema(_wide(schema)).option("basePath", path).parquet(*places)


def ingest_new(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: str,
    *order: str | Column,
    shape: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query that adds the stream's new keys to the table at ``path``.

    Each micro-batch keeps the first row of every key, drops the keys that are
    in the table already, applies ``shape`` and writes a folder of its own,
    named by the query and the batch.  The query's id lives in the checkpoint:
    a batch that is run again after a failure leaves its own folder out of the
    comparison and replaces it with the same rows, while a query with a new
    checkpoint never touches the folders of an old one.  Of the table only the
    key is read, and only in folders whose filter (see ``operators.key_index``)
    does not rule out all keys of the batch: a batch of new keys reads hardly any,
    however large the table has grown.  Rows are written before their filter, so
    no key is in the table unseen.  ``shape`` keeps the key.  One query at a time
    may write to a table.
    """
    spark = stream.sparkSession
    schema = shape(stream).schema
    # The table exists before the first batch asks for it.
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").parquet(f"{path}/{QUERY}=none/{BATCH}=-1")

    def add(rows: DataFrame, number: int) -> None:
        here = rows.sparkSession
        query = here.sparkContext.getLocalProperty("sql.streaming.queryId")
        firsts = K.keep_first(rows, key, *order).persist()
        own = (F.col(QUERY) == query) & (F.col(BATCH) >= number)
        others = known_part(here, path, schema, firsts, key).where(~own)
        fresh = shape(K.new_only(firsts, others, key, unique=True))
        fresh.write.mode("overwrite").parquet(f"{path}/{QUERY}={query}/{BATCH}={number}")
        index_folder(here, path, (query, number), schema, key)
        firsts.unpersist()

    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def without_repeats(stream: DataFrame, key: str, moment: str, within: str) -> DataFrame:
    """Repeats of a key dropped inside the watermark, without a table to look at."""
    return stream.withWatermark(moment, within).dropDuplicatesWithinWatermark([key])

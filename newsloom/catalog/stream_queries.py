"""Structured Streaming jobs, run over the events table until it is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsloom.catalog.registry import Tables, query
from newsloom.session import scratch_path
from newsloom.streaming import ingest as I
from newsloom.streaming import volume as V


def events_stream(tables: Tables) -> DataFrame:
    schema = tables.table("events").schema
    return tables.spark.readStream.schema(schema).option(
        "pathGlobFilter", "events.parquet"
    ).parquet(tables.folder)


@query(
    """
    SELECT user_id, event_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events)
    WHERE place = 1
    """
)
def stream_ingest_dedup(tables: Tables) -> DataFrame:
    path = scratch_path(tables.spark, "ingest")
    stream = events_stream(tables)
    I.ingest_new(stream, f"{path}/table", f"{path}/checkpoint", "user_id", "event_id").awaitTermination()
    table = I.read_table(tables.spark, f"{path}/table", stream.schema)
    return table.select("user_id", "event_id", "event_type")


@query(
    """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2
    """
)
def stream_daily_counts(tables: Tables) -> DataFrame:
    path = scratch_path(tables.spark, "volume")
    counts = V.daily_counts(events_stream(tables), "ts", "event_type")
    V.write_daily_counts(counts, f"{path}/table", f"{path}/checkpoint", "event_type").awaitTermination()
    written = V.read_daily_counts(tables.spark, f"{path}/table", counts.schema, "event_type")
    return written.withColumn("day", F.col("day").cast("string"))

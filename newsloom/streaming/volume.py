"""Daily volume by key as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from newsloom.sources.versions import VersionedTable

BATCH = "batch_id"
#: Versions, and hours of files, that readers may still be at when small files are merged.
KEPT_VERSIONS = 8
KEPT_HOURS = 1.0


def daily_counts(stream: DataFrame, moment: str, key: str, lateness: str = "1 day") -> DataFrame:
    """Rows per UTC day and key; rows later than the watermark are dropped."""
    timed = stream.withColumn(moment, F.col(moment).cast("timestamp"))
    return (
        timed.withWatermark(moment, lateness)
        .groupBy(F.window(moment, "1 day").alias("_day"), key)
        .agg(F.count("*").alias("n"))
        .select(F.to_date("_day.start").alias("day"), key, "n")
    )


def _latest(key: str) -> Callable[[DataFrame], DataFrame]:
    """Of each day and key the row written last."""

    def latest(rows: DataFrame) -> DataFrame:
        last = rows.groupBy("day", key).agg(F.max_by("n", BATCH).alias("n"), F.max(BATCH).alias(BATCH))
        return last.select(*rows.columns)

    return latest


def write_daily_counts(
    counts: DataFrame, path: str, checkpoint: str, key: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write the counts that a micro-batch has changed, open days included.

    The rows of a batch carry its number and are added in one step; a batch that runs
    again after a failure adds the same rows, which change nothing.  Small files are
    merged, and only the last row of a day and key stays in them, so what readers read
    is bounded by the days and keys there are, not by the batches.
    """
    table = VersionedTable(counts.sparkSession, path)
    if not table.versions():  # it exists before the first batch
        table.append(counts.sparkSession.createDataFrame([], StructType([*counts.schema.fields]).add(BATCH, "long")))

    def add(changed: DataFrame, number: int) -> None:
        here = VersionedTable(changed.sparkSession, path)
        # Each part of the state is a task of its own, and its few rows are handed to the one that writes:
        # merged into one task the parts would hold the buffers of their aggregations together.
        before = here.append(changed.withColumn(BATCH, F.lit(number).cast("long")).repartition(1))
        if here.merge(_latest(key)) > before:
            here.forget(keep=KEPT_VERSIONS, hours=KEPT_HOURS)

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_daily_counts(spark: SparkSession, path: str, schema: StructType, key: str) -> DataFrame:
    """The counts as they stand: of each day and key the one written last."""
    return _latest(key)(VersionedTable(spark, path).read()).select(*schema.fieldNames())

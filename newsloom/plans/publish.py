"""Publication: article rows in the fixed warehouse shape, as a full refresh.

Each refresh is a new version (see ``sources.versions``): readers see the old rows or
the new ones, and a refresh that fails leaves the old ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import dates as D
from newsloom.functions import numbers as N
from newsloom.operators.repair import categories_as_list
from newsloom.schemas import PUBLISHED_SCHEMA
from newsloom.sources.tables import create_table_if_missing
from newsloom.sources.versions import VersionedTable

_DATES = ("created_at", "date_publication")


def published_rows(df: DataFrame, run_time: Column, null_text: str = "") -> DataFrame:
    """Typed columns in the published order; a missing column counts as null.

    Null texts become ``null_text``; pass ``"None"`` for tables whose readers
    expect that word.  Numbers and dates that cannot be read become null.
    """
    kinds = dict(df.dtypes)

    def shaped(name: str) -> Column:
        column = F.col(name) if name in kinds else F.lit(None).cast("string")
        if name == "sync_timestamp":
            return run_time
        if name == "categorie":
            return categories_as_list(column, kinds.get(name, "string"))
        if name in _DATES:
            return D.iso_timestamp(column) if kinds.get(name, "string") == "string" else column
        if name == "sentiment_score":
            return N.safe_float(column.cast("string"))
        return F.coalesce(column.cast("string"), F.lit(null_text))

    return df.select(
        *[shaped(f.name).cast(f.dataType).alias(f.name) for f in PUBLISHED_SCHEMA.fields]
    )


def newest_order() -> list[Column]:
    """Latest creation date first, nulls last.

    The id breaks ties, so that a batch written at one moment does not end up
    in a single range of the sort.
    """
    return [F.desc_nulls_last("created_at"), F.asc("id_article")]


def newest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(*newest_order())


def publish(df: DataFrame, run_time: Column, path: str, by_day: bool = True) -> int:
    """Replace the published table, as Parquet with one folder per publication day; the new version."""
    rows = published_rows(df, run_time)
    if not by_day:
        return VersionedTable(df.sparkSession, path).replace(newest_first(rows))
    day = F.to_date("date_publication")
    return VersionedTable(df.sparkSession, path, by="publication_day").replace(rows.withColumn("publication_day", day))


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The published table, as of a version if one is given."""
    return VersionedTable(spark, path).read(version)


def publish_table(df: DataFrame, run_time: Column, name: str, location: str | None = None) -> int:
    """Replace the rows of a typed table of the catalog, newest first; make the table if it is missing.

    The rows are written beside the old ones, below the place that the table was made
    at, and the table is pointed at them in one step.
    """
    spark = df.sparkSession
    create_table_if_missing(spark, name, PUBLISHED_SCHEMA, location)
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    here = described.where("col_name = 'Location'").first()["data_type"]
    versions = VersionedTable(spark, here.split("/_data/")[0])
    version = versions.replace(newest_first(published_rows(df, run_time)))
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{versions.folder(version)}'")
    return version


def publish_json(df: DataFrame, run_time: Column, path: str) -> str:
    """The same rows as JSON lines with ISO dates, newest first; the folder they are in."""
    rows = newest_first(published_rows(df, run_time))
    dates = {c: D.iso_text(F.col(c)) for c in (*_DATES, "sync_timestamp")}
    versions = VersionedTable(df.sparkSession, path, fmt="json")
    return versions.folder(versions.replace(rows.withColumns(dates)))

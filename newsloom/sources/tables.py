"""Tables on files: scans, appends, exports and loads with a budget of bad lines.

A table is never changed in place.  Updates and deletes are DataFrames (see
``operators.keys``) and go to a new path: to overwrite the path a plan reads
from would take its input away.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsloom import fixed_values as fixed
from newsloom.operators import keys as K
from newsloom.schemas import ARTICLE_SCHEMA
from newsloom.session import scratch_path


def scan_articles(
    spark: SparkSession,
    path: str,
    schema: StructType = ARTICLE_SCHEMA,
    columns: Sequence[str] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """The table with a fixed schema; only ``columns`` are read if given."""
    table = spark.read.schema(schema).format(fmt).load(path)
    return table.select(*columns) if columns else table


def write_table(
    df: DataFrame, path: str, mode: str = "errorifexists", by: str | None = None, fmt: str = "parquet"
) -> None:
    """Write a table, by day or another column if given.

    Rows of one value are brought together first; the rebalance hint lets
    adaptive execution split a large value over several tasks and files.
    """
    if by is None:
        df.write.mode(mode).format(fmt).save(path)
    else:
        df.hint("rebalance", by).write.mode(mode).partitionBy(by).format(fmt).save(path)


def append_new(
    batch: DataFrame, table: DataFrame, path: str, key: str = "id_article", by: str | None = None
) -> None:
    """Append the rows whose key the table at ``path`` does not have yet."""
    write_table(K.new_only(batch, table, key), path, "append", by)


def export_csv(df: DataFrame, path: str) -> None:
    """Text columns as CSV with a header, quotes doubled."""
    df.write.mode("errorifexists").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """One JSON object per line."""
    df.write.mode("errorifexists").json(path)


class BadRecordsError(ValueError):
    """More unreadable lines than the budget allows."""


def load_json_lines(
    spark: SparkSession,
    path: str,
    schema: StructType,
    budget: int = fixed.MAX_BAD_RECORDS,
) -> DataFrame:
    """JSON lines in a fixed schema, without the unreadable ones.

    Fails when there are more of them than ``budget``.  Lines are parsed once,
    into a table below the shared folder that the count and the result read.
    """
    corrupt = "_corrupt"
    wide = StructType([*schema.fields]).add(corrupt, "string")
    lines = spark.read.text(path).where(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    parsed = lines.select(F.from_json("value", wide, options).alias("row"))
    store = scratch_path(spark, "parsed")
    parsed.select(*[F.col(f"row.{f.name}") for f in schema.fields], F.col(f"row.{corrupt}").isNotNull().alias("_bad")).write.parquet(store)
    rows = spark.read.schema(StructType([*schema.fields]).add("_bad", "boolean")).parquet(store)
    if rows.where("_bad").limit(budget + 1).count() > budget:
        raise BadRecordsError(f"more than {budget} unreadable lines in {path}")
    return rows.where("NOT _bad").drop("_bad")


def create_table_if_missing(
    spark: SparkSession, name: str, schema: StructType, location: str | None = None
) -> None:
    """An empty typed Parquet table in the session catalog, unless it is there."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where}")

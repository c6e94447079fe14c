"""A change of a whole table in parts that are not done twice.

The input's files are the parts.  Each has a name made of its path, size and time of
change; the output is a versioned table with a folder for each name, so its manifest is
the ledger of what is done.  A run takes the files that the ledger lacks, so many bytes
at a time, and publishes each lot in one step.  A run that was ended goes on where the
last lot was published; a run over a table that grew or changed redoes the new and the
changed files only, and the rows of files that are gone leave the output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.sources.versions import VersionedTable

PART = "_part_of"
#: Bytes of input that are published together.
LOT_BYTES = 256 << 30


def _named(table: DataFrame) -> DataFrame:
    """The rows with the name of their file."""
    file = F.concat_ws(":", "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    return table.withColumn(PART, F.sha1(file))


def _output(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, by=PART, gather=False)


def pending_files(table: DataFrame, out: str) -> tuple[list[tuple[str, str, int]], set[str]]:
    """(path, name, bytes) of the files that are not done, and the names of all; no column is read."""
    files = _named(table).select("_metadata.file_path", PART, "_metadata.file_size").distinct().collect()  # a row for each file
    done = _output(table.sparkSession, out).folder_values()
    return sorted((f["file_path"], f[PART], f["file_size"]) for f in files if f[PART] not in done), {f[PART] for f in files}


def _lots(files: list[tuple[str, str, int]], lot_bytes: int) -> list[list[str]]:
    """The files' names in lots of so many bytes, a larger file alone."""
    lots, size = [], lot_bytes
    for _, name, n in files:
        if size + n > lot_bytes:
            lots.append([])
            size = 0
        lots[-1].append(name)
        size += n
    return lots


def change_in_parts(
    table: DataFrame,
    out: str,
    change: Callable[[DataFrame], DataFrame],
    lot_bytes: int = LOT_BYTES,
    max_lots: int | None = None,
) -> int:
    """Apply ``change``, a map over rows that keeps other columns, to what is not done yet; the lots done.

    ``table`` is a scan of files.  ``max_lots`` ends the run early, to be gone on with later.
    """
    spark = table.sparkSession
    output = _output(spark, out)
    files, every = pending_files(table, out)
    lots = _lots(files, lot_bytes)[:max_lots]
    paths = {name: path for path, name, _ in files}
    for lot in lots:
        rows = spark.read.schema(table.schema).format("parquet").load([paths[name] for name in lot])
        output.append(change(_named(rows)))
    if output.versions():
        output.keep_folders(sorted(every))
    return len(lots)


def read_parts(spark: SparkSession, out: str) -> DataFrame:
    """The output of all parts that are done."""
    return _output(spark, out).read().drop(PART)

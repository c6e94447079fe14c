"""Small files and names in the file systems that Spark reaches, by Hadoop's client."""

from __future__ import annotations

from pyspark.sql import SparkSession


class NameTakenError(OSError):
    """A file of this name is there already."""


def _at(spark: SparkSession, path: str):
    """The file system of a path and the path, as the client has them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; none when there is no folder."""
    system, where = _at(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(where)) if system.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    system, where = _at(spark, path)
    stream = system.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that others see whole or not at all; fails when the name is taken.

    It is written beside its place and renamed.  Renaming does not overwrite: of two
    writers of one name a single one succeeds, on file systems whose rename is one step.
    """
    system, where = _at(spark, path)
    folder, name = path.rsplit("/", 1)
    _, beside = _at(spark, f"{folder}/.{name}-{spark._jvm.java.util.UUID.randomUUID()}")
    stream = system.create(beside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark._sc._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        context.rename(context.makeQualified(beside), context.makeQualified(where), no_options)
    except Exception as error:
        system.delete(beside, False)
        if system.exists(where):
            raise NameTakenError(path) from error
        raise


def delete_folder(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    system.delete(where, True)


def modified(spark: SparkSession, path: str) -> int:
    """When a file or folder changed last, in milliseconds."""
    system, where = _at(spark, path)
    return system.getFileStatus(where).getModificationTime()

"""Operators on keys: known and new rows, first occurrences, updates, deletes.

All of them are equi-joins or windows on the key and leave the choice between
a broadcast and a shuffle to Spark, which knows the sizes.  A key that holds a
large part of the rows is safe: known keys are made distinct task by task
before they are shuffled, the other side of a join is on the left, where
adaptive execution splits a skewed partition, and the windows keep one row per
key and task before the shuffle (window group limit).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.quality import is_missing, passes_gate


def _key_set(keys: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """The distinct keys, each once, however often a task sees one.

    Keys that are known to be unique only need the join's own shuffle.

    They are made distinct together with a hash of theirs.  The join then has
    to shuffle them itself, and only in a join that shuffles both sides itself
    does adaptive execution split a partition of the other side that one hot
    key has filled.
    """
    if unique:
        return keys.where(F.col(key).isNotNull()).select(key)
    known = keys.where(F.col(key).isNotNull()).select(key, F.xxhash64(key).alias("_hash"))
    return known.distinct().select(key)


def new_only(
    batch: DataFrame, known: DataFrame, key: str = "id_article", unique: bool = False
) -> DataFrame:
    """Rows whose key is not known yet; repeats inside the batch stay.

    ``unique`` says that no key is in ``known`` twice, as in a table that only
    this operator has added to; it saves a shuffle of the known keys.
    """
    return batch.join(_key_set(known, key, unique), key, "left_anti")


def known_only(batch: DataFrame, known: DataFrame, key: str = "id_article") -> DataFrame:
    """Rows whose key is known already."""
    return batch.join(_key_set(known, key), key, "left_semi")


def delete_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The table without the rows named by ``keys``."""
    return df.join(_key_set(keys, key), key, "left_anti")


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """The table without the rows that fit; an undecided row stays."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def keep_first(df: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """The first row of every key in a total order."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def most_recent(df: DataFrame, group: str, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows of every group in a total order, newest first."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def keyed_update(
    df: DataFrame, updates: DataFrame, key: str, columns: Sequence[str], *order: str | Column
) -> DataFrame:
    """Set ``columns`` on the rows named by ``updates``; the last update of a key in ``order`` counts.

    Without an order a key must not be updated twice: the plan fails when one is.
    A null in an update is set like any other value; an update without key names
    no row.
    """
    named = updates.where(F.col(key).isNotNull())
    values = F.struct(*[F.col(c).alias(f"_new_{c}") for c in columns])
    if order:
        # max_by combines task by task, so a key with many updates costs one row per task.
        last = F.max_by(values, F.struct(*[F.col(c).alias(f"_{k}") if isinstance(c, str) else c.alias(f"_{k}") for k, c in enumerate(order)]))
    else:
        twice = F.raise_error(F.concat(F.lit("more than one update of "), F.first(F.col(key).cast("string"))))
        last = F.when(F.count("*") > 1, twice).otherwise(F.first(values))
    changes = named.groupBy(key).agg(last.alias("_last")).select(key, F.lit(True).alias("_hit"), "_last.*")
    joined = df.join(changes, key, "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in df.columns
        ]
    )


def run_counters(
    batch: DataFrame,
    known: DataFrame,
    key: str = "id_article",
    title: str = "titre",
    content: str = "contenu",
) -> DataFrame:
    """Added, existing and skipped rows of one run; id, then known, then validity.

    Only the key and two flags leave the scan.
    """
    flags = batch.select(
        key,
        (~is_missing(F.col(key))).alias("_has_id"),
        passes_gate(F.col(title), F.col(content)).alias("_valid"),
    )
    # Rows of one key and flag are alike, so they are counted before the join.
    counted = flags.groupBy(key, "_has_id", "_valid").agg(F.count("*").alias("_n"))
    marked = counted.join(_key_set(known, key).withColumn("_known", F.lit(True)), key, "left")
    status = (
        F.when(~F.col("_has_id"), "skipped")
        .when(F.col("_known"), "existing")
        .when(F.col("_valid"), "added")
        .otherwise("skipped")
    )
    return marked.groupBy(status.alias("status")).agg(F.sum("_n").alias("n"))

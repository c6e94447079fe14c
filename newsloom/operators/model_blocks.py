"""A model of any number of classes, applied in blocks of bounded size.

A model is a table of blocks: the names of some classes and their packed matrix.  The
rows meet one block after the other.  A block is broadcast, its size is bounded when it
is packed, and each row carries its best class so far and, for a likelihood, the sum of
all classes' shares; between two blocks the rows are written, so that a task never
holds more than one.  A model of one block, the usual case, is a single map over the
rows.  Blocks come in the order of the names, and a later class has to be better, so
the first name wins a tie as it does in one matrix.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.staging import with_once
from newsloom.session import scratch_path

BLOCK = "at long, names array<string>, kind string, matrix binary, columns int"
BEST = "score double, name string, mass double"

#: From the values of a batch and a block's matrix to scores (value, class); NaN in a row without an answer.
Scores = Callable[[pd.Series, np.ndarray], np.ndarray]


def packed(at: int, names: list[str], matrix: np.ndarray) -> dict:
    """One row of a model: the matrix has a row of any meaning and a column for each name."""
    return {"at": at, "names": names, "kind": matrix.dtype.str, "matrix": matrix.tobytes(), "columns": matrix.shape[1]}


def unpacked(row: dict) -> np.ndarray:
    """The matrix of a row."""
    return np.frombuffer(row["matrix"], dtype=row["kind"]).reshape(-1, row["columns"])


def _merged(before: pd.DataFrame, scores: np.ndarray, names: np.ndarray, scale: float) -> pd.DataFrame:
    """The best of earlier classes and of these, and the shares' sum relative to it."""
    known = ~np.isnan(scores).any(axis=1)
    best = np.where(known, np.nan_to_num(scores).argmax(axis=1), 0)
    top = scores[np.arange(len(scores)), best]
    old = before["score"].to_numpy(dtype="float64", na_value=np.nan)
    better = known & (np.isnan(old) | (top > np.nan_to_num(old)))
    score = np.where(better, top, old)
    with np.errstate(invalid="ignore"):
        mass = np.exp((scores - score[:, None]) / scale).sum(axis=1)
        earlier = before["mass"].to_numpy(dtype="float64", na_value=np.nan) * np.exp((old - score) / scale)
    name = np.where(better, names[best], before["name"].to_numpy(dtype=object))
    return pd.DataFrame({"score": score, "name": name, "mass": np.where(known, mass + np.nan_to_num(earlier), np.nan)})


def _better(block: Broadcast, scores: Scores, scale: float) -> Callable[..., Column]:
    """The step from the best class so far to the best with the classes of a block."""

    @F.pandas_udf(BEST)
    def better(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        matrix, names = unpacked(block.value), np.array(block.value["names"], dtype=object)
        for values, before in batches:
            if values.empty:
                yield pd.DataFrame({"score": [], "name": [], "mass": []})
            else:
                yield _merged(before, scores(values, matrix), names, scale)

    return better


def best_in_blocks(df: DataFrame, value: Column, blocks: DataFrame, scores: Scores, into: str, scale: float = 1.0) -> DataFrame:
    """Add (score, name, mass) of the best class; nulls where the value has no answer.

    ``mass`` is the sum of exp((score - best) / scale) over all classes.
    """
    spark = df.sparkSession
    places = [r["at"] for r in blocks.select("at").orderBy("at").collect()]  # a number for each block
    none = F.struct(F.lit(None).cast("double").alias("score"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("double").alias("mass"))
    rows = with_once(df, {"_value": value}).withColumn(into, none)
    for k, at in enumerate(places):
        row = blocks.where(F.col("at") == at).first().asDict()  # one block
        block = spark.sparkContext.broadcast(row)

        rows = rows.withColumn(into, _better(block, scores, scale)("_value", into))
        if k + 1 < len(places):
            path = scratch_path(spark, "blocks")
            rows.write.parquet(path)
            rows = spark.read.schema(rows.schema).parquet(path)
            block.destroy()
    return rows.drop("_value")

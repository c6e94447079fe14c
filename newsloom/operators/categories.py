"""Topic categories: phrase rule first, nearest description as the fallback."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.functions import text as T
from newsloom.operators import lexicon as L
from newsloom.operators import model_blocks as M
from newsloom.session import scratch_path

#: Vectors that are compared together.
CENTROID_BYTES = 32 << 20


def leading_categories(scores: Column) -> Column:
    """Names scoring close to the best one, in declared order, the first few."""

    def near_best(rows: Column) -> Column:
        best = F.array_max(F.transform(rows, lambda s: s["hits"]))
        least = best * F.lit(fixed.KEEP_RATIO)
        near = F.filter(rows, lambda s: (s["hits"] > 0) & (s["hits"] >= least))
        return F.slice(F.transform(near, lambda s: s["categorie"]), 1, fixed.MAX_CATEGORIES)

    return T.let(scores, near_best)


def _term_counts(text: str) -> dict[str, int]:
    terms = T.normalize_word(text).split()
    return {t: terms.count(t) for t in L.unique(terms)}


def description_similarities(word_list: Column, descriptions: Mapping[str, str]) -> Column:
    """Cosine of the text's term counts with those of every description.

    Null when the text shares no word with any of them.
    """
    counts = {category: _term_counts(text) for category, text in descriptions.items()}
    rows = [
        {"categorie": category, "terms": terms, "length": sum(n * n for n in terms.values()) ** 0.5}
        for category, terms in counts.items()
    ]
    constant = F.from_json(
        F.lit(json.dumps(rows)),
        "array<struct<categorie: string, terms: map<string, int>, length: double>>",
    )

    def squared_length(listed: Column) -> Column:
        # Equal words are neighbours once sorted: one walk adds up n * n as 1 + 3 + 5 + ...
        start = F.struct(
            F.lit(None).cast("string").alias("word"), F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("total")
        )

        def step(done: Column, word: Column) -> Column:
            run = F.when(done["word"] == word, done["run"] + 1).otherwise(F.lit(1).cast("long"))
            return F.struct(word.alias("word"), run.alias("run"), (done["total"] + 2 * run - 1).alias("total"))

        return F.aggregate(F.array_sort(listed), start, step, lambda done: done["total"])

    def similarity(row: Column, shared: Column, squares: Column) -> Column:
        dot = F.aggregate(
            shared,
            F.lit(0),
            lambda total, w: total + F.coalesce(F.try_element_at(row["terms"], w), F.lit(0)),
        )
        score = dot / (F.sqrt(squares) * row["length"])
        return F.struct(row["categorie"].alias("categorie"), score.alias("score"))

    def compared(listed: Column, shared: Column) -> Column:
        return T.let(
            squared_length(listed),
            lambda squares: F.transform(constant, lambda row: similarity(row, shared, squares)),
        )

    def similar(listed: Column) -> Column:
        return T.let(
            L.only_listed(listed, [t for terms in counts.values() for t in terms]),
            lambda shared: F.when(F.size(shared) > 0, compared(listed, shared)),
        )

    return T.let(word_list, similar)


def nearest_description(
    normalized: Column,
    descriptions: Mapping[str, str] | None = None,
    threshold: float = fixed.SIMILARITY_THRESHOLD,
    chars: int | None = None,
) -> Column:
    """Closest description by the words of the text, or the default category.

    ``chars`` takes the first characters only, as for a model of bounded input
    (``fixed.VECTOR_CHARS``).
    """
    descriptions = fixed.CATEGORY_DESCRIPTIONS if descriptions is None else descriptions
    cut = T.words(normalized if chars is None else F.trim(F.substring(normalized, 1, chars)))

    def closest(scores: Column) -> Column:
        best = F.array_max(F.transform(scores, lambda s: s["score"]))
        first = F.get(F.filter(scores, lambda s: s["score"] == best), F.lit(0))
        return F.when(best >= threshold, first["categorie"])

    return F.coalesce(
        T.let(description_similarities(cut, descriptions), closest),
        F.lit(fixed.DEFAULT_CATEGORY),
    )


def categorize(
    normalized: Column,
    phrases: Mapping[str, Sequence[str]] | None = None,
    descriptions: Mapping[str, str] | None = None,
    fallback: Column | None = None,
    found: Column | None = None,
) -> Column:
    """Categories of a normalised text, at least one.

    ``fallback`` names the category of a text no phrase fits; by default the
    nearest description is taken.  ``found`` are the phrases in the text, if they
    are at hand.  Texts of a few words get the default.
    """
    table = L.phrase_table(phrases)
    word_count = F.size(T.words(normalized))
    if found is None:
        found = L.phrases_found(normalized, table)
    scores = T.let(found, lambda each: L.phrase_scores(each, table))
    named = leading_categories(scores)
    if fallback is None:
        fallback = nearest_description(normalized, descriptions)
    default = F.array(F.lit(fixed.DEFAULT_CATEGORY))
    return F.when(word_count < fixed.MIN_CATEGORY_WORDS, default).otherwise(
        T.let(named, lambda names: F.when(F.size(names) > 0, names).otherwise(F.array(fallback)))
    )


def class_means(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Element-wise mean vector per label, combined task by task."""
    mean = Summarizer.mean(array_to_vector(F.col(vector)))
    return df.groupBy(label).agg(vector_to_array(mean).alias(vector))


def centroid_blocks(means: DataFrame, label: str, vector: str, block_bytes: int = CENTROID_BYTES) -> DataFrame:
    """Class means as blocks of unit vectors in label order, each of at most ``block_bytes``; written."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, columns, size = [], [], 0
        for batch in batches:
            for name, values in zip(batch["_label"], batch["_vector"], strict=True):
                column = np.asarray(values, dtype="float64")
                if names and size + column.nbytes > block_bytes:
                    yield pd.DataFrame([M.packed(0, names, np.array(columns).T.copy())])
                    names, columns, size = [], [], 0
                length = np.linalg.norm(column)
                names.append(str(name))
                columns.append(column / (length if length else 1.0))
                size += column.nbytes
        if names:
            yield pd.DataFrame([M.packed(0, names, np.array(columns).T.copy())])

    spark = means.sparkSession
    named = means.select(F.col(label).alias("_label"), F.col(vector).alias("_vector"))
    ordered = named.repartitionByRange("_label").sortWithinPartitions("_label")
    blocks = ordered.mapInPandas(pack, M.BLOCK).withColumn("at", F.monotonically_increasing_id())
    path = scratch_path(spark, "centroids")
    blocks.write.parquet(path)
    return spark.read.schema(blocks.schema).parquet(path)


def _cosines(vectors: pd.Series, matrix: np.ndarray) -> np.ndarray:
    """Cosines with the unit vectors of a block; a null vector has none, a zero vector those of zero."""
    given = vectors.notna().to_numpy()
    found = np.full((len(vectors), matrix.shape[1]), np.nan)
    if given.any():
        rows = np.stack(vectors[given].to_numpy()).astype("float64")
        norms = np.linalg.norm(rows, axis=1, keepdims=True)
        found[given] = (rows / np.where(norms == 0, 1, norms)) @ matrix
    return found


def nearest_category(
    df: DataFrame,
    vector: str,
    centroids: Sequence[tuple[str, Sequence[float]]] | DataFrame,
    threshold: float = fixed.SIMILARITY_THRESHOLD,
) -> DataFrame:
    """Best category by cosine, the first one on a tie; below the threshold the default.

    ``centroids`` are a few named vectors, or the blocks of any number of them.
    Every Arrow batch is one matrix product for each block, so rows meet no join.
    """
    if not isinstance(centroids, DataFrame):
        rows = [(name, [float(x) for x in values]) for name, values in centroids]
        centroids = centroid_blocks(df.sparkSession.createDataFrame(rows, "name string, v array<double>"), "name", "v")
    best = M.best_in_blocks(df, F.col(vector), centroids, _cosines, "_nearest")
    chosen = F.when(F.col("_nearest.score") >= threshold, F.col("_nearest.name")).otherwise(fixed.DEFAULT_CATEGORY)
    return best.select(*df.columns, F.col("_nearest.score").alias("similarity"), chosen.alias("categorie"))

"""Sentiment: word lists for Malagasy, a trained classifier for French.

The classifier is the trigram model of the language detector with sentiment
classes as labels: counted, scaled to whole numbers, of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.functions import text as T
from newsloom.operators import language as G
from newsloom.operators import lexicon as L
from newsloom.operators import model_blocks as M


def lexicon_score(
    word_list: Column,
    positive: Sequence[str] = tuple(fixed.POSITIVE_WORDS),
    negative: Sequence[str] = tuple(fixed.NEGATIVE_WORDS),
) -> Column:
    """(praise - complaint) / (praise + complaint), 0 without either."""

    def ratio(count: Column) -> Column:
        praise, complaint = count["praise"], count["complaint"]
        return F.try_divide((praise - complaint).cast("double"), praise + complaint)

    def score(marked: Column) -> Column:
        praise, complaint = L.lexicon_hits(marked, positive), L.lexicon_hits(marked, negative)
        return T.let(F.struct(praise.alias("praise"), complaint.alias("complaint")), ratio)

    # One pass over the words; the few that are left are looked up again.
    marked = L.only_listed(word_list, [*positive, *negative])
    return F.coalesce(T.let(marked, score), F.lit(0.0))


def sentiment_label(score: Column) -> Column:
    """Label of a score; no score, no label."""
    return (
        F.when(score > fixed.POSITIVE_ABOVE, "positif")
        .when(score < fixed.NEGATIVE_BELOW, "negatif")
        .when(score.isNotNull(), "neutre")
    )


def score_by_language(language: Column, french: Column, malagasy: Column) -> Column:
    """The classifier's score for French, the word lists' for Malagasy, else 0."""
    return (
        F.when(language == "fr", F.coalesce(french, F.lit(0.0)))
        .when(language == "mg", malagasy)
        .otherwise(F.lit(0.0))
    )


def sentiment_of(
    model: G.Weights, negative: str = "0", neutral: str | None = None, chars: int | None = None
) -> Callable[[str | None], float]:
    """A function from a normalised text to its signed confidence.

    ``model`` are trigram profiles of the classes (``G.train_language_profiles``
    with the class as the label).  The confidence is the share of the best class
    in the likelihood; it has a minus sign for the negative class.  Every other
    class counts as positive, a neutral one too unless it is named; then it
    scores 0.  A text without a trigram scores 0.  ``chars`` reads the first
    characters only, as a model of bounded input would (``fixed.MODEL_CHARS``).
    """
    of_grams = sentiment_of_grams(model, negative, neutral)
    return lambda text: of_grams(G.text_grams((text or "")[:chars]))


def sentiment_of_grams(model: G.Weights, negative: str = "0", neutral: str | None = None) -> Callable[[np.ndarray], float]:
    """The same from a text's trigrams."""
    classes, matrix = model

    def score(grams: np.ndarray) -> float:
        if not grams.size:
            return 0.0
        sums = matrix[grams].sum(axis=0) / G.SCALE
        best = int(sums.argmax())
        confidence = float(1 / np.exp(sums - sums[best]).sum())
        if classes[best] == neutral:
            return 0.0
        return -confidence if classes[best] == negative else confidence

    return score


def model_sentiment(normalized: Column, model: G.Weights, **settings) -> Column:
    """The signed confidence of a normalised text."""
    score = sentiment_of(model, **settings)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(score).astype("float64")

    return scored(normalized)


def score_in_blocks(
    df: DataFrame, normalized: Column, blocks: DataFrame, into: str, negative: str = "0", neutral: str | None = None
) -> DataFrame:
    """Add the signed confidence of a normalised text, by a model of any number of classes."""
    best = F.col(into)
    sign = F.when(best["name"] == neutral, 0.0) if neutral is not None else F.when(F.lit(False), 0.0)
    sign = sign.when(best["name"] == negative, -1.0).otherwise(1.0)
    scored = M.best_in_blocks(df, normalized, blocks, G.text_scores, into, scale=float(G.SCALE))
    return scored.withColumn(into, F.coalesce(sign / best["mass"], F.lit(0.0)))

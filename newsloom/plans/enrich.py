"""Enrichment: one pass that adds language, sentiment, categories and origin."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.functions import html as H
from newsloom.functions import text as T
from newsloom.functions.staging import with_once
from newsloom.operators import categories as C
from newsloom.operators import language as G
from newsloom.operators import lexicon as L
from newsloom.operators import sentiment as S
from newsloom.operators.origin import origin_of
from newsloom.operators.quality import passes_gate, quality_gate


ADDED = ("langue", "sentiment_score", "sentiment", "categorie", "origin")


def _read_texts(
    normalized: Column,
    listed: Column,
    phrases: L.Phrases,
    language_model: G.Weights | None,
    sentiment_model: G.Weights | None,
) -> Column:
    """Language, French sentiment and phrases of a text, which crosses to Python once.

    The language is asked for where the word list left the mark '?', the sentiment
    where the text is French by either.  A text that a model fails on keeps
    nulls, as one without an answer.
    """
    every = L.unique(p for _, entries in phrases for p in entries)

    @F.pandas_udf("detected string, french double, found array<string>")
    def read(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        search = L.phrase_search(every)
        detect = G.language_of_grams(language_model) if language_model else lambda grams: None
        score = S.sentiment_of_grams(sentiment_model) if sentiment_model else lambda grams: 0.0

        def one(text: str | None, mark: str | None) -> tuple:
            if text is None:
                return None, None, []
            try:
                # Both models read the same trigrams; a text on the word list's side has no use for them.
                grams = G.text_grams(text) if mark in ("?", "fr") else None
                detected = detect(grams) if mark == "?" else None
                french = mark == "fr" or (mark == "?" and (detected or "fr") == "fr")
                return detected, score(grams) if french else None, search(text)
            except (ValueError, ArithmeticError, LookupError):
                return None, None, []

        for texts, marks in batches:
            rows = [one(text, mark) for text, mark in zip(texts, marks, strict=True)]
            yield pd.DataFrame(rows, columns=["detected", "french", "found"])

    return read(normalized, listed)


def enrich_articles(
    df: DataFrame,
    language_model: G.Weights | None = None,
    sentiment_model: G.Weights | None = None,
    malagasy: Sequence[str] = tuple(fixed.MALAGASY_WORDS),
    positive: Sequence[str] = tuple(fixed.POSITIVE_WORDS),
    negative: Sequence[str] = tuple(fixed.NEGATIVE_WORDS),
    phrases: Mapping[str, Sequence[str]] | None = None,
    min_ratio: float = fixed.MALAGASY_RATIO,
    origins: dict[str, str] | None = None,
    other_label: str = "mg",
) -> DataFrame:
    """Gate, clean and enrich ``titre, contenu, source`` rows; other columns stay.

    A map over the rows: no shuffle and no join, so it runs at the speed of the
    scan and a lost task costs one partition.  The gate comes first and sees
    the raw text.  The models are trained beforehand (``plans.models``).  Without
    a language model unlisted text is French; without a sentiment model French
    text scores 0, which is also what a failing model gives.
    """
    return _enriched(
        quality_gate(df), language_model, sentiment_model, malagasy, positive, negative, phrases, min_ratio, origins, other_label
    ).select(*[c for c in df.columns if c not in ADDED], *ADDED)


def _enriched(
    df: DataFrame, language_model, sentiment_model, malagasy, positive, negative, phrases, min_ratio, origins, other_label
) -> DataFrame:
    cleaned = H.clean_html_text(df, "contenu", "contenu")
    normal = with_once(cleaned, {"_norm": T.normalize_text(F.col("contenu"))})
    worked = with_once(normal, {"_words": T.words(F.col("_norm"))})
    text, norm, word_list = F.col("contenu"), F.col("_norm"), F.col("_words")

    # Texts the word list leaves open are marked '?'; only they are detected.
    listed = G.detect_language(text, word_list, words=malagasy, min_ratio=min_ratio, unlisted="?")
    worked = with_once(worked, {"_listed": listed})
    table = L.phrase_table(phrases)
    if isinstance(language_model, DataFrame):  # more languages than one matrix holds
        worked = G.detect_in_blocks(worked, F.when(F.col("_listed") == "?", norm), language_model, "_detected")
        settled = G.settled_language(F.col("_listed"), F.col("_detected"), other_label=other_label)
        worked, language_model = with_once(worked, {"_listed": settled}).drop("_detected"), None
    blocks = sentiment_model if isinstance(sentiment_model, DataFrame) else None
    own = None if blocks is not None else sentiment_model
    worked = worked.withColumn("_read", _read_texts(norm, F.col("_listed"), table, language_model, own))
    settled = G.settled_language(F.col("_listed"), F.col("_read.detected"), other_label=other_label)
    worked, french = worked.withColumn("langue", settled), F.col("_read.french")
    if blocks is not None:
        worked, french = S.score_in_blocks(worked, F.when(F.col("langue") == "fr", norm), blocks, "_french"), F.col("_french")
    malagasy_score = S.lexicon_score(word_list, positive, negative)
    score = S.score_by_language(F.col("langue"), french, malagasy_score)
    named = C.categorize(norm, phrases, found=F.col("_read.found"))
    worked = with_once(worked, {"sentiment_score": score, "categorie": named})
    return worked.withColumns(
        {
            "sentiment": S.sentiment_label(F.col("sentiment_score")),
            "origin": origin_of(F.col("source"), origins),
        }
    )


def reenrich(
    df: DataFrame,
    language_model: G.Weights | None = None,
    sentiment_model: G.Weights | None = None,
    malagasy: Sequence[str] = tuple(fixed.MALAGASY_WORDS),
    positive: Sequence[str] = tuple(fixed.POSITIVE_WORDS),
    negative: Sequence[str] = tuple(fixed.NEGATIVE_WORDS),
    phrases: Mapping[str, Sequence[str]] | None = None,
    min_ratio: float = fixed.MALAGASY_RATIO,
    origins: dict[str, str] | None = None,
    other_label: str = "mg",
) -> DataFrame:
    """Recompute a whole table in one pass; rows that fail the gate stay as they are.

    Their text is null to the enrichment, which costs it nothing.  Columns that
    the enrichment adds and the table lacks are null in them.
    """
    valid = F.coalesce(passes_gate(F.col("titre"), F.col("contenu")), F.lit(False))
    flagged = with_once(df, {"_valid": valid}).withColumn("_old", F.struct(*df.columns))
    asked = flagged.withColumn("contenu", F.when(F.col("_valid"), F.col("contenu")))
    done = _enriched(
        asked, language_model, sentiment_model, malagasy, positive, negative, phrases, min_ratio, origins, other_label
    )

    def either(name: str) -> Column:
        old = F.col("_old")[name] if name in df.columns else F.lit(None)
        return F.when(F.col("_valid"), F.col(name)).otherwise(old).alias(name)

    changed = {"contenu", *ADDED}
    return done.select(
        *[either(c) if c in changed else F.col(c) for c in df.columns if c not in ADDED], *[either(c) for c in ADDED]
    )

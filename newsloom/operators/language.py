"""Language: word list first, then a character-trigram detector.

The detector is multinomial naive Bayes over trigrams of blank-padded words in
the letters a to z.  There are fewer than 27**3 = 19,683 of them, whatever the
size of the corpus, so the trained table has a proven bound: that many rows per
language.  Log probabilities are scaled to whole numbers; a sum of whole
numbers does not depend on how Spark orders the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from newsloom import fixed_values as fixed
from newsloom.functions import text as T
from newsloom.operators import lexicon as L
from newsloom.operators import model_blocks as M
from newsloom.session import scratch_path

LETTERS = " abcdefghijklmnopqrstuvwxyz"
GRAMS = len(LETTERS) ** 3
SCALE = 10_000

#: Languages of one matrix: 20 MB.
CLASSES_AT_ONCE = 128

Weights = tuple[list[str], np.ndarray]


def letters_only(normalized: Column) -> Column:
    """Everything but a to z is a blank."""
    return F.trim(F.regexp_replace(normalized, "[^a-z]+", " "))


def padded_trigrams(word: Column) -> Column:
    """Runs of three in a word with a blank at either end: ' wo', 'wor', ..., 'rd '."""
    return F.regexp_extract_all(
        F.concat(F.lit(" "), word, F.lit(" ")), F.lit("(?=([a-z ]{3}))"), F.lit(1)
    )


def train_language_profiles(df: DataFrame, text: str, label: str) -> DataFrame:
    """Trigram counts per language and their scaled log probability (add-one).

    What stands between blanks is counted as it is, then normalised and counted by
    words, before these are cut into trigrams: normalising works on what differs, and
    the cutting on the vocabulary, not on the corpus.  No rule of the normalisation
    looks across a blank.  All counts combine task by task.
    """
    pieces = df.select(F.col(label).alias("lang"), F.explode(F.split(F.col(text), " ")).alias("piece"))
    different = pieces.where(F.col("piece") != "").groupBy("lang", "piece").agg(F.count("*").alias("n"))
    listed = F.split(letters_only(T.normalize_text(F.col("piece"))), " ")
    words = different.select("lang", "n", F.explode(listed).alias("word"))
    vocabulary = words.where(F.col("word") != "").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    grams = vocabulary.select("lang", "n", F.explode(padded_trigrams(F.col("word"))).alias("gram"))
    counts = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # At most GRAMS rows per language meet in this window.
    mass = F.sum("n").over(Window.partitionBy("lang")) + GRAMS
    return counts.withColumn("_mass", mass).select(
        "lang",
        "gram",
        "n",
        F.round(F.ln((F.col("n") + 1) / F.col("_mass")) * SCALE).cast("long").alias("weight"),
        F.round(F.ln(1 / F.col("_mass")) * SCALE).cast("long").alias("unseen"),
    )


def _gram_index(gram: str) -> int:
    a, b, c = (LETTERS.index(ch) for ch in gram)
    return (a * len(LETTERS) + b) * len(LETTERS) + c


def language_blocks(profiles: DataFrame, at_once: int = CLASSES_AT_ONCE) -> DataFrame:
    """The trained table as blocks of matrices: 19,683 rows, a column for each of ``at_once`` languages."""
    spark = profiles.sparkSession
    names = profiles.select("lang").distinct()
    # One short row for each language meets in this window.
    numbered = names.withColumn("_place", F.row_number().over(Window.orderBy("lang")) - 1)
    rows = profiles.join(numbered, "lang").withColumn("_block", F.floor(F.col("_place") / at_once).cast("long"))

    def dense(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        languages = sorted(part["lang"].unique())
        column = part["lang"].map({name: k for k, name in enumerate(languages)}).to_numpy()
        matrix = np.empty((GRAMS, len(languages)), dtype="int64")
        matrix[:, column] = part["unseen"].to_numpy()
        matrix[[_gram_index(g) for g in part["gram"]], column] = part["weight"].to_numpy()
        return pd.DataFrame([M.packed(int(key[0]), languages, matrix)])

    blocks = rows.groupBy("_block").applyInPandas(dense, M.BLOCK)
    path = scratch_path(spark, "language-blocks")
    blocks.write.parquet(path)
    return spark.read.schema(blocks.schema).parquet(path)


def language_weights(profiles: DataFrame, at_once: int = CLASSES_AT_ONCE) -> Weights | DataFrame:
    """The trained table ready for use.

    Up to ``at_once`` languages it is one matrix that travels with a function; with
    more it is the table of its blocks (``detect_in_blocks``).
    """
    blocks = language_blocks(profiles, at_once)
    rows = blocks.limit(2).collect() if blocks.count() == 1 else []
    if not rows:
        return blocks
    return list(rows[0]["names"]), M.unpacked(rows[0].asDict())


def text_scores(texts: pd.Series, matrix: np.ndarray) -> np.ndarray:
    """The score of each text in each class of a block; NaN for a text without a trigram."""
    found = np.full((len(texts), matrix.shape[1]), np.nan)
    for k, text in enumerate(texts):
        grams = text_grams(text) if isinstance(text, str) else np.empty(0, "int64")
        if grams.size:
            found[k] = matrix[grams].sum(axis=0)
    return found


def detect_in_blocks(df: DataFrame, normalized: Column, blocks: DataFrame, into: str) -> DataFrame:
    """Add the most likely language of a normalised text, of any number of languages."""
    return M.best_in_blocks(df, normalized, blocks, text_scores, into).withColumn(into, F.col(into)["name"])


def _grams(text: bytes) -> np.ndarray:
    """Matrix rows of all trigrams of the blank-padded words of a text."""
    codes = np.zeros(len(text) + 2, dtype="int64")
    codes[1:-1] = np.frombuffer(text, dtype="uint8")
    codes -= 96
    codes[(codes < 1) | (codes > 26)] = 0
    # Of several blanks in a row one is as good as all.
    keep = codes > 0
    keep[1:] |= codes[:-1] > 0
    keep[0] = True
    codes = codes[keep]
    base = len(LETTERS)
    grams = (codes[:-2] * base + codes[1:-1]) * base + codes[2:]
    return grams[codes[1:-1] > 0]


def text_grams(text: str) -> np.ndarray:
    """Matrix rows of all trigrams of a normalised text."""
    return _grams(text.encode("utf-8"))


def language_of(model: Weights) -> Callable[[str | None], str | None]:
    """A function from a normalised text to its most likely language.

    None for a text without a trigram; the alphabetically first language on a tie.
    """
    of_grams = language_of_grams(model)
    return lambda text: of_grams(text_grams(text or ""))


def language_of_grams(model: Weights) -> Callable[[np.ndarray], str | None]:
    """The same from a text's trigrams."""
    languages, matrix = model

    def best(grams: np.ndarray) -> str | None:
        return languages[int(matrix[grams].sum(axis=0).argmax())] if grams.size else None

    return best


def ngram_detector(model: Weights) -> Callable[[Column], Column]:
    """The same for a column.

    The matrix travels with the function.  Texts go through Arrow in batches and
    each is one vector lookup, so detection needs no shuffle however long the
    texts are.
    """
    best = language_of(model)

    # An iterator function: Spark keeps it apart from the plain Pandas functions
    # below it.  Two of one kind it would merge into a single Python step, and
    # for that it would write every expression between them out again.
    @F.pandas_udf(StringType())
    def detect(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(best, na_action="ignore").astype(object)

    return detect


def malagasy_ratio(word_list: Column, words: Sequence[str] = tuple(fixed.MALAGASY_WORDS)) -> Column:
    """Share of the words that are on the list; null without words."""
    return F.try_divide(L.lexicon_hits(word_list, words), F.size(word_list))


def is_undetectable(text: Column, word_list: Column) -> Column:
    """Blank or too short to tell a language by."""
    long_enough = F.coalesce(T.has_length(text, fixed.MIN_DETECTABLE_LENGTH), F.lit(False))
    return ~long_enough | (F.size(word_list) == 0)


def detect_language(
    text: Column,
    word_list: Column,
    words: Sequence[str] = tuple(fixed.MALAGASY_WORDS),
    min_ratio: float = fixed.MALAGASY_RATIO,
    default: str = "fr",
    listed: str = "mg",
    unlisted: str = "fr",
) -> Column:
    """Too little text has the default language, enough listed words the listed one.

    ``unlisted`` stands for all other texts, whether it is the final answer or
    a mark for the detector.
    """
    return (
        F.when(is_undetectable(text, word_list), default)
        .when(malagasy_ratio(word_list, words) >= min_ratio, listed)
        .otherwise(unlisted)
    )


def settled_language(
    listed: Column, detected: Column, mark: str = "?", default: str = "fr", other_label: str = "mg"
) -> Column:
    """The detector's answer where the word list left the mark.

    The default language is kept, any other one becomes ``other_label``, and no
    answer gives the default.
    """
    answer = F.when(F.coalesce(detected, F.lit(default)) == default, default).otherwise(other_label)
    return F.when(listed == mark, answer).otherwise(listed)

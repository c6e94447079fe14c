"""Many phrases in many texts, by an inverted index of the phrases' grams.

A phrase may start and end inside words, so it is found by a piece of itself that lies
inside one word: its anchor, of ``GRAM`` characters, or a shorter word of the phrase if
no longer one is there.  Of a phrase's grams the one that the fewest phrases have is
taken.  A text gives the distinct grams of its distinct words; those that are anchors
meet the phrases behind them, and ``contains`` decides.

The index goes to the texts: blocks of at most about ``BLOCK`` phrases are broadcast,
one pass of the texts for each, so texts are neither shuffled nor copied, and any
number of phrases is searched.  Explosion, lookup and test are one generated loop; a
row leaves it for each phrase that is there.

With an index of very many phrases most grams are those of many, and the texts meet far
more phrases than they hold.  ``automata`` searches the same blocks by an automaton each,
which reads a text once and stops only where a phrase ends: what it costs is the texts and
what is found, whatever share of the phrases looks alike.

Where only the number of texts of each phrase is asked for, ``counted`` looks the distinct
words of the texts up instead of the texts.  Its tables are small, so that millions of phrases
are one block, and each task counts before anything is laid out as rows.

Texts and phrases are normalised: words parted by single blanks.  An empty phrase is in
no text; a null text holds none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.operators import lexicon as L
from newsloom.operators import phrase_words as W
from newsloom.session import scratch_path

GRAM = 4
BLOCK = 100_000
#: Phrases of a block of ``counted``, and bytes of phrases.
COUNTED, COUNTED_BYTES = 2_000_000, 32 << 20


def _grams(word: Column, width: int) -> Column:
    """The pieces of a word of this width."""
    last = F.length(word) - (width - 1)
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda k: F.substring(word, k, F.lit(width)))).otherwise(
        F.array().cast("array<string>")
    )


def phrase_index(phrases: DataFrame, phrase: str = "phrase") -> DataFrame:
    """The distinct phrases with their anchor and its width."""
    every = phrases.where(F.col(phrase) != "").select(F.col(phrase).alias("phrase")).distinct()
    word = F.explode(F.array_distinct(F.filter(F.split("phrase", " "), lambda w: w != "")))
    words = every.select("phrase", word.alias("word"), F.array_max(F.transform(F.split("phrase", " "), F.length)).alias("longest"))
    width = F.least(F.col("longest"), F.lit(GRAM))
    pieces = words.where(F.length("word") >= width).select(
        "phrase", width.alias("width"), F.explode(F.array_distinct(reduce(
            lambda other, n: F.when(width == n, _grams(F.col("word"), n)).otherwise(other), range(1, GRAM), _grams(F.col("word"), GRAM)
        ))).alias("gram")
    )
    shared = pieces.groupBy("gram").agg(F.countDistinct("phrase").alias("_phrases"))
    rarest = Window.partitionBy("phrase").orderBy("_phrases", "gram")
    ranked = pieces.join(shared, "gram").withColumn("_place", F.row_number().over(rarest))
    return ranked.where("_place = 1").select("phrase", "gram", "width")


def _in_block(number: int, blocks: int) -> Column:
    """Whether a phrase is in this block."""
    return F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == number


def _search(block: Broadcast) -> Column:
    """The phrases of a block that are in ``_text``, each once."""

    @F.pandas_udf("array<string>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        search = L.phrase_search(block.value)
        for texts in batches:
            yield texts.map(search, na_action="ignore").astype(object)

    return found("_text")


def _read_again(texts: DataFrame, blocks: int) -> DataFrame:
    """For more than one block the texts are written before, as they are read again."""
    if blocks == 1:
        return texts
    place = scratch_path(texts.sparkSession, "phrase-texts")
    texts.write.parquet(place)
    return texts.sparkSession.read.schema(texts.schema).parquet(place)


def _by_automata(texts: DataFrame, kept: list[str], index: DataFrame, blocks: int) -> DataFrame:
    """The phrases of one block after the other."""
    spark = texts.sparkSession
    texts = _read_again(texts, blocks)
    found = []
    for number in range(blocks):
        listed = [r["phrase"] for r in index.where(_in_block(number, blocks)).select("phrase").collect()]  # one block
        if listed:
            held = _search(spark.sparkContext.broadcast(listed))
            found.append(texts.select(*kept, F.explode(held).alias("phrase")))
    none = texts.select(*kept, F.lit("").alias("phrase")).where(F.lit(False))
    return reduce(DataFrame.union, found, none)


def _counted(block: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """In how many texts of a task each phrase of a block stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = W.Search(block.value)
        for batch in batches:
            search.add(batch.column(0))
        yield from search.found()

    return count


def _by_words(texts: DataFrame, index: DataFrame, block: int) -> DataFrame:
    """(phrase, n) of each task, block by block."""
    spark = texts.sparkSession
    size = index.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("phrase")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size["n"] // block), -(-size["bytes"] // COUNTED_BYTES))
    texts = _read_again(texts, blocks)
    found = []
    for number in range(blocks):
        listed = index.where(_in_block(number, blocks)).select("phrase").toArrow()["phrase"]  # one block
        phrases = W.Phrases(pa.concat_arrays([pa.array([], pa.string()), *(c.cast(pa.string()) for c in listed.chunks)]))
        found.append(texts.mapInArrow(_counted(spark.sparkContext.broadcast(phrases)), "phrase string, n long"))
    return reduce(DataFrame.union, found)


def phrases_in(
    texts: DataFrame, text: str, index: DataFrame, block: int | None = None, automata: bool = False, counted: bool = False
) -> DataFrame:
    """The columns of ``texts`` but the text, with each phrase that it holds, once.

    ``counted`` gives (phrase, n) instead: numbers of texts, which are to be added up for each phrase.
    """
    kept = [c for c in texts.columns if c != text]
    place = scratch_path(texts.sparkSession, "phrases")
    index.write.parquet(place)
    index = texts.sparkSession.read.schema(index.schema).parquet(place)
    if counted:
        return _by_words(texts.select(F.col(text).alias("_text")), index, block or COUNTED)
    block = block or BLOCK
    counts = {r["width"]: r["n"] for r in index.groupBy("width").agg(F.count("*").alias("n")).collect()}  # GRAM widths at most
    blocks = max(1, -(-sum(counts.values()) // block))
    if automata:
        return _by_automata(texts.select(*kept, F.col(text).alias("_text")), kept, index, blocks)
    words = F.array_distinct(T.words(F.col(text)))

    def of_width(n: int) -> Column:
        return F.flatten(F.transform(words, lambda w: _grams(w, n)))

    grams = F.array_distinct(F.concat(*[of_width(n) for n in sorted(counts)])) if counts else F.array().cast("array<string>")
    exploded = texts.select(*kept, F.col(text).alias("_text"), F.explode(grams).alias("_gram"))
    found = []
    for number in range(blocks):
        part = index.select(F.col("gram").alias("_gram"), F.col("phrase"))
        if blocks > 1:
            part = part.where(_in_block(number, blocks))
        met = exploded.join(F.broadcast(part), "_gram")
        found.append(met.where(F.col("_text").contains(F.col("phrase"))).select(*kept, "phrase"))
    return reduce(DataFrame.union, found)


def category_hits(texts: DataFrame, text: str, phrases: DataFrame, *group: str, block: int = BLOCK) -> DataFrame:
    """(the columns of ``texts`` but the text, ``group``, hits): entries of each group found in a text.

    ``phrases`` has the columns ``group`` and phrase; entries that are equal count each.
    """
    kept = [c for c in texts.columns if c != text]
    entries = phrases.groupBy("phrase", *group).agg(F.count("*").alias("_entries"))
    held = phrases_in(texts, text, phrase_index(phrases), block, automata=True)
    return held.join(entries, "phrase").groupBy(*kept, *group).agg(F.sum("_entries").alias("hits"))

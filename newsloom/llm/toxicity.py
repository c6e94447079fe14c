"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded before matching: compatibility forms and accents go, lookalike
letters of other scripts and digits or signs that stand for letters inside a word
are replaced, everything else between words becomes one blank.  As accents also tell
words apart, a text is matched with them as well and the larger weight counts.  The lexicon holds
words and beginnings of words, each with a weight; one pass of the automaton finds
all of them.  Matches inside an exception phrase do not count.  The weights found
are summed, divided by the length in words to the power ``LENGTH_POWER``, and turned into
a score between 0 and 1 that is 0.5 at the learned limit.

Learning counts, for every word and beginning of a word, the toxic and the other
labelled documents that hold it.  A term enters the lexicon when at least
``MIN_DOCS`` toxic documents hold it and its smoothed log odds reach ``MIN_ODDS``; a
term that a shorter one of the lexicon explains as well stays out.  The limit is the
one that errs least on the documents learned from.  At most ``SAMPLE_ROWS`` labelled
documents are learned from, in the order of a hash of their ids.

Cases: a null or empty text, or one without words, scores 0; without labels the
lexicon is empty and every score is 0; labels that name a document twice count it
once, as toxic if any says so; rows are independent, so repeated rows and null ids
get the score of their text; an empty table gives an empty one; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.shared import cut, map_batches, settle

SAMPLE_ROWS = 40_000
MIN_DOCS = 5
MIN_ODDS = 4.0
#: Letters of the beginnings of words that may become terms.
PREFIXES = (4, 5, 6, 7)
LENGTH_POWER = 0.25

#: Phrases whose words are not meant as an insult.
EXCEPTIONS = (
    "trash can",
    "trash bin",
    "idiot proof",
    "pond scum",
    "clown fish",
    "sore loser rule",
    "pathetic fallacy",
)

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ɡ": "g", "ɑ": "a", "ʟ": "l",
}
#: Digits and signs that stand for letters inside a word.
STANDINS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}

_HOMOGLYPHS = str.maketrans(HOMOGLYPHS)
_STANDINS = str.maketrans(STANDINS)
_WORD = re.compile(r"[^\W_](?:[\w@$!]*[^\W_])?")
_UNSEEN = re.compile("[\u200b-\u200d\u2060\ufeff\u00ad]")
_MARKS = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]+")
_LOOKALIKE = re.compile(f"[{''.join(HOMOGLYPHS)}]")
_HIDDEN = re.compile(r"[^\W\d_][\d@$!]|[\d@$!][^\W\d_]")


def plain(text: str | None) -> str:
    """The words of a text in lower case and compatibility form, accents kept, with single blanks."""
    text = text or ""
    if not text.isascii():
        text = _UNSEEN.sub("", unicodedata.normalize("NFKC", text))
    return " ".join(_WORD.findall(text.lower()))


def folded(words: str) -> str:
    """The same words without accents, lookalikes and stand-ins."""
    if not words.isascii():
        words = _MARKS.sub("", unicodedata.normalize("NFKD", words))
        if _LOOKALIKE.search(words):
            words = words.translate(_HOMOGLYPHS)
    if _HIDDEN.search(words):
        words = " ".join([w.translate(_STANDINS) if _HIDDEN.search(w) else w for w in words.split(" ")])
    return words


def terms_of(words: set[str]) -> set[str]:
    """The words with blanks around them, and their beginnings after a blank."""
    found = {f" {w} " for w in words if len(w) > 2}
    found.update(f" {w[:n]}" for w in words for n in PREFIXES if len(w) >= n)
    return found


def document_terms(text: str | None) -> set[str]:
    """The terms of a text as written and as folded."""
    words = plain(text)
    return terms_of({*words.split(), *folded(words).split()})


class Lexicon:
    """Weights and exceptions in one automaton."""

    def __init__(self, weights: dict[str, float], limit: float, exceptions: tuple[str, ...] = EXCEPTIONS):
        self.limit = limit
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for term, weight in weights.items():
            self.automaton.add_word(term, (len(term), weight))
        for phrase in exceptions:
            key = f" {folded(plain(phrase))} "
            self.automaton.add_word(key, (len(key), None))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.empty = not weights

    def weight(self, words: str) -> float:
        """The sum of the weights found outside exceptions, by length; each word counts once a place."""
        if self.empty or not words:
            return 0.0
        excused, found = [], {}
        for end, (size, weight) in self.automaton.iter(f" {words} "):
            start = end - size + 1
            if weight is None:
                excused.append((start, end))
            else:
                found[start] = max(weight, found.get(start, 0.0))
        if not found:
            return 0.0
        total = sum(w for at, w in found.items() if not any(a <= at < b for a, b in excused))
        return total / (words.count(" ") + 1) ** LENGTH_POWER

    def text_weight(self, text: str | None) -> float:
        """The larger weight of the words as written and as folded."""
        words = plain(text)
        bare = folded(words)
        weight = self.weight(bare)
        return weight if bare == words else max(weight, self.weight(words))

    def score(self, text: str | None) -> float:
        weight = self.text_weight(text)
        return weight / (weight + self.limit) if weight > 0 else 0.0


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """(text, toxic) of at most ``sample`` labelled documents that are not held out."""
    marks = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .where(~held_out(F.col("doc_id")))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(marks, "doc_id").select("text", "toxic")


def term_counts(rows: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(term, toxic, others): labelled documents that hold each term of the toxic ones."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = Counter()
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts.update((t, toxic) for t in document_terms(text))
        keys = list(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64())],
            names=["term", "toxic", "n"],
        )

    counted = map_batches(rows, work, "term string, toxic int, n long")
    toxic = F.col("toxic") == 1
    sums = counted.groupBy("term").agg(
        F.sum(F.when(toxic, F.col("n")).otherwise(0)).alias("toxic"), F.sum(F.when(toxic, 0).otherwise(F.col("n"))).alias("others")
    )
    return sums.where(F.col("toxic") >= min_docs)


def learned(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], float]:
    """The lexicon's weights and the limit of the length-normalised sum."""
    rows = cut(labelled(docs, labels), "toxic-rows")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_others = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_others:
        return {}, 1.0
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("others") + 0.5) / (n_others + 1.0))
    strong = term_counts(rows).withColumn("odds", odds).where(F.col("odds") >= MIN_ODDS)
    weights: dict[str, float] = {}
    # At most the terms of SAMPLE_ROWS texts that five toxic ones share.
    for r in sorted(strong.collect(), key=lambda r: (len(r["term"].strip()), r["term"])):
        word = r["term"].rstrip()
        if not any(word[:n] in weights for n in range(len(word))):
            weights[r["term"]] = round(float(r["odds"]), 6)
    return weights, _limit(rows, weights)


def _limit(rows: DataFrame, weights: dict[str, float]) -> float:
    """The normalised sum between the classes that errs least on the rows, from their histogram."""
    lexicon = Lexicon(weights, 1.0)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        steps = [round(lexicon.text_weight(t) * 100) for t in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(steps, pa.int64()), batch.column(1)], names=["step", "toxic"])

    counted = map_batches(rows, work, "step long, toxic int").groupBy("step").agg(
        F.sum((F.col("toxic") == 1).cast("long")).alias("toxic"), F.count("*").alias("n")
    )
    bins = sorted((r["step"], r["toxic"], r["n"]) for r in counted.collect())
    missed, false = 0, sum(n - t for _, t, n in bins)
    best, limit = math.inf, 1.0
    for (step, t, n), following in zip(bins, [b[0] for b in bins[1:]] + [bins[-1][0] + 100], strict=True):
        missed, false = missed + t, false - (n - t)
        if missed + false < best:
            best, limit = missed + false, (step + following) / 200
    return max(limit, 0.01)


def held_out(doc_id: Column) -> Column:
    """Documents of the fold whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scored(docs: DataFrame, weights: dict[str, float], limit: float) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs``."""
    spark = settle(docs.sparkSession)
    shared = spark.sparkContext.broadcast((weights, limit))
    ready: list[Lexicon] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not ready:
            ready.append(Lexicon(*shared.value))
        found = [ready[0].score(text) for text in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.float64()), pa.array([int(f >= 0.5) for f in found], pa.int32())],
            names=["doc_id", "held_out", "score", "predicted"],
        )

    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, work, "doc_id long, held_out boolean, score double, predicted int")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labels that are not held out, score all."""
    settle(docs.sparkSession)
    return scored(docs, *learned(docs, labels))

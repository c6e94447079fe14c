"""Word-list and phrase lookups on normalised text.

The lists are parameters of bounded size, written into the plan as constants:
a word test is a hash-set lookup and needs neither a join nor a shuffle.

Phrases may start and end inside words, so the whole text has to be searched.
One ``contains`` per phrase reads it hundreds of times; an automaton over
Arrow batches reads it once and was over ten times as fast when measured.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from newsloom import fixed_values as fixed
from newsloom.functions import text as T

Phrases = Sequence[tuple[str, Sequence[str]]]


def unique(words: Iterable[str]) -> list[str]:
    return list(dict.fromkeys(words))


def word_array(words: Iterable[str]) -> Column:
    """A constant array of words; as one text it stays a single node until it is folded."""
    return F.split(F.lit(" ".join(unique(words))), " ")


def only_listed(word_list: Column, words: Iterable[str]) -> Column:
    """The words that are on the list, repeats included.

    A hash intersection finds which ones occur; mostly none, and then the words
    are not looked at again.
    """
    constant = word_array(words)
    none = F.slice(constant, 1, 0)

    def repeats(every: Column) -> Column:
        return T.let(
            F.array_intersect(every, constant),
            lambda hit: F.when(F.size(hit) == 0, none).otherwise(
                F.filter(every, lambda w: F.array_contains(hit, w))
            ),
        )

    return T.let(word_list, repeats)


def lexicon_hits(word_list: Column, words: Iterable[str]) -> Column:
    """How many words are on the list, repeats counted."""
    return F.size(only_listed(word_list, words))


def phrase_table(phrases: Mapping[str, Sequence[str]] | None = None) -> list[tuple[str, list[str]]]:
    """Category phrases, normalised and in category order; entries that become equal both stay."""
    phrases = fixed.CATEGORY_PHRASES if phrases is None else phrases
    return [(category, [w for w in map(T.normalize_word, given) if w]) for category, given in phrases.items()]


def phrase_search(phrases: Sequence[str]) -> Callable[[str], list[str]]:
    """A function that lists the phrases occurring in a text, in their own order."""
    automaton = ahocorasick.Automaton()
    for place, phrase in enumerate(phrases):
        automaton.add_word(phrase, place)
    automaton.make_automaton()

    def search(text: str) -> list[str]:
        return [phrases[i] for i in sorted({place for _, place in automaton.iter(text)})]

    return search


def phrases_found(normalized: Column, table: Phrases) -> Column:
    """The distinct phrases that occur anywhere in the text, also inside words."""
    every = unique(p for _, phrases in table for p in phrases)
    if not every:
        return F.array().cast("array<string>")

    @F.pandas_udf(ArrayType(StringType()))
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        search = phrase_search(every)
        for texts in batches:
            yield texts.map(search, na_action="ignore").astype(object)

    return find(normalized)


def phrase_scores(found: Column, table: Phrases) -> Column:
    """Per category, in order: how many entries of its list were found."""
    rows = [{"categorie": category, "phrases": list(phrases)} for category, phrases in table]
    constant = F.from_json(
        F.lit(json.dumps(rows)), "array<struct<categorie: string, phrases: array<string>>>"
    )

    def score(row: Column, each: Column) -> Column:
        hits = F.size(F.filter(row["phrases"], lambda p: F.array_contains(each, p)))
        return F.struct(row["categorie"].alias("categorie"), hits.alias("hits"))

    return T.let(found, lambda each: F.transform(constant, lambda row: score(row, each)))

"""Text normalisation, word lists, summaries and cuts, as column expressions."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's str.split() sees it; the class reads the same in
# java.util.regex and RE2.
_SPACES = r"\s\x0B\x1C-\x1F\x85\p{Z}"
SPACE = f"[{_SPACES}]"
#: The same characters; \\s and U+000B, U+001C to U+001F, U+0085, and the categories Z.
SPACE_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
NON_ASCII = r"[^\x00-\x7F]"
NON_WORD = r"[^\p{L}\p{N}_]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once per row, however often used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


@cache
def _base_letters() -> tuple[str, str]:
    """Characters that are one base character and marks, and those base characters."""
    marked, bare = [], []
    for ch in map(chr, range(0x80, sys.maxunicode + 1)):
        if not unicodedata.decomposition(ch):
            continue
        parts = unicodedata.normalize("NFD", ch)
        base = [p for p in parts if unicodedata.category(p) != "Mn"]
        if parts != ch and len(base) == 1:
            marked.append(ch)
            bare.append(base[0])
    return "".join(marked), "".join(bare)


def _jamo(text: Column) -> Column:
    """Hangul syllables taken apart by the arithmetic of the Unicode standard."""

    def letter(code: Column) -> Column:
        return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")

    def apart(ch: Column) -> Column:
        place = F.ascii(ch) - 0xAC00
        tail = F.when(place % 28 == 0, "").otherwise(letter(place % 28 + 0x11A7))
        lead = letter(F.floor(place / 588) + 0x1100)
        vowel = letter(F.floor(place % 588 / 28) + 0x1161)
        return F.when(ch.rlike("[\uac00-\ud7a3]"), F.concat(lead, vowel, tail)).otherwise(ch)

    return F.array_join(F.transform(F.split(text, ""), apart), "")


def without_marks(text: Column) -> Column:
    """Canonical decomposition with the combining marks left out."""

    def bare(plain: Column) -> Column:
        letters = F.regexp_replace(F.translate(plain, *_base_letters()), r"\p{Mn}+", "")
        return F.when(plain.rlike("[\uac00-\ud7a3]"), _jamo(letters)).otherwise(letters)

    return let(text, lambda t: F.when(t.rlike(NON_ASCII), bare(t)).otherwise(t))


def collapse_spaces(text: Column) -> Column:
    """Runs of white space become one blank; none at either end."""
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def strip(text: Column) -> Column:
    """White space off both ends, line breaks included."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def has_length(text: Column, least: int) -> Column:
    """Whether the stripped text has ``least`` characters; null stays null.

    True as soon as a character that far from the first one is found, so a long
    text is not read to its end.
    """
    if least <= 0:
        return F.when(text.isNotNull(), True)
    if least == 1:
        return text.rlike(f"[^{_SPACES}]")
    return text.rlike(rf"(?s)[^{_SPACES}].{{{least - 2}}}.*?[^{_SPACES}]")


def is_blank(text: Column) -> Column:
    """Null, empty, or nothing but white space."""
    return text.isNull() | text.rlike(rf"^{SPACE}*\z")


def normalize_text(text: Column) -> Column:
    """Lower case, no accents, words separated by single blanks; null gives ''."""
    return F.coalesce(
        F.trim(F.regexp_replace(without_marks(F.lower(text)), NON_WORD, " ")), F.lit("")
    )


def normalize_word(word: str) -> str:
    """The same rule for one dictionary entry, applied on the driver."""
    bare = unicodedata.normalize("NFD", word.lower())
    bare = "".join(ch for ch in bare if unicodedata.category(ch) != "Mn")
    return re.sub(r"\W+", " ", bare).strip()


def words(normalized: Column) -> Column:
    """Words of a normalised text; an empty text has none."""
    return F.filter(F.split(normalized, " "), lambda w: w != "")


def word_ngrams(word_list: Column, n: int) -> Column:
    """Every run of ``n`` neighbouring words, joined by blanks."""

    def grams(listed: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(listed) - (n - 1))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(listed, i, n), " "))
        return F.when(F.size(listed) >= n, joined).otherwise(F.array().cast("array<string>"))

    return let(word_list, grams)


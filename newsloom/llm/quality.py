"""Quality rules whose cutoffs are certified on labelled documents.

A rule rejects a document when its measure lies above a cutoff.  For each
stratum (language) and rule the candidate cutoffs, fixed beforehand, are tried
from the mildest to the strictest.  A cutoff is certified when the labelled good
documents of the stratum show that it rejects at most ``risk / rules`` of them:
the exact binomial probability of so few rejections under a larger rate must
not exceed ``alpha / (strata * rules)``.  The trial stops at the first cutoff
that fails, so the order of trials needs no correction of its own, and the sum
over strata and rules (Bonferroni) holds the chance of any wrong certificate to
``alpha``.  The rules together then reject at most ``risk`` of the good
documents of every stratum.  A stratum with too few labels certifies nothing and
keeps all that the base rules keep.

Cases: a null or empty text has no words and fails the base rules; a null
language is a stratum of its own; labels that name a document twice count it
once, as bad if any says so; without labels only the base rules decide; a measure
equal to its cutoff passes; repeated rows each have their row, and a text may be of any
length; an empty table gives an empty one; other columns pass through, whatever their
names.
"""

from __future__ import annotations

import math
import re
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.shared import cut, settle, unused, window_ids, word_ids

#: Good documents of a stratum that all rules together may reject, and the
#: chance that any certificate is wrong.
RISK = 0.02
ALPHA = 0.05

#: Candidate cutoffs, mildest first: a document is rejected above.
CUTOFFS = {
    "symbols": (1000, 700, 500, 350, 250, 180, 120, 80),  # [#*$%&|<>] per 1000 words
    "capitals": (950, 900, 800, 700, 600, 500, 400, 300),  # capitals per 1000 letters
    "repeats": (490, 450, 400, 350, 300, 250, 200, 150),  # repeated words per 1000
    "marks": (1000, 700, 500, 350, 250, 180, 120, 80),  # exclamation marks per 1000 words
}

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

SMALL = string.ascii_lowercase.encode()
LARGE = string.ascii_uppercase.encode()
OTHERS = re.compile("[\x00-\x7f]+")

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside a run of ``width`` words that the text holds twice or more."""
    if len(words) <= width:
        return 0
    _, which, counts = np.unique(window_ids(word_ids(words), width), return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[which] > 1)
    covered = np.zeros(len(words), bool)
    for k in range(width):
        covered[starts + k] = True
    return int(covered.sum())


def letter_counts(text: str) -> tuple[int, int]:
    """Letters and capitals; only the few characters beyond ASCII are looked at one by one."""
    raw = text.encode("ascii", "ignore")
    small, large = len(raw) - len(raw.translate(None, SMALL)), len(raw) - len(raw.translate(None, LARGE))
    others = OTHERS.sub("", text)
    return small + large + sum(map(str.isalpha, others)), large + sum(map(str.isupper, others))


def measures(text: str | None) -> tuple[int, ...]:
    """The base counts and the measures of the rules, in the order of the columns."""
    text = text or ""
    words = text.encode().split()
    n = len(words)
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    symbols = sum(map(text.count, SYMBOLS))
    repeats = repeated_words(words)
    letters, capitals = letter_counts(text)
    base = (n, len(text) - sum(map(text.count, SPACES)), symbols, len(lines) - len(set(lines)), repeats)
    rules = (
        1000 * symbols // max(n, 1),
        1000 * capitals // max(letters, 1),
        1000 * repeats // max(n, 1),
        1000 * text.count("!") // max(n, 1),
    )
    return base + rules


COLUMNS = (*BASE, *CUTOFFS)


def with_measures(docs: DataFrame, prefix: str = "") -> DataFrame:
    """All columns of ``docs`` and the measures of its text; no shuffle."""
    settle(docs.sparkSession)
    names = [prefix + c for c in COLUMNS]
    schema = T.StructType(docs.schema.fields + [T.StructField(c, T.LongType()) for c in names])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.array([measures(t) for t in batch.column(at).to_pylist()], np.int64).reshape(-1, len(names))
            made = [pa.array(table[:, k]) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[f.name for f in schema])

    return docs.mapInArrow(run, schema)


def base_failed(prefix: str = "") -> Column:
    n, repeats = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 50) | (100 * repeats > 50 * n)


def binomial_tail(k: int, n: int, rate: float) -> float:
    """P(at most k of n) when each has the chance ``rate``, exactly summed."""
    if k >= n:
        return 1.0
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(rate) + (n - i) * math.log1p(-rate)
        for i in range(k + 1)
    ]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def certified(cutoffs: tuple[int, ...], rejected: list[int], n: int, rate: float, level: float) -> int | None:
    """The strictest cutoff reached before the first that fails; None if the first does."""
    best = None
    for cutoff, k in zip(cutoffs, rejected, strict=True):
        if binomial_tail(int(k), int(n), rate) > level:
            break
        best = cutoff
    return best


def learned_cutoffs(
    measured: DataFrame, labels: DataFrame, risk: float = RISK, alpha: float = ALPHA
) -> DataFrame:
    """(stratum, one certified cutoff or null for each rule) as a small table.

    ``measured`` has doc_id, stratum and the measures.  Only documents that the
    base rules pass count: the others are gone whatever the cutoffs are.
    """
    good = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
        .where("quality = 1")
    )
    counted = [
        F.array(*[F.sum((F.col(rule) > c).cast("long")) for c in cuts]).alias(rule) for rule, cuts in CUTOFFS.items()
    ]
    seen = (
        measured.where(~base_failed()).join(good, "doc_id", "left_semi").groupBy("stratum").agg(F.count("*").alias("n"), *counted)
    )
    seen = cut(seen, "quality-counts")
    level = alpha / (max(seen.count(), 1) * len(CUTOFFS))
    rate = risk / len(CUTOFFS)

    def choice(rule: str) -> Column:
        cuts = CUTOFFS[rule]

        @F.pandas_udf("long")
        def choose(n: pd.Series, rejected: pd.Series) -> pd.Series:
            return pd.Series([certified(cuts, k, m, rate, level) for m, k in zip(n, rejected, strict=True)], dtype="Int64")

        return choose("n", rule)

    return cut(seen.select("stratum", *[choice(rule).alias(rule) for rule in CUTOFFS]), "quality-cutoffs")


def _stratum(docs: DataFrame) -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")


def judge(measured: DataFrame, cutoffs: DataFrame, stratum: Column, prefix: str = "") -> DataFrame:
    """``measured`` with the columns base_failed and kept, named by the prefix."""
    small = cutoffs.select(F.col("stratum").alias(f"{prefix}stratum"), *[F.col(r).alias(f"{prefix}{r}_cut") for r in CUTOFFS])
    above = F.lit(False)
    for rule in CUTOFFS:
        above = above | F.coalesce(F.col(prefix + rule) > F.col(f"{prefix}{rule}_cut"), F.lit(False))
    return (
        measured.withColumn(f"{prefix}stratum", stratum)
        .join(small, f"{prefix}stratum", "left")
        .withColumn(f"{prefix}base_failed", base_failed(prefix))
        .withColumn(f"{prefix}kept", ~F.col(f"{prefix}base_failed") & ~above)
        .drop(f"{prefix}stratum")
    )


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, the measures, the cutoffs used, base_failed, kept."""
    lang = _stratum(docs).alias("stratum")
    measured = cut(
        with_measures(docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang, F.col("text").cast("string").alias("text"))).drop("text"),
        "measures",
    )
    rows = measured.withColumnRenamed("stratum", "lang")
    return judge(rows, learned_cutoffs(measured, labels), F.col("lang"))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their columns; their texts are not shuffled."""
    prefix = unused(docs, "_quality_")
    measured = cut(
        with_measures(docs.select(F.col("doc_id").cast("long").alias("doc_id"), _stratum(docs).alias("stratum"), F.col("text").cast("string").alias("text"))).drop("text"),
        "measures",
    )
    cutoffs = learned_cutoffs(measured, labels)
    return judge(with_measures(docs, prefix), cutoffs, _stratum(docs), prefix).where(f"{prefix}kept").select(*docs.columns)


def base_kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that the base rules let pass, with their columns; nothing is learned or shuffled."""
    prefix = unused(docs, "_quality_")
    return with_measures(docs, prefix).where(~base_failed(prefix)).select(*docs.columns)

"""Repeated runs of lines: a suffix array over line names by prefix doubling.

Every line with a word gets a 128-bit name; blank lines are no part of the
sequence and stay.  The suffixes of all documents' line sequences are ranked by
prefix doubling: the class of the first ``2d`` lines is named by the pair of the
classes ``d`` lines long that follow each other.  Suffixes of one class at depth
``min_lines`` form a longest-common-prefix interval of that depth.  Its first
suffix, by (doc_id, line), is the original; the lines that every later suffix
covers belong to a maximal repeated run and are deleted.  Overlaps count, so a
run of any length goes whole.  A single line goes when it occurs earlier and has
``min_words`` words or more, or stands in ``min_docs`` documents or more: a short
line that few documents share may be anybody's, one that many share is boilerplate.

Only lines that occur twice take part in the doubling: a class of one is its own
interval.  Hot lines are counted in each task before they are shuffled, and the
joins back to the lines are ones that adaptive execution can split.

Cases: a null or empty text has no lines; a row without doc_id has no place in
the order, keeps its lines and is nobody's original; rows that share a doc_id
are told apart by their text, and exact repeats of a row lose the same lines; a text
may have any number of lines; an empty table gives an empty one; other columns pass
through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.staging import with_once
from newsloom.llm.shared import cut, settle

#: Lines of a run that is deleted whatever they hold; words of a single line that
#: is deleted by itself; documents that hold a shorter line that is, too.
MIN_LINES = 2
MIN_WORDS = 10
MIN_DOCS = 50

_WORD = r"[^\x20\x09-\x0D]+"
_NAME = ("h1", "h2")
_PLACE = ("doc_id", "text_id", "pos")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _with_keys(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text_id", F.xxhash64("text"))


def _name(*columns: str) -> list[Column]:
    """Two independent 64-bit hashes: a 128-bit name."""
    return [F.xxhash64(*columns).alias("h1"), F.xxhash64(F.lit(41), *columns).alias("h2")]


def _intervals(suffixes: DataFrame) -> DataFrame:
    """Suffixes whose class has two members or more, with the number and the first of them."""
    firsts = suffixes.groupBy(*_NAME).agg(F.count("*").alias("members"), F.min(F.struct(*_PLACE)).alias("first"))
    return suffixes.join(firsts.where("members > 1"), list(_NAME))


def repeated_lines(
    docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """(doc_id, text_id, at): the lines to delete, by index among all lines of the text."""
    if min_lines < 2:
        raise ValueError("a run has at least two lines; single lines are a matter of min_words")
    numbered = F.filter(
        F.transform(_lines(F.col("text")), lambda line, at: F.struct(at.alias("at"), line.alias("line"))),
        lambda x: x["line"].rlike(_WORD),
    )
    lines = _with_keys(docs.where("doc_id IS NOT NULL")).select(
        "doc_id", "text_id", F.posexplode(numbered).alias("pos", "x")
    )
    lines = lines.select(
        "doc_id", "text_id", "pos", F.col("x.at").alias("at"), F.regexp_count("x.line", F.lit(_WORD)).alias("words"), *_name("x.line")
    )
    # Only a line with as many copies can be in as many documents.
    ranked = _intervals(lines.distinct()).withColumn("often", F.col("members") >= min_docs).drop("members")
    rank = cut(ranked, "line-rank")

    later = F.struct(*_PLACE) > F.col("first")
    short = rank.where((F.col("words") < min_words) & F.col("often"))
    spread = short.groupBy(*_NAME).agg(F.countDistinct("doc_id").alias("docs")).where(F.col("docs") >= min_docs)
    by_spread = short.where(later).join(cut(spread.select(*_NAME), "line-spread"), list(_NAME), "left_semi")
    by_words = rank.where(later & (F.col("words") >= min_words))
    removed = by_words.select("doc_id", "text_id", "at").union(by_spread.select("doc_id", "text_id", "at"))
    depth, suffixes = 1, rank.select(*_PLACE, "at", *_NAME)
    while depth < min_lines:
        # A class is missing where its run has no second copy: the pair has none either.
        step = min(depth, min_lines - depth)
        ahead = suffixes.select(
            "doc_id", "text_id", (F.col("pos") - step).alias("pos"), F.col("h1").alias("n1"), F.col("h2").alias("n2")
        )
        deeper = suffixes.join(ahead, list(_PLACE)).select(*_PLACE, "at", *_name("h1", "h2", "n1", "n2"))
        ranked = _intervals(deeper)
        depth += step
        if depth < min_lines:
            suffixes = cut(ranked.drop("first", "members"), "line-rank")
    copies = ranked.where(later).select(*_PLACE)
    covered = copies.select("doc_id", "text_id", F.explode(F.sequence(F.col("pos"), F.col("pos") + (min_lines - 1))).alias("pos"))
    by_run = rank.select(*_PLACE, "at").join(covered.distinct(), list(_PLACE)).select("doc_id", "text_id", "at")
    return removed.union(by_run).distinct()


def maximal_runs(removed: DataFrame) -> DataFrame:
    """(doc_id, text_id, runs): for each text the deleted runs, as sorted (start, end) structs."""
    in_text = Window.partitionBy("doc_id", "text_id").orderBy("at")
    runs = (
        removed.withColumn("run", F.col("at") - F.row_number().over(in_text))
        .groupBy("doc_id", "text_id", "run")
        .agg(F.min("at").alias("start"), (F.max("at") + 1).alias("end"))
    )
    return runs.groupBy("doc_id", "text_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("runs"))


def _without(text: Column, runs: Column) -> Column:
    """The text without the lines of the runs: the slices between them, joined."""
    lines = _lines(text)
    bounds = F.concat(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))), runs)
    slices = F.transform(
        F.sequence(F.lit(0), F.size(runs)),
        lambda k: F.slice(
            lines,
            F.element_at(bounds, k + 1)["end"] + 1,
            F.when(k < F.size(runs), F.get(runs, k)["start"]).otherwise(F.size(lines)) - F.element_at(bounds, k + 1)["end"],
        ),
    )
    return F.array_join(F.flatten(slices), "\n")


def _joined(docs: DataFrame, min_lines: int, min_words: int, min_docs: int) -> tuple[DataFrame, Column, Column]:
    """The documents beside their runs; the text column without them; the runs or null."""
    settle(docs.sparkSession)
    doc_id, text = docs["doc_id"].cast("long"), docs["text"].cast("string")
    narrow = docs.select(doc_id.alias("doc_id"), text.alias("text"))
    runs = cut(maximal_runs(repeated_lines(narrow, min_lines, min_words, min_docs)), "line-runs")
    joined = docs.join(runs, (doc_id == runs["doc_id"]) & (F.xxhash64(text) == runs["text_id"]), "left")
    found = runs["runs"]
    return joined, F.when(found.isNull(), text).otherwise(_without(text, found)), found


def deduplicated(
    docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """(doc_id, text, n_lines, n_removed, n_runs) of each document.

    The text lacks the deleted runs; one that loses nothing stays as it is, null
    included.  n_lines counts the lines with a word before the deletion.
    """
    joined, kept, found = _joined(docs, min_lines, min_words, min_docs)
    lines = F.size(F.filter(_lines(docs["text"].cast("string")), lambda x: x.rlike(_WORD)))
    lost = F.aggregate(found, F.lit(0), lambda n, r: n + r["end"] - r["start"])
    return joined.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        kept.alias("text"),
        F.greatest(lines, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(lost, F.lit(0)).cast("long").alias("n_removed"),
        F.greatest(F.size(found), F.lit(0)).cast("long").alias("n_runs"),
    )


def kept_documents(
    docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, min_docs: int = MIN_DOCS, words_left: int = 0
) -> DataFrame:
    """The documents with their columns; texts have lost their repeated runs.

    Documents whose text has fewer than ``words_left`` words then go.
    """
    joined, kept, _ = _joined(docs, min_lines, min_words, min_docs)
    left = joined.select(*[kept.alias(c) if c == "text" else docs[c] for c in docs.columns])
    if not words_left:
        return left
    once = with_once(left, {"text": F.col("text")})
    return once.where(F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)) >= words_left)

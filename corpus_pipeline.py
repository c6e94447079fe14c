"""From raw documents to a training mix: five stages over one table.

Each stage is a function of (spark, docs, sf_dir) that gives the documents it
keeps; ``run`` writes what a stage gives and reads it as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsloom.llm import decontaminate, line_dedup, mixing, near_dup, quality
from newsloom.llm.shared import cut, settle


#: What the base rules ask of a text.
WORDS_LEFT = 50


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return settle(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a certified cutoff reject go."""
    return quality.kept_documents(docs, _table(spark, sf_dir, "labels"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted, and texts of which too few words are left."""
    return line_dedup.kept_documents(docs, words_left=WORDS_LEFT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one of the smallest id.

    Texts are compared as they came first: of a copy without its repeated lines nothing
    may be left that still looks like the original.  What is left without its lines is
    held to the base rules of the first stage once more, and then compared as it is now:
    documents that only repeated lines told apart are copies as well.
    """
    as_came = near_dup.kept_documents(docs, _table(spark, sf_dir, "documents"))
    return near_dup.kept_documents(cut(quality.base_kept_documents(as_came), "base-kept"))


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by chances calibrated to the target weights."""
    return mixing.sampled_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark_items),
    ("target_mix", target_mix),
]

#: Two stages have no SQL: certified cutoffs and raking.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the whole documents table."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

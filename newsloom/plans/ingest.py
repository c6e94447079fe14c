"""Ingest: producers united, first occurrences, unknown ids, enrichment, append."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame

from newsloom.operators import keys as K
from newsloom.operators.quality import quality_gate, with_id
from newsloom.plans.enrich import enrich_articles
from newsloom.sources.tables import write_table


def union_sources(*producers: DataFrame) -> DataFrame:
    """One table of all producers' columns; what a producer lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), producers)


def new_articles(
    batch: DataFrame, known: DataFrame, *order: str | Column, keep_repeats: bool = False
) -> DataFrame:
    """Rows of a batch worth enriching: with an id, valid, unknown, first of their id.

    The gate sees raw text and costs no shuffle, so it comes before the keys
    meet.  Repeats go first: they are reduced to one row per key and task before
    the shuffle, and the join with the known ids reuses that shuffle.
    ``keep_repeats`` keeps them all; ``order`` says which one is the first.
    """
    valid = quality_gate(with_id(batch))
    if not keep_repeats:
        order = order or [c for c in ("url", "titre", "contenu") if c in batch.columns]
        valid = K.keep_first(valid, "id_article", *order)
    return K.new_only(valid, known)


def ingest(
    batch: DataFrame, known: DataFrame, path: str, *order: str | Column, by: str | None = None, **enrichment
) -> None:
    """Enrich the new articles of a batch and append them to the table at ``path``."""
    write_table(enrich_articles(new_articles(batch, known, *order), **enrichment), path, "append", by)

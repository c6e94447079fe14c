"""Article schemas: the operational table and the published one."""

from __future__ import annotations

from pyspark.sql import types as t

TEXT = t.StringType()

# Dates and scores land as text, the way the producers wrote them; the repair
# and publish operators give them their types.
ARTICLE_SCHEMA = t.StructType(
    [
        t.StructField("id_article", TEXT),
        t.StructField("source", TEXT),
        t.StructField("source_type", TEXT),
        t.StructField("titre", TEXT),
        t.StructField("contenu", TEXT),
        t.StructField("url", TEXT),
        t.StructField("date_publication", TEXT),
        t.StructField("created_at", TEXT),
        t.StructField("langue", TEXT),
        t.StructField("sentiment", TEXT),
        t.StructField("sentiment_score", TEXT),
        t.StructField("categorie", t.ArrayType(TEXT)),
        t.StructField("origin", TEXT),
    ]
)

PUBLISHED_SCHEMA = t.StructType(
    [
        t.StructField("id_article", TEXT),
        t.StructField("titre", TEXT),
        t.StructField("url", TEXT),
        t.StructField("contenu", TEXT),
        t.StructField("source", TEXT),
        t.StructField("source_type", TEXT),
        t.StructField("categorie", t.ArrayType(TEXT, False)),
        t.StructField("langue", TEXT),
        t.StructField("sentiment", TEXT),
        t.StructField("sentiment_score", t.DoubleType()),
        t.StructField("origin", TEXT),
        t.StructField("created_at", t.TimestampType()),
        t.StructField("date_publication", t.TimestampType()),
        t.StructField("sync_timestamp", t.TimestampType()),
    ]
)

"""Trained models as tables below the shared folder: trained once, loaded after."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators import language as G
from newsloom.session import shared_dir
from newsloom.sources import files as H


def files_key(*tables: DataFrame) -> str:
    """A name for the files behind scans: their paths, sizes and times of change."""
    parts = []
    for table in tables:
        files = table.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
        row = files.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*files.columns).cast("decimal(38,0)")).alias("sum")).first()
        parts.append(f"{row['n']}-{row['sum']}")
    return "_".join(parts)


def stored(spark: SparkSession, name: str, key: str, train: Callable[[], DataFrame]) -> DataFrame:
    """The table of a model of this name and key; trained and written if it is not there.

    A small file names the table's folder.  It appears once the table is whole, so a
    training that failed is done again; of two sessions that train at the same time
    the first one's table is read by both.
    """
    folder = f"{shared_dir(spark)}/newsloom/trained"
    name = f"{name}-{key}"
    if name not in H.names_in(spark, folder):
        table = f"{name}-{uuid.uuid4().hex}"
        train().write.parquet(f"{folder}/tables/{table}")
        try:
            H.publish_text(spark, f"{folder}/{name}", table)
        except H.NameTakenError:
            pass
    return spark.read.parquet(f"{folder}/tables/{H.read_text(spark, f'{folder}/{name}')}")


def language_model(spark: SparkSession, labelled: DataFrame, text: str, label: str) -> G.Weights | DataFrame:
    """Trigram weights of the languages in a scanned table."""
    table = stored(
        spark, f"language-{text}-{label}", files_key(labelled), lambda: G.train_language_profiles(labelled, text, label)
    )
    return G.language_weights(table)


def sentiment_model(
    spark: SparkSession, texts: DataFrame, labels: DataFrame, key: str, text: str, label: str
) -> G.Weights | DataFrame:
    """Trigram weights of the classes that ``labels`` give to the texts of a scanned table."""

    def train() -> DataFrame:
        classes = labels.where(F.col(label).isNotNull()).select(key, F.col(label).cast("string").alias(label))
        return G.train_language_profiles(texts.select(key, text).join(classes, key), text, label)

    table = stored(spark, f"sentiment-{text}-{label}", files_key(texts, labels), train)
    return G.language_weights(table)

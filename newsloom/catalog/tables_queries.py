"""Sources, sinks and table maintenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as t

from newsloom.catalog.registry import ORACLES, Tables, query
from newsloom.functions import dates as D
from newsloom.operators import keys as K
from newsloom.operators import quality as Q
from newsloom.operators import repair as R
from newsloom.plans import publish as P
from newsloom.schemas import PUBLISHED_SCHEMA
from newsloom.session import scratch_path
from newsloom.sources import tables as S
from newsloom.sources.versions import VersionedTable

DOCUMENT_SCHEMA = t.StructType(
    [
        t.StructField("doc_id", t.LongType()),
        t.StructField("text", t.StringType()),
        t.StructField("lang", t.StringType()),
        t.StructField("source", t.StringType()),
        t.StructField("n_chars", t.LongType()),
    ]
)
RUN_TIME = "2026-01-01 00:00:00"


def run_time():
    return F.lit(RUN_TIME).cast("timestamp")


def moment_text(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_articles(tables: Tables) -> DataFrame:
    return S.scan_articles(tables.spark, f"{tables.folder}/documents.parquet", DOCUMENT_SCHEMA)


@query("SELECT page_id, url FROM pages")
def scan_projected(tables: Tables) -> DataFrame:
    schema = t.StructType(
        [
            t.StructField("page_id", t.LongType()),
            t.StructField("url", t.StringType()),
            t.StructField("html", t.StringType()),
        ]
    )
    return S.scan_articles(
        tables.spark, f"{tables.folder}/pages.parquet", schema, columns=["page_id", "url"]
    )


@query(
    "SELECT doc_id, source_type FROM @raw_articles WHERE source_type IS NULL OR source_type = ''"
)
def filter_missing(tables: Tables) -> DataFrame:
    return Q.with_missing(tables.view("raw_articles"), "source_type").select("doc_id", "source_type")


@query(
    """
    SELECT doc_id, id_article FROM @existing
    UNION ALL
    SELECT doc_id, id_article FROM @articles a
    WHERE NOT EXISTS (SELECT 1 FROM @existing e WHERE e.id_article = a.id_article)
    """
)
def append_new(tables: Tables) -> DataFrame:
    path = scratch_path(tables.spark, "append")
    columns = ["doc_id", "id_article", "titre", "contenu"]
    S.write_table(tables.view("existing").select(*columns), path)
    # The known ids are read from the table that is about to grow.
    known = S.scan_articles(tables.spark, path, t.StructType().add("id_article", "string"))
    S.append_new(tables.view("articles").select(*columns), known, path)
    return tables.spark.read.parquet(path).select("doc_id", "id_article")


@query(
    """
    SELECT d.doc_id, d.text, d.lang, CASE WHEN l.doc_id IS NULL THEN d.source
      WHEN l.quality = 1 THEN 'good' ELSE NULL END AS source
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """
)
def keyed_update(tables: Tables) -> DataFrame:
    # Two updates of some keys; the second is the one that counts.
    labels = tables.table("labels")
    first = labels.where("doc_id % 3 = 0").select("doc_id", F.lit("first").alias("source"), F.lit(1).alias("step"))
    last = labels.select("doc_id", F.when(F.col("quality") == 1, "good").alias("source"), F.lit(2).alias("step"))
    changes = first.union(last)
    documents = tables.table("documents").select("doc_id", "text", "lang", "source")
    return K.keyed_update(documents, changes, "doc_id", ["source"], "step")


def _versioned_documents(tables: Tables) -> VersionedTable:
    """The documents as the first version of a table with keys."""
    table = VersionedTable(tables.spark, scratch_path(tables.spark, "versioned"), key="doc_id")
    table.replace(tables.table("documents").select("doc_id", "text", "lang", "source"))
    return table


@query(ORACLES["keyed_update"])
def versioned_update(tables: Tables) -> DataFrame:
    """The same updates, on a table whose untouched files stay."""
    table = _versioned_documents(tables)
    labels = tables.table("labels")
    first = labels.where("doc_id % 3 = 0").select("doc_id", F.lit("first").alias("source"), F.lit(1).alias("step"))
    last = labels.select("doc_id", F.when(F.col("quality") == 1, "good").alias("source"), F.lit(2).alias("step"))
    table.update(first.union(last), ["source"], "step")
    return table.read()


@query(
    """
    SELECT 1 AS version, lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang
    UNION ALL
    SELECT 2, lang, count(*), sum(n_chars)::BIGINT FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY lang
    UNION ALL
    SELECT 3, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'seen' ELSE lang END AS lang, count(*), sum(n_chars)::BIGINT FROM documents GROUP BY 2
    """
)
def versioned_history(tables: Tables) -> DataFrame:
    """All versions of a table after a load, a deletion by ids, and the deleted rows' return."""
    documents, labels = tables.table("documents").select("doc_id", "lang", "n_chars"), tables.table("labels").select("doc_id")
    table = VersionedTable(tables.spark, scratch_path(tables.spark, "versioned"), key="doc_id")
    table.replace(documents)
    table.delete(labels)
    table.append(K.known_only(documents, labels, "doc_id").withColumn("lang", F.lit("seen")).select(*documents.columns))
    counts = [
        table.read(version).groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars")).withColumn("version", F.lit(version))
        for version in table.versions()
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    r"""
    SELECT doc_id, titre, source FROM @raw_articles
    WHERE NOT coalesce(titre IS NULL OR regexp_full_match(titre, '\s*'), false)
      AND NOT coalesce(source = 'Malagasy News', false)
    """
)
def delete_where(tables: Tables) -> DataFrame:
    raw = tables.view("raw_articles").select("doc_id", "titre", "source")
    blank = F.col("titre").isNull() | F.col("titre").rlike(r"^\s*$")
    return K.delete_where(K.delete_where(raw, blank), F.col("source") == "Malagasy News")


@query("SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def delete_ids(tables: Tables) -> DataFrame:
    return K.delete_keys(tables.table("documents"), tables.table("labels"), "doc_id").select(
        "doc_id", "text", "lang", "source", "n_chars"
    )


_PUBLISHED = """
    SELECT coalesce(id_article, '') AS id_article, coalesce(titre, '') AS titre,
      coalesce(url, '') AS url, coalesce(contenu, '') AS contenu, coalesce(source, '') AS source,
      coalesce(source_type, '') AS source_type,
      coalesce(array_to_string(categorie, '|'), '') AS categorie,
      coalesce(langue, '') AS langue, coalesce(sentiment, '') AS sentiment,
      CASE doc_id % 11 WHEN 3 THEN 0.25 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL
        WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE round(doc_id / 64.0, 6) END AS sentiment_score,
      coalesce(origin, '') AS origin,
      CASE WHEN doc_id % 3 = 2 THEN strftime(make_timestamp(2025, 10 + CAST(floor((doc_id % 60) / 30) AS INT),
        CAST(1 + doc_id % 30 AS INT), CAST(doc_id % 24 AS INT), CAST(doc_id % 60 AS INT), 0),
        '%Y-%m-%d %H:%M:%S') END AS created_at,
      strftime(iso_meaning, '%Y-%m-%d %H:%M:%S') AS date_publication,
      '2026-01-01 00:00:00' AS sync_timestamp
    FROM @raw_articles
"""


def _readable(stored: DataFrame) -> DataFrame:
    return stored.select(*PUBLISHED_SCHEMA.fieldNames()).withColumns(
        {
            "categorie": F.array_join("categorie", "|"),
            "sentiment_score": F.round("sentiment_score", 6),
            **{c: moment_text(c) for c in ("created_at", "date_publication", "sync_timestamp")},
        }
    )


@query(_PUBLISHED)
def publish_clean(tables: Tables) -> DataFrame:
    path = scratch_path(tables.spark, "published")
    # The first version is there until the second one is whole.
    P.publish(tables.view("raw_articles").limit(1), run_time(), path)
    P.publish(tables.view("raw_articles"), run_time(), path)
    return _readable(P.read_published(tables.spark, path))


@query(_PUBLISHED)
def publish_json(tables: Tables) -> DataFrame:
    path = scratch_path(tables.spark, "published")
    folder = P.publish_json(tables.view("raw_articles"), run_time(), path)
    return _readable(tables.spark.read.schema(PUBLISHED_SCHEMA).json(folder))


@query(_PUBLISHED)
def publish_table(tables: Tables) -> DataFrame:
    path = scratch_path(tables.spark, "published")
    name = "published_" + path.rsplit("-", 1)[1]
    raw = tables.view("raw_articles")
    # A first load makes the table, the second one replaces its rows.
    P.publish_table(raw.limit(1), run_time(), name, path)
    P.publish_table(raw, run_time(), name, path)
    return _readable(tables.spark.table(name))


@query(
    """
    SELECT doc_id, row_number() OVER (ORDER BY created DESC NULLS LAST, doc_id) - 1 AS position FROM (
      SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN make_timestamp(2025, 10 + CAST(floor((doc_id % 60) / 30) AS INT),
        CAST(1 + doc_id % 30 AS INT), CAST(doc_id % 24 AS INT), CAST(doc_id % 60 AS INT), 0) END AS created FROM documents)
    """
)
def newest_first(tables: Tables) -> DataFrame:
    raw = tables.view("raw_articles").select("doc_id", D.iso_timestamp(F.col("created_at")).alias("created_at"))
    keyed = raw.withColumn("id_article", F.lpad(F.col("doc_id").cast("string"), 20, "0"))
    return Q.numbered(keyed, *P.newest_order()).select("doc_id", "position")


@query("SELECT conv_id, turn, role, text FROM conversations")
def export_json(tables: Tables) -> DataFrame:
    path = scratch_path(tables.spark, "export")
    messages = tables.table("conversations").select("conv_id", "turn", "role", "text")
    S.export_json(messages, path)
    return tables.spark.read.schema(messages.schema).json(path)


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def bad_record_budget(tables: Tables) -> DataFrame:
    path = scratch_path(tables.spark, "lines")
    lines = tables.table("documents").select(
        F.to_json(F.struct("doc_id", "text", "lang", "source", "n_chars")).alias("value")
    )
    # As many broken lines as the budget allows.
    broken = tables.spark.range(10).select(
        F.concat(F.lit('{"doc_id": '), F.col("id").cast("string"), F.lit(', "text": "cut')).alias("value")
    )
    lines.union(broken).write.text(path)
    return S.load_json_lines(tables.spark, path, DOCUMENT_SCHEMA)


_MASKED = """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id,
      CASE WHEN titre IS NULL OR trim(titre) = '' THEN 'VIDE' ELSE titre END AS titre,
      CASE WHEN contenu IS NULL OR trim(contenu) = '' THEN 'VIDE' ELSE contenu END AS contenu,
      coalesce(url, 'VIDE') AS url, coalesce(nullif(source_type, ''), 'VIDE') AS source_type,
      CASE WHEN categorie IS NULL OR len(categorie) = 0 THEN 'VIDE'
        ELSE array_to_string(categorie, ', ') END AS categorie
    FROM @raw_articles
"""
_MASKED_COLUMNS = ["doc_id", "titre", "contenu", "url", "source_type", "categorie"]


@query(_MASKED)
def mask_blanks(tables: Tables) -> DataFrame:
    return R.mask_blanks(tables.view("raw_articles").select(*_MASKED_COLUMNS))


@query(_MASKED)
def export_verification(tables: Tables) -> DataFrame:
    path = scratch_path(tables.spark, "export")
    S.export_csv(R.mask_blanks(tables.view("raw_articles").select(*_MASKED_COLUMNS)), path)
    schema = t.StructType([t.StructField(c, t.StringType()) for c in _MASKED_COLUMNS])
    return (
        tables.spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )

"""Quality, repair and key operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsloom import fixed_values as fixed
from newsloom.catalog.registry import Tables, query
from newsloom.functions import numbers as N
from newsloom.operators import keys as K
from newsloom.operators import quality as Q
from newsloom.operators import repair as R

_STRIPPED = r"regexp_replace({c}, '^[\s\x0B\x1C-\x1F\x85\p{{Z}}]+|[\s\x0B\x1C-\x1F\x85\p{{Z}}]+$', '', 'g')"


def stripped(column: str) -> str:
    return _STRIPPED.format(c=column)


VALID = (
    f"coalesce(length({stripped('titre')}) >= 5, false)"
    f" AND coalesce(length({stripped('contenu')}) >= 30, false)"
)
_RAW_COLUMNS = ["id_article", "titre", "contenu", "url", "source", "source_type", "langue", "sentiment"]


@query(f"SELECT doc_id, titre, contenu FROM @raw_articles WHERE {VALID}")
def quality_gate(tables: Tables) -> DataFrame:
    return Q.quality_gate(tables.view("raw_articles").select("doc_id", "titre", "contenu"))


@query("SELECT doc_id FROM @raw_articles WHERE source_type IS NULL OR contenu IS NULL")
def invalid_rows(tables: Tables) -> DataFrame:
    return Q.invalid_rows(tables.view("raw_articles"), ["source_type", "contenu"]).select("doc_id")


@query("SELECT doc_id FROM @raw_articles WHERE titre IS NOT NULL AND contenu IS NOT NULL")
def dropna_subset(tables: Tables) -> DataFrame:
    return Q.drop_null_rows(tables.view("raw_articles"), ["titre", "contenu"]).select("doc_id")


@query(
    "SELECT doc_id FROM @raw_articles WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _RAW_COLUMNS)
)
def dropna_any(tables: Tables) -> DataFrame:
    raw = tables.view("raw_articles").select("doc_id", *_RAW_COLUMNS)
    return Q.drop_null_rows(raw).select("doc_id")


@query(
    """
    SELECT doc_id, 'short' AS half FROM @raw_articles WHERE length(contenu) < 30
    UNION ALL SELECT doc_id, 'long' AS half FROM @raw_articles WHERE length(contenu) >= 30
    """
)
def short_content(tables: Tables) -> DataFrame:
    raw = tables.view("raw_articles").select("doc_id", "contenu")
    short = Q.short_content(raw).select("doc_id", F.lit("short").alias("half"))
    return short.union(Q.long_content(raw).select("doc_id", F.lit("long").alias("half")))


@query(
    """
    SELECT event_id, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'
    """
)
def date_range_filter(tables: Tables) -> DataFrame:
    kept = Q.date_range_filter(
        tables.table("events"), "ts", "2024-01-05 00:00:00", "2024-01-20 12:00:00"
    )
    return kept.select("event_id", "event_type")


@query(
    """
    SELECT doc_id FROM @raw_articles
    WHERE coalesce(trim(titre), '') IN ('', 'VIDE') OR coalesce(trim(contenu), '') IN ('', 'VIDE')
      OR url IS NULL OR coalesce(source_type, '') = '' OR categorie IS NULL OR len(categorie) = 0
    """
)
def rows_with_sentinel(tables: Tables) -> DataFrame:
    raw = tables.view("raw_articles").select(
        "doc_id", "titre", "contenu", "url", "source_type", "categorie"
    )
    masked = R.mask_blanks(raw).withColumn("doc_id", F.col("doc_id").cast("long"))
    return Q.rows_with_value(masked).select("doc_id")


@query("SELECT source, url FROM @raw_articles WHERE contenu IS NULL")
def null_content_sources(tables: Tables) -> DataFrame:
    return Q.null_content_sources(tables.view("raw_articles"))


def _each(template: str) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in _RAW_COLUMNS)


@query(
    _each("SELECT '{c}' AS column_name, 'string' AS data_type, count({c}) AS present FROM @raw_articles")
)
def column_profile(tables: Tables) -> DataFrame:
    return Q.column_profile(tables.view("raw_articles").select(*_RAW_COLUMNS))


@query(_each("SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM @raw_articles"))
def null_counts(tables: Tables) -> DataFrame:
    return Q.null_counts(tables.view("raw_articles").select(*_RAW_COLUMNS))


@query(
    _each(
        "SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '') AS blanks"
        " FROM @raw_articles"
    )
)
def blank_counts(tables: Tables) -> DataFrame:
    return Q.blank_counts(tables.view("raw_articles").select(*_RAW_COLUMNS))


def dynamic_articles(tables: Tables) -> DataFrame:
    """Articles as dynamic documents: a wrapped date is an object in them."""
    dates = F.col("date_publication")
    plain = F.to_json(F.struct("doc_id", "date_publication"))
    wrapped = F.concat(
        F.lit('{"doc_id": '), F.col("doc_id").cast("string"), F.lit(', "date_publication": '), dates, F.lit("}")
    )
    return tables.view("raw_articles").select("doc_id", F.when(dates.startswith("{"), wrapped).otherwise(plain).alias("body"))


@query("SELECT doc_id FROM documents WHERE doc_id % 12 = 8 OR doc_id % 12 = 11")
def rows_of_type(tables: Tables) -> DataFrame:
    return Q.rows_of_type(dynamic_articles(tables), "body", "date_publication", "OBJECT", "MISSING").select("doc_id")


@query(
    """
    SELECT 'props' AS field, 'OBJECT' AS json_type, count(*) AS n FROM events
    UNION ALL
    SELECT 'date_publication', CASE doc_id % 12 WHEN 8 THEN 'OBJECT' WHEN 11 THEN 'MISSING' ELSE 'STRING' END,
      count(*) FROM documents GROUP BY 1, 2
    UNION ALL
    SELECT 'doc_id', 'BIGINT', count(*) FROM documents
    """
)
def type_census(tables: Tables) -> DataFrame:
    documents = dynamic_articles(tables)
    events = tables.table("events").select(
        F.concat(F.lit('{"props": '), "props", F.lit("}")).alias("body")
    )

    def census(df: DataFrame, field: str) -> DataFrame:
        return Q.type_census(df, "body", field).select(F.lit(field).alias("field"), "json_type", "n")

    return (
        census(events, "props").union(census(documents, "date_publication")).union(census(documents, "doc_id"))
    )


@query(
    """
    SELECT CAST(count(*) AS BIGINT) AS n, round(avg(length(text)), 6) AS mean,
      round(stddev_samp(length(text)), 6) AS std, min(length(text)) AS min,
      quantile_cont(length(text), 0.25) AS q25, quantile_cont(length(text), 0.5) AS q50,
      quantile_cont(length(text), 0.75) AS q75, max(length(text)) AS max
    FROM documents
    """
)
def length_summary(tables: Tables) -> DataFrame:
    summary = Q.length_summary(tables.table("documents"), "text")
    return summary.withColumns(
        {
            "mean": F.round("mean", 6),
            "std": F.round("std", 6),
            "min": F.col("min").cast("long"),
            "max": F.col("max").cast("long"),
        }
    )


@query("SELECT count(*) AS n FROM documents")
def count_all(tables: Tables) -> DataFrame:
    return Q.count_all(tables.table("documents"))


@query("SELECT DISTINCT id_article FROM @raw_articles WHERE id_article IS NOT NULL")
def distinct_ids(tables: Tables) -> DataFrame:
    return Q.distinct_values(tables.view("raw_articles"))


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10")
def top_n(tables: Tables) -> DataFrame:
    return Q.top_n(tables.table("documents").select("doc_id", "n_chars"), 10, F.desc("n_chars"), "doc_id")


@query("SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 50 OFFSET 100")
def page_rows(tables: Tables) -> DataFrame:
    return Q.page_rows(tables.table("documents").select("doc_id", "text"), 100, 50, "doc_id")


# --- keys -----------------------------------------------------------------------


@query(
    """
    SELECT doc_id, id_article FROM @articles
    WHERE id_article NOT IN (SELECT id_article FROM @existing)
    """
)
def anti_join_existing(tables: Tables) -> DataFrame:
    return K.new_only(tables.view("articles"), tables.view("existing")).select("doc_id", "id_article")


@query(
    "SELECT doc_id, id_article FROM @articles WHERE id_article IN (SELECT id_article FROM @existing)"
)
def semi_join_existing(tables: Tables) -> DataFrame:
    return K.known_only(tables.view("articles"), tables.view("existing")).select("doc_id", "id_article")


@query(
    """
    SELECT doc_id, id_article FROM (
      SELECT doc_id, id_article, row_number() OVER (PARTITION BY id_article ORDER BY doc_id) AS place
      FROM @articles) WHERE place = 1
    """
)
def dedup_keep_first(tables: Tables) -> DataFrame:
    return K.keep_first(tables.view("articles").select("doc_id", "id_article"), "id_article", "doc_id")


@query(
    """
    SELECT conv_id, turn, text FROM (
      SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS place
      FROM conversations) WHERE place <= 15
    """
)
def recent_messages(tables: Tables) -> DataFrame:
    messages = tables.table("conversations").select("conv_id", "turn", "text")
    return K.most_recent(messages, "conv_id", fixed.RECENT_MESSAGES, F.desc("turn"))


@query(
    f"""
    SELECT status, count(*) AS n FROM (
      SELECT CASE WHEN coalesce(id_article, '') = '' THEN 'skipped'
        WHEN id_article IN (SELECT id_article FROM @existing) THEN 'existing'
        WHEN {VALID} THEN 'added' ELSE 'skipped' END AS status
      FROM @raw_articles) GROUP BY status
    """
)
def run_counters(tables: Tables) -> DataFrame:
    return K.run_counters(tables.view("raw_articles"), tables.view("existing"))


# --- repairs ----------------------------------------------------------------------

_UNMASK = "CASE WHEN {c} = 'VIDE' OR {c} IS NULL OR trim({c}) = '' THEN NULL ELSE {c} END AS {c}"


@query(
    f"SELECT doc_id, {_UNMASK.format(c='titre')}, {_UNMASK.format(c='contenu')} FROM @raw_articles"
)
def unmask_blanks(tables: Tables) -> DataFrame:
    return R.unmask_blanks(tables.view("raw_articles").select("doc_id", "titre", "contenu"))


@query(
    """
    SELECT doc_id, CASE WHEN coalesce(created_at, '') = '' AND coalesce(date_publication, '') <> ''
      THEN date_publication ELSE created_at END AS created_at FROM @raw_articles
    """
)
def fill_created_at(tables: Tables) -> DataFrame:
    return R.fill_created_at(tables.view("raw_articles")).select("doc_id", "created_at")


@query(
    """
    SELECT doc_id, CASE WHEN coalesce(source_type, '') = '' THEN 'rss' ELSE source_type END AS source_type
    FROM @raw_articles
    """
)
def fill_source_type(tables: Tables) -> DataFrame:
    return R.fill_source_type(tables.view("raw_articles")).select("doc_id", "source_type")


_FITS_FEED = " OR ".join(f"starts_with(s, '{a}')" for a in fixed.FEED_ADDRESSES)


@query(
    f"""
    SELECT doc_id, CASE WHEN coalesce(source_type, '') <> '' THEN source_type
      WHEN {_FITS_FEED} THEN 'rss' WHEN starts_with(s, 'Malagasy News') THEN 'scrap_html'
      WHEN contains(s, 'Orange Actu') THEN 'scrap_selenium' ELSE 'inconnu' END AS source_type
    FROM (SELECT doc_id, source_type, trim(coalesce(source, '')) AS s FROM @raw_articles)
    """
)
def source_type_rules(tables: Tables) -> DataFrame:
    return R.assign_source_type(tables.view("raw_articles")).select("doc_id", "source_type")


@query(
    """
    SELECT doc_id, date_publication,
      strftime(date_meaning, '%Y-%m-%d %H:%M:%S') AS parsed_date,
      CASE WHEN date_meaning IS NULL THEN 0 ELSE 1 END AS date_ok
    FROM @raw_articles
    """
)
def repair_dates(tables: Tables) -> DataFrame:
    repaired = R.repair_dates(tables.view("raw_articles").select("doc_id", "date_publication"))
    return repaired.withColumns(
        {
            "parsed_date": F.date_format("parsed_date", "yyyy-MM-dd HH:mm:ss"),
            "date_ok": F.col("date_ok").cast("int"),
        }
    )


@query(
    """
    SELECT doc_id, strftime(coalesce(date_meaning, TIMESTAMP '2026-01-01 00:00:00'), '%Y-%m-%d %H:%M:%S')
      AS date_publication FROM @raw_articles
    """
)
def parse_mixed_dates(tables: Tables) -> DataFrame:
    from newsloom.functions.dates import parse_date_or

    default = F.lit("2026-01-01 00:00:00").cast("timestamp")
    parsed = parse_date_or(F.col("date_publication"), default)
    return tables.view("raw_articles").select(
        "doc_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("date_publication")
    )


@query(
    """
    SELECT doc_id, strftime(iso_meaning, '%Y-%m-%d %H:%M:%S') AS date_publication FROM @raw_articles
    """
)
def coerce_timestamp(tables: Tables) -> DataFrame:
    coerced = R.coerce_timestamp(
        tables.view("raw_articles").select("doc_id", "date_publication"), "date_publication"
    )
    return coerced.withColumn(
        "date_publication", F.date_format("date_publication", "yyyy-MM-dd HH:mm:ss")
    )


@query(
    """
    SELECT doc_id, CASE WHEN doc_id % 11 = 3 THEN 0.25 WHEN doc_id % 11 < 7 THEN NULL
      ELSE round(doc_id / 64.0, 6) END AS sentiment_score
    FROM documents
    """
)
def safe_float(tables: Tables) -> DataFrame:
    return tables.view("raw_articles").select(
        "doc_id", F.round(N.safe_float(F.col("sentiment_score")), 6).alias("sentiment_score")
    )


@query(
    """
    SELECT doc_id, unnest(CASE WHEN categorie IS NULL OR len(categorie) = 0 THEN [NULL] ELSE categorie END)
      AS categorie FROM @raw_articles
    """
)
def explode_categories(tables: Tables) -> DataFrame:
    return R.explode_categories(tables.view("raw_articles").select("doc_id", "categorie"))

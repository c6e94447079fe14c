"""Views derived from the input tables, written once for both engines.

A name behind an at sign stands for an input table or another view.  The texts
keep to what Spark SQL and ANSI databases share; the few differences have names
of their own (``@EMPTY_LIST``, ``@TEXT``).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame

if TYPE_CHECKING:
    from newsloom.catalog.registry import Tables

SPARK_WORDS = {"EMPTY_LIST": "CAST(array() AS ARRAY<STRING>)", "TEXT": "STRING"}
ORACLE_WORDS = {"EMPTY_LIST": "CAST([] AS VARCHAR[])", "TEXT": "VARCHAR"}

# A day within sixty, spread by id.
_MOMENT = (
    "make_timestamp(2025, CAST(10 + floor((doc_id % 60) / 30) AS INT),"
    " CAST(1 + doc_id % 30 AS INT), CAST(doc_id % 24 AS INT), CAST(doc_id % 60 AS INT), 0)"
)


def _part(unit: str) -> str:
    values = {
        "month": "10 + CAST(floor((doc_id % 60) / 30) AS INT)",
        "day": "1 + doc_id % 30",
        "hour": "doc_id % 24",
        "minute": "doc_id % 60",
    }
    return f"lpad(CAST({values[unit]} AS @TEXT), 2, '0')"


_ISO = (
    f"concat('2025-', {_part('month')}, '-', {_part('day')},"
    f" 'T', {_part('hour')}, ':', {_part('minute')}, ':00')"
)
_MONTH_NAME = "CASE WHEN doc_id % 60 < 30 THEN 'Oct' ELSE 'Nov' END"
_FRENCH_MONTH = "CASE WHEN doc_id % 60 < 30 THEN 'octobre' ELSE 'novembre' END"

# How a producer may have written the moment above, and what it means.
DATE_TEXT = f"""
    CASE doc_id % 12
      WHEN 0 THEN concat({_ISO}, 'Z')
      WHEN 1 THEN concat({_ISO}, '+03:00')
      WHEN 2 THEN {_ISO}
      WHEN 3 THEN concat('Mon, ', {_part('day')}, ' ', {_MONTH_NAME}, ' 2025 ', {_part('hour')}, ':', {_part('minute')}, ':00 +0300')
      WHEN 4 THEN concat({_part('day')}, ' ', {_MONTH_NAME}, ' 2025 ', {_part('hour')}, ':', {_part('minute')}, ':00 GMT')
      WHEN 5 THEN concat({_part('month')}, '/', {_part('day')}, '/2025')
      WHEN 6 THEN concat('Le ', {_part('day')}, ' ', {_FRENCH_MONTH}, ' 2025 a ', {_part('hour')}, ':', {_part('minute')})
      WHEN 7 THEN concat('[', {_part('hour')}, ':', {_part('minute')}, ', ', {_part('month')}, '/', {_part('day')}, '/2025] Redaction:')
      WHEN 8 THEN concat('{{"$date": "', {_ISO}, 'Z"}}')
      WHEN 9 THEN 'hier soir'
      WHEN 10 THEN ''
      ELSE NULL
    END
"""
_HOURS_BACK = f"({_MOMENT} - INTERVAL '3' HOUR)"
_DAY_ONLY = (
    "make_timestamp(2025, CAST(10 + floor((doc_id % 60) / 30) AS INT), CAST(1 + doc_id % 30 AS INT), 0, 0, 0)"
)
DATE_MEANING = f"""
    CASE doc_id % 12
      WHEN 0 THEN {_MOMENT} WHEN 1 THEN {_HOURS_BACK} WHEN 2 THEN {_MOMENT}
      WHEN 3 THEN {_HOURS_BACK} WHEN 4 THEN {_MOMENT} WHEN 5 THEN {_DAY_ONLY}
      WHEN 6 THEN {_MOMENT} WHEN 7 THEN {_MOMENT} WHEN 8 THEN {_MOMENT}
      ELSE NULL
    END
"""
ISO_MEANING = f"""
    CASE doc_id % 12
      WHEN 0 THEN {_MOMENT} WHEN 1 THEN {_HOURS_BACK} WHEN 2 THEN {_MOMENT} WHEN 8 THEN {_MOMENT}
      ELSE NULL
    END
"""

VIEWS = {
    # Documents as articles.
    "articles": f"""
        SELECT doc_id, md5(text) AS id_article,
               split_part(text, chr(10), 1) AS titre, text AS contenu,
               source, lang AS langue, {_MOMENT} AS date_publication
        FROM @documents
    """,
    # The articles that are in the table already.
    "existing": """
        SELECT a.* FROM @articles a WHERE a.doc_id IN (SELECT doc_id FROM @labels)
    """,
    # Documents as the article collection looks before it is repaired.
    "raw_articles": f"""
        SELECT doc_id,
          CASE doc_id % 29 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE md5(text) END AS id_article,
          CASE doc_id % 13 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   ' WHEN 3 THEN 'VIDE'
            WHEN 4 THEN ' Abcd ' ELSE split_part(text, chr(10), 1) END AS titre,
          CASE doc_id % 17 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN 'VIDE'
            ELSE text END AS contenu,
          CASE WHEN doc_id % 19 = 0 THEN NULL
            ELSE concat('https://www.', source, '.example.org/a/', CAST(doc_id AS @TEXT)) END AS url,
          CASE doc_id % 7 WHEN 0 THEN 'https://newsmada.com/feed/?page=2'
            WHEN 1 THEN 'https://www.lexpress.mg/feeds/posts/default' WHEN 2 THEN 'Malagasy News'
            WHEN 3 THEN 'Orange Actu WhatsApp' WHEN 4 THEN source WHEN 5 THEN NULL
            ELSE concat('http://www.', source, '.example.org:8080/rss') END AS source,
          CASE doc_id % 5 WHEN 0 THEN 'RSS' WHEN 1 THEN 'rss' WHEN 2 THEN NULL WHEN 3 THEN ''
            ELSE 'scrap_html' END AS source_type,
          CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN @EMPTY_LIST WHEN 2 THEN split(lang, ',')
            WHEN 3 THEN split(concat(lang, ',', source), ',') WHEN 4 THEN split('autre', ',')
            ELSE split('politique,sport,culture', ',') END AS categorie,
          CASE WHEN doc_id % 23 = 0 THEN NULL ELSE lang END AS langue,
          CASE doc_id % 4 WHEN 0 THEN 'positif' WHEN 1 THEN 'neutre' WHEN 2 THEN 'negatif'
            ELSE NULL END AS sentiment,
          CASE doc_id % 11 WHEN 0 THEN 'NaN' WHEN 1 THEN 'Infinity' WHEN 2 THEN '-Infinity'
            WHEN 3 THEN '{{"$numberDouble": "0.25"}}' WHEN 4 THEN 'abc' WHEN 5 THEN NULL
            WHEN 6 THEN '1.5f' ELSE CAST(doc_id / 64.0 AS @TEXT) END AS sentiment_score,
          CASE WHEN doc_id % 31 = 0 THEN NULL
            ELSE concat('site', CAST(doc_id % 5 AS @TEXT)) END AS origin,
          CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat({_ISO}, 'Z') END AS created_at,
          {DATE_TEXT} AS date_publication,
          {DATE_MEANING} AS date_meaning, {ISO_MEANING} AS iso_meaning
        FROM @documents
    """,
    # Events as dated, labelled articles.
    "typed_events": """
        SELECT event_id, ts,
          CASE WHEN user_id % 11 = 0 THEN NULL ELSE event_type END AS sentiment,
          CASE WHEN user_id % 13 = 0 THEN NULL
            ELSE concat('site', CAST(user_id % 7 AS @TEXT)) END AS origin,
          CASE WHEN user_id % 10 = 0 THEN NULL WHEN user_id % 10 = 1 THEN @EMPTY_LIST
            WHEN user_id % 2 = 0 THEN split(concat('cat', CAST(event_id % 4 AS @TEXT)), ',')
            ELSE split(concat('cat', CAST(event_id % 4 AS @TEXT), ',cat', CAST(event_id % 3 + 4 AS @TEXT)), ',')
          END AS categorie
        FROM @events
    """,
    # Documents as blocks of list pages, ten to a page.
    "blocks": f"""
        SELECT doc_id, CAST(floor(doc_id / 10) AS INT) AS page_num, CAST(doc_id % 10 AS INT) AS block_pos,
          trim(split_part(text, chr(10), 1)) AS titre,
          CASE WHEN doc_id % 3 = 0 THEN NULL ELSE concat({_part('day')}, '/', {_part('month')}, '/2025') END AS date_text,
          concat(trim(split_part(text, chr(10), 1)), chr(10),
                 CASE WHEN doc_id % 3 = 0 THEN '' ELSE concat({_part('day')}, '/', {_part('month')}, '/2025') END,
                 chr(10), text) AS raw_text
        FROM @documents
    """,
}
_NAME = re.compile(r"@(\w+)")


def _words(sql: str, words: dict[str, str]) -> str:
    return _NAME.sub(lambda m: words.get(m.group(1), m.group(0)), sql)


def expand(sql: str) -> str:
    """The SQL text with every view written out, for a database with the tables."""

    def fill(match: re.Match) -> str:
        name = match.group(1)
        return f"({expand(VIEWS[name])})" if name in VIEWS else name

    return _NAME.sub(fill, _words(sql, ORACLE_WORDS))


def build(tables: Tables, name: str, scan: Callable[[str], DataFrame]) -> DataFrame:
    """The view as a DataFrame, over tables read by ``scan``."""
    used: dict[str, DataFrame] = {}

    def fill(match: re.Match) -> str:
        part = match.group(1)
        used[part] = build(tables, part, scan) if part in VIEWS else scan(part)
        return "{" + part + "}"

    text = _words(VIEWS[name], SPARK_WORDS).replace("{", "{{").replace("}", "}}")
    return tables.spark.sql(_NAME.sub(fill, text), **used)

"""Reports on dated, labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsloom.catalog.registry import Tables, query
from newsloom.functions.urls import origin_key
from newsloom.plans import reports as P

START, END = "2024-01-03 00:00:00", "2024-01-25 18:00:00"
_DATED = f"""
    SELECT *, CAST(ts AS DATE) AS day FROM @typed_events
    WHERE ts >= TIMESTAMP '{START}' AND ts <= TIMESTAMP '{END}'
"""
_EXPLODED = "SELECT * EXCLUDE (categorie), unnest(categorie) AS categorie FROM ({rows})"
TYPES = ["click", "error", "purchase", "signup", "view"]
SITES = [f"site{i}" for i in range(7)]
CATEGORIES = [f"cat{i}" for i in range(7)]


def _wide(values: list[str], column: str) -> str:
    return ", ".join(f"count(*) FILTER (WHERE {column} = '{v}') AS {v}" for v in values)


def _day_text(df: DataFrame) -> DataFrame:
    return df.withColumn("day", F.col("day").cast("string"))


def _counts(sql: str, key: str) -> str:
    return f"SELECT {key}, count(*) AS n FROM ({sql}) WHERE {key} IS NOT NULL GROUP BY {key}"


def _shares(sql: str, key: str, scale: float) -> str:
    return f"""
        SELECT {key}, n, round(CAST({scale} AS DOUBLE) * n / sum(n) OVER (), 6) AS share
        FROM ({_counts(sql, key)})
    """


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("share", F.round("share", 6))


@query("SELECT source_type, count(*) AS n FROM @raw_articles GROUP BY source_type")
def count_by_source_type(tables: Tables) -> DataFrame:
    return P.count_by(tables.view("raw_articles"), "source_type")


@query("SELECT strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, count(*) AS n FROM orders GROUP BY 1")
def count_by_created_at(tables: Tables) -> DataFrame:
    counted = P.count_by(tables.table("orders"), "o_orderdate")
    return counted.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


_CATEGORIES_OF_EVENTS = "SELECT unnest(categorie) AS categorie FROM @typed_events"


@query(_counts(_CATEGORIES_OF_EVENTS, "categorie"))
def category_counts(tables: Tables) -> DataFrame:
    return P.value_counts(P.explode_categories(tables.view("typed_events")), "categorie")


@query(_counts("SELECT sentiment FROM @typed_events", "sentiment"))
def sentiment_counts(tables: Tables) -> DataFrame:
    return P.value_counts(tables.view("typed_events"), "sentiment")


@query(_counts("SELECT langue FROM @raw_articles", "langue"))
def language_counts(tables: Tables) -> DataFrame:
    return P.value_counts(tables.view("raw_articles"), "langue")


@query(_shares(_CATEGORIES_OF_EVENTS, "categorie", 1))
def category_share(tables: Tables) -> DataFrame:
    exploded = P.explode_categories(tables.view("typed_events"))
    return _rounded(P.value_shares(exploded, "categorie"))


@query(_shares("SELECT sentiment FROM @typed_events", "sentiment", 1))
def sentiment_share(tables: Tables) -> DataFrame:
    return _rounded(P.value_shares(tables.view("typed_events"), "sentiment"))


@query(_shares("SELECT langue FROM @raw_articles", "langue", 100))
def language_share(tables: Tables) -> DataFrame:
    return _rounded(P.value_shares(tables.view("raw_articles"), "langue", 100.0))


@query(
    _shares(
        r"""SELECT regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^www\.', '')
            AS origin FROM pages""",
        "origin",
        100,
    )
)
def origin_share(tables: Tables) -> DataFrame:
    pages = tables.table("pages").select(origin_key(F.col("url")).alias("origin"))
    return _rounded(P.value_shares(pages, "origin", 100.0))


_CALENDAR = """
    SELECT CAST(unnest(generate_series(DATE '2023-12-30', DATE '2024-01-25', INTERVAL 1 DAY)) AS DATE) AS day
"""
_DAILY = f"""
    SELECT c.day, coalesce(e.n, 0) AS n FROM ({_CALENDAR}) c LEFT JOIN (
      SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events
      WHERE ts >= TIMESTAMP '2023-12-30 00:00:00' GROUP BY 1) e ON c.day = e.day
"""


@query(f"SELECT CAST(day AS VARCHAR) AS day, n FROM ({_DAILY})")
def daily_volume(tables: Tables) -> DataFrame:
    return _day_text(P.daily_volume(tables.table("events"), "ts", "2023-12-30", "2024-01-25"))


@query(
    f"""
    SELECT CAST(day AS VARCHAR) AS day, round(n / (SELECT count(*) FROM events
      WHERE ts >= TIMESTAMP '2023-12-30 00:00:00'), 6) AS share FROM ({_DAILY})
    """
)
def daily_share(tables: Tables) -> DataFrame:
    shares = P.daily_share(tables.table("events"), "ts", "2023-12-30", "2024-01-25")
    return _rounded(_day_text(shares))


@query(
    f"""
    SELECT CAST(day AS VARCHAR) AS day, {_wide(TYPES, 'sentiment')} FROM ({_DATED})
    WHERE sentiment IS NOT NULL GROUP BY day
    """
)
def day_by_sentiment(tables: Tables) -> DataFrame:
    return _day_text(P.day_by(tables.view("typed_events"), "ts", "sentiment", START, END, TYPES))


@query(
    f"""
    SELECT CAST(day AS VARCHAR) AS day, {_wide(CATEGORIES, 'categorie')}
    FROM ({_EXPLODED.format(rows=_DATED)}) GROUP BY day
    """
)
def day_by_category(tables: Tables) -> DataFrame:
    return _day_text(P.day_by_category(tables.view("typed_events"), "ts", START, END, CATEGORIES))


@query(
    f"""
    SELECT CAST(day AS VARCHAR) AS day, {_wide(SITES, 'origin')} FROM ({_DATED})
    WHERE origin IS NOT NULL GROUP BY day
    """
)
def day_by_origin(tables: Tables) -> DataFrame:
    return _day_text(P.day_by(tables.view("typed_events"), "ts", "origin", START, END, SITES))


_BY_CATEGORY = f"""
    SELECT categorie, {_wide(TYPES, 'sentiment')} FROM ({_EXPLODED.format(rows=_DATED)})
    WHERE sentiment IS NOT NULL GROUP BY categorie
"""


@query(_BY_CATEGORY)
def category_by_sentiment(tables: Tables) -> DataFrame:
    return P.category_by_sentiment(tables.view("typed_events"), "ts", START, END, TYPES)


@query(
    f"""
    SELECT categorie, {', '.join(f"round({v} / ({' + '.join(TYPES)}), 6) AS {v}" for v in TYPES)}
    FROM ({_BY_CATEGORY})
    """
)
def category_sentiment_share(tables: Tables) -> DataFrame:
    wide = P.category_by_sentiment(tables.view("typed_events"), "ts", START, END, TYPES)
    shares = P.wide_row_shares(wide, TYPES)
    return shares.withColumns({v: F.round(v, 6) for v in TYPES})


@query(
    f"""
    SELECT categorie, sentiment, n, round(100.0 * n / sum(n) OVER (PARTITION BY categorie), 1) AS pct FROM (
      SELECT categorie, sentiment, count(*) AS n FROM ({_EXPLODED.format(rows=_DATED)})
      WHERE sentiment IS NOT NULL GROUP BY categorie, sentiment)
    """
)
def segment_percent(tables: Tables) -> DataFrame:
    counts = P.category_by_sentiment(tables.view("typed_events"), "ts", START, END)
    return P.segment_percent(counts, "categorie")


@query(
    """
    SELECT origin, coalesce(sentiment, 'Neutre') AS sentiment, count(*) AS n FROM @typed_events
    WHERE origin IS NOT NULL GROUP BY 1, 2
    """
)
def origin_by_sentiment(tables: Tables) -> DataFrame:
    return P.origin_by_sentiment(tables.view("typed_events"))


@query(
    """
    SELECT origin, categorie, count(*) AS n FROM (
      SELECT origin, unnest(coalesce(categorie, ['Autre'])) AS categorie FROM @typed_events
      WHERE origin IS NOT NULL) GROUP BY 1, 2
    """
)
def origin_by_category(tables: Tables) -> DataFrame:
    return P.origin_by_category(tables.view("typed_events"))


@query(
    """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, origin, count(*) AS n FROM @typed_events
    WHERE origin IS NOT NULL GROUP BY 1, 2
    """
)
def date_origin_counts(tables: Tables) -> DataFrame:
    return _day_text(P.date_origin_counts(tables.view("typed_events"), "ts"))

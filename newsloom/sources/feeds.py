"""Feed documents to article rows.

The input is a table of feed bodies, one row per document.  Both dialects are
read with a fixed schema; a document that is not well-formed has no entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.functions import dates as D
from newsloom.functions import html as H
from newsloom.functions import ids as I
from newsloom.functions import text as T

_TEXT = "struct<_VALUE: string, _type: string>"
RSS_SCHEMA = (
    "channel struct<item: array<struct<title: string, link: string, guid: string,"
    " description: string, summary: string, pubDate: string, published: string,"
    " updated: string, created: string>>>"
)
ATOM_SCHEMA = (
    "entry array<struct<"
    f"title: {_TEXT}, link: array<struct<_href: string, _rel: string, _VALUE: string>>,"
    f" id: string, summary: {_TEXT}, content: {_TEXT},"
    " published: string, updated: string, created: string>>"
)


def repair_feed_body(
    address: Column, body: Column, junk_host: str = fixed.JUNK_PREFIX_HOST
) -> Column:
    """Byte-order mark and blanks off the front; for one host, junk before the prologue."""
    trimmed = F.regexp_replace(body, "^[\\ufeffï»¿\\r\\n\\t ]+", "")
    cut = F.regexp_replace(trimmed, r"(?is)\A.*?(<\?xml)", "$1")
    return F.when(F.lower(address).contains(junk_host), cut).otherwise(trimmed)


def _rss_entries(parsed: Column) -> Column:
    return F.transform(
        parsed["channel"]["item"],
        lambda item: F.struct(
            item["title"].alias("title"),
            F.coalesce(item["link"], item["guid"]).alias("link"),
            F.coalesce(F.nullif(item["description"], F.lit("")), item["summary"]).alias("summary"),
            F.array(item["published"], item["updated"], item["pubDate"], item["created"]).alias("dates"),
        ),
    )


def _atom_entries(parsed: Column) -> Column:
    def alternate(links: Column) -> Column:
        fits = F.filter(links, lambda a: F.coalesce(a["_rel"], F.lit("alternate")) == "alternate")
        return F.get(fits, F.lit(0))["_href"]

    return F.transform(
        parsed["entry"],
        lambda entry: F.struct(
            entry["title"]["_VALUE"].alias("title"),
            F.coalesce(alternate(entry["link"]), entry["id"]).alias("link"),
            F.coalesce(
                F.nullif(entry["summary"]["_VALUE"], F.lit("")), entry["content"]["_VALUE"]
            ).alias("summary"),
            F.array(
                entry["published"], entry["updated"], F.lit(None).cast("string"), entry["created"]
            ).alias("dates"),
        ),
    )


def feed_entries(
    feeds: DataFrame,
    run_time: Column,
    address: str = "feed_url",
    body: str = "body",
    per_feed: int = fixed.ENTRIES_PER_FEED,
) -> DataFrame:
    """The valid ones among the first entries of every feed document.

    The first ``per_feed`` entries are taken before any of them is judged.  A
    date that is missing or unreadable becomes the time of the run.
    """
    repaired = feeds.select(
        F.col(address).alias("source"),
        repair_feed_body(F.col(address), F.col(body)).alias("_body"),
    )
    # The root element says which dialect it is, so each body is parsed once.
    is_atom = F.regexp_extract("_body", r"(?s)<([A-Za-z][\w:.-]*)", 1) == "feed"
    parsed = repaired.select(
        "source",
        F.from_xml(F.when(~is_atom, F.col("_body")), RSS_SCHEMA).alias("_rss"),
        F.from_xml(F.when(is_atom, F.col("_body")), ATOM_SCHEMA).alias("_atom"),
    )
    # Cleaned and judged inside the array, so a summary is cleaned once.
    shaped = F.transform(
        F.slice(F.coalesce(_rss_entries(F.col("_rss")), _atom_entries(F.col("_atom"))), 1, per_feed),
        lambda entry, place: F.struct(
            place.alias("entry_pos"),
            entry["link"].alias("link"),
            T.strip(F.coalesce(entry["title"], F.lit("NO TITLE"))).alias("titre"),
            H.clean_summary(entry["summary"]).alias("contenu"),
            F.filter(entry["dates"], lambda d: d.isNotNull() & (d != "")).alias("dates"),
        ),
    )
    valid = F.filter(
        shaped,
        lambda row: (F.coalesce(row["link"], F.lit("")) != "")
        & (F.length(row["titre"]) >= fixed.MIN_TITLE_LENGTH)
        & (F.length(row["contenu"]) >= fixed.MIN_SUMMARY_LENGTH),
    )
    rows = parsed.select("source", F.inline(valid))
    dates = F.filter(F.transform("dates", lambda d: D.parse_mixed_date(d)), lambda d: d.isNotNull())
    return rows.select(
        I.md5_id(F.col("link")).alias("id_article"),
        "source",
        "titre",
        "contenu",
        T.strip(F.col("link")).alias("url"),
        F.coalesce(F.get(dates, F.lit(0)), run_time).alias("date_publication"),
        run_time.alias("created_at"),
        F.lit(fixed.FEED_SOURCE_TYPE).alias("source_type"),
        "entry_pos",
    )

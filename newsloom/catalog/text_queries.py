"""Text functions, addresses, ids and the sources built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsloom import fixed_values as fixed
from newsloom.catalog.quality_queries import stripped
from newsloom.catalog.registry import ORACLES, Tables, query
from newsloom.catalog.tables_queries import RUN_TIME, moment_text, run_time
from newsloom.functions import html as H
from newsloom.functions import ids as I
from newsloom.functions import text as T
from newsloom.functions.staging import with_once
from newsloom.operators import origin as O
from newsloom.plans.ingest import union_sources as unite
from newsloom.sources import blocks as B
from newsloom.sources import feeds as E
from newsloom.sources import messages as M
from newsloom.sources import pages as P

SPACES = r"[\s\x0B\x1C-\x1F\x85\p{Z}]+"


def collapsed(text: str) -> str:
    return f"trim(regexp_replace({text}, '{SPACES}', ' ', 'g'))"


def decoded(text: str) -> str:
    """References with and without semicolon; the ampersand last."""
    closed = text
    for _ in range(2):
        closed = (
            f"regexp_replace({closed}, '&(amp|lt|gt|quot|nbsp|copy|middot)([^;A-Za-z0-9.\\-]|$)',"
            r" '&\1;\2', 'g')"
        )
    for name, char in [
        ("quot", '"'), ("copy", "©"), ("middot", "·"), ("nbsp", " "), ("lt", "<"), ("gt", ">"), ("amp", "&")
    ]:
        closed = f"replace({closed}, '&{name};', '{char}')"
    return closed


def plain(text: str, separator: str) -> str:
    hidden = "|".join(
        [r"<!--.*?(?:-->|$)"]
        + [rf"<{n}\b[^>]*>.*?(?:</{n}\s*>|$)" for n in ("script", "style", "template", "rt", "rp")]
        + [r"<[!?][^>]*>"]
    )
    bare = f"regexp_replace({text}, '(?is){hidden}', '{separator}', 'g')"
    return decoded(f"regexp_replace({bare}, '</?[A-Za-z][^>]*>', '{separator}', 'g')")


def normal(text: str) -> str:
    return f"trim(regexp_replace(strip_accents(lower({text})), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'))"


def inner(html: str, tag: str) -> str:
    return f"regexp_extract({html}, '(?is)<{tag}(?:[\\s/][^>]*)?>(.*?)</{tag}[\\s>]', 1)"


def summary(text: str) -> str:
    """First line with something on it, cut, dotted."""
    lines = plain(text, "")
    first = f"regexp_extract({lines}, '(?:^|\\n)[^\\n]*?([^\\s\\x0B\\x1C-\\x1F\\x85\\p{{Z}}][^\\n]*)', 1)"
    cut = f"concat(substr({stripped(first)}, 1, 500), '...')"
    return f"CASE WHEN {first} = '' THEN '' ELSE {collapsed(cut)} END"


# --- text ---------------------------------------------------------------------------


@query(
    f"""
    SELECT 'page' AS kind, page_id AS id, {collapsed(plain('html', ' '))} AS plain FROM pages
    UNION ALL SELECT 'document', doc_id, {collapsed(plain('text', ' '))} FROM documents
    """
)
def clean_html_text(tables: Tables) -> DataFrame:
    pages = tables.table("pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("markup")
    )
    documents = tables.table("documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("markup")
    )
    return H.clean_html_text(pages.union(documents), "markup", "plain").select("kind", "id", "plain")


@query(f"SELECT page_id, {collapsed(plain('html', ''))} AS plain FROM pages")
def strip_html_nosep(tables: Tables) -> DataFrame:
    return tables.table("pages").select("page_id", H.strip_html_nosep(F.col("html")).alias("plain"))


@query(f"SELECT doc_id, {normal('text')} AS normal FROM documents")
def normalize_text(tables: Tables) -> DataFrame:
    return tables.table("documents").select("doc_id", T.normalize_text(F.col("text")).alias("normal"))


@query(f"SELECT doc_id, {summary('text')} AS summary FROM documents")
def clean_summary(tables: Tables) -> DataFrame:
    return tables.table("documents").select("doc_id", H.clean_summary(F.col("text")).alias("summary"))


@query(
    f"""
    WITH w AS (SELECT doc_id, split(words, ' ') AS ws
      FROM (SELECT doc_id, {normal('text')} AS words FROM documents) WHERE words <> ''),
    grams AS (
      SELECT doc_id, 2 AS size, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS gram FROM w
      UNION ALL
      SELECT doc_id, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w
      WHERE len(ws) > 2)
    SELECT doc_id, CAST(size AS BIGINT) AS size, count(*) AS n, count(DISTINCT gram) AS different,
      min(gram) AS first_gram, max(gram) AS last_gram FROM grams GROUP BY doc_id, size
    """
)
def word_ngrams(tables: Tables) -> DataFrame:
    normal = {"words": T.words(T.normalize_text(F.col("text")))}
    documents = with_once(tables.table("documents").select("doc_id", "text"), normal)

    def summed(size: int):
        # Per document, inside the row: no gram leaves its task.
        return T.let(
            T.word_ngrams(F.col("words"), size),
            lambda grams: F.struct(
                F.lit(size).cast("long").alias("size"),
                F.size(grams).cast("long").alias("n"),
                F.size(F.array_distinct(grams)).cast("long").alias("different"),
                F.array_min(grams).alias("first_gram"),
                F.array_max(grams).alias("last_gram"),
            ),
        )

    return documents.select("doc_id", F.inline(F.array(summed(2), summed(3)))).where("n > 0")


# --- ids and addresses -----------------------------------------------------------------


@query("SELECT page_id, md5(url) AS id_article FROM pages")
def article_id_md5(tables: Tables) -> DataFrame:
    return tables.table("pages").select("page_id", I.md5_id(F.col("url")).alias("id_article"))


@query("SELECT page_id, sha256(url) AS id_article FROM pages")
def article_id_sha256(tables: Tables) -> DataFrame:
    return tables.table("pages").select("page_id", I.sha256_id(F.col("url")).alias("id_article"))


@query(
    """
    SELECT conv_id, turn, sha256(role || '-' || text) AS long_id,
      substr(sha256(role || '-' || text), 1, 16) AS short_id FROM conversations
    """
)
def article_id_title_date(tables: Tables) -> DataFrame:
    title, date = F.col("role"), F.col("text")
    return tables.table("conversations").select(
        "conv_id",
        "turn",
        I.title_date_id(title, date).alias("long_id"),
        I.short_title_date_id(title, date).alias("short_id"),
    )


@query(
    r"""
    WITH links AS (
      SELECT page_id, url, regexp_extract(a, 'href="([^"]*)"', 1) AS href,
        regexp_extract(a, '(?s)>(.*)</a>', 1) AS titre
      FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '(?s)<a [^>]*href="[^"]*"[^>]*>.*?</a>')) AS a
        FROM pages))
    SELECT page_id, href, titre, CASE WHEN href LIKE 'http%' THEN href WHEN href LIKE '/%'
      THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href END AS link
    FROM links WHERE href <> ''
    """
)
def resolve_url(tables: Tables) -> DataFrame:
    pages = tables.table("pages").select("page_id", "url", "html")
    return P.page_links(pages).select("page_id", "href", "titre", "link")


NAMES = ", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in fixed.ORIGIN_NAMES.items())
DOMAIN = r"""CASE WHEN starts_with(source, 'http')
        THEN regexp_replace(regexp_extract(source, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^www\.', '')
        ELSE source END"""
_SOURCES = """
    SELECT 'page' AS kind, page_id AS id, url AS source FROM pages
    UNION ALL SELECT 'article', doc_id, source FROM @raw_articles
"""


@query(
    rf"""
    WITH keyed AS (SELECT kind, id, source, {DOMAIN} AS domain FROM ({_SOURCES}))
    SELECT kind, id, source, coalesce(names.origin, keyed.domain) AS origin
    FROM keyed LEFT JOIN (VALUES {NAMES}) AS names(domain, origin) ON keyed.domain = names.domain
    """
)
def origin_lookup(tables: Tables) -> DataFrame:
    pages = tables.table("pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("url").alias("source")
    )
    raw = tables.view("raw_articles").select(
        F.lit("article").alias("kind"), F.col("doc_id").alias("id"), "source"
    )
    return pages.union(raw).withColumn("origin", O.origin_of(F.col("source")))


# --- sources ----------------------------------------------------------------------------


def feeds_of(tables: Tables) -> DataFrame:
    """Documents as feeds of twenty entries each, in both dialects, some with junk in front."""

    def escaped(column: str):
        plain = F.replace(F.col(column), F.lit("&"), F.lit("&amp;"))
        return F.replace(F.replace(plain, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    feed = F.floor(F.col("doc_id") / 20)
    link = F.concat(F.lit("https://news.example.org/a/"), F.col("doc_id").cast("string"))
    when = F.col("date_publication")
    rss = F.concat(
        F.lit("<item><title>"), escaped("titre"), F.lit("</title><link>"), link,
        F.lit("</link><pubDate>"), F.date_format(when, "EEE, dd MMM yyyy HH:mm:ss"),
        F.lit(" +0300</pubDate><description>"), escaped("contenu"), F.lit("</description></item>"),
    )
    atom = F.concat(
        F.lit("<entry><title type='text'>"), escaped("titre"),
        F.lit("</title><link rel='self' href='https://news.example.org/self'/><link rel='alternate' href='"),
        link, F.lit("'/><updated>"), F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit("Z</updated><summary type='html'>"), escaped("contenu"), F.lit("</summary></entry>"),
    )
    entries = tables.view("articles").select(
        feed.alias("feed"), "doc_id", F.when(feed % 2 == 0, rss).otherwise(atom).alias("entry")
    )
    # Twenty entries meet per feed, never more.
    bodies = entries.groupBy("feed").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "entry"))), lambda e: e["entry"]), ""
        ).alias("entries")
    )
    prologue = F.lit('<?xml version="1.0" encoding="UTF-8"?>')
    body = F.when(
        F.col("feed") % 2 == 0,
        F.concat(prologue, F.lit("<rss version='2.0'><channel><title>t</title>"), "entries", F.lit("</channel></rss>")),
    ).otherwise(
        F.concat(prologue, F.lit("<feed xmlns='http://www.w3.org/2005/Atom'><title>t</title>"), "entries", F.lit("</feed>"))
    )
    return bodies.select(
        F.concat(
            F.when(F.col("feed") % 3 == 0, "https://midi-madagasikara.mg/feed/").otherwise("https://feeds.example.org/"),
            F.col("feed").cast("string"),
        ).alias("feed_url"),
        F.concat(
            F.when(F.col("feed") % 3 == 0, "\n junk before ").otherwise("﻿\r\n"), body
        ).alias("body"),
    )


_FEED_URL = """concat(CASE WHEN feed % 3 = 0 THEN 'https://midi-madagasikara.mg/feed/'
      ELSE 'https://feeds.example.org/' END, CAST(feed AS VARCHAR))"""


@query(
    f"""
    SELECT md5(link) AS id_article, {_FEED_URL} AS source, titre, contenu, link AS url,
      strftime(CASE WHEN feed % 2 = 0 THEN date_publication - INTERVAL '3' HOUR ELSE date_publication END,
        '%Y-%m-%d %H:%M:%S') AS date_publication,
      '{RUN_TIME}' AS created_at, 'RSS' AS source_type, entry_pos
    FROM (SELECT CAST(floor(doc_id / 20) AS BIGINT) AS feed, date_publication,
        'https://news.example.org/a/' || CAST(doc_id AS VARCHAR) AS link,
        {stripped('titre')} AS titre, {summary('contenu')} AS contenu,
        row_number() OVER (PARTITION BY floor(doc_id / 20) ORDER BY doc_id) - 1 AS entry_pos
      FROM @articles)
    WHERE entry_pos < 15 AND length(titre) >= 5 AND length(contenu) >= 20
    """
)
def feed_entries(tables: Tables) -> DataFrame:
    rows = E.feed_entries(feeds_of(tables), run_time())
    return rows.withColumns(
        {
            "date_publication": moment_text("date_publication"),
            "created_at": moment_text("created_at"),
            "entry_pos": F.col("entry_pos").cast("long"),
        }
    )


@query(
    """
    SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN concat('<?xml version="1.0"?>', text)
      ELSE concat('junk <?xml version="1.0"?>', text) END AS body FROM documents
    """
)
def feed_body_repair(tables: Tables) -> DataFrame:
    even = F.col("doc_id") % 2 == 0
    address = F.when(even, "https://Midi-Madagasikara.mg/feed/").otherwise("https://2424.mg/feed/")
    body = F.concat(F.lit('﻿ \r\n\tjunk <?xml version="1.0"?>'), F.col("text"))
    return tables.table("documents").select("doc_id", E.repair_feed_body(address, body).alias("body"))


@query(
    f"""
    SELECT sha256(url) AS id_article, 'Example' AS source, 'scrap_html' AS source_type,
      {collapsed(plain(inner('html', 'h1'), ' '))} AS titre, contenu, url,
      '{RUN_TIME}' AS date_publication, '{RUN_TIME}' AS created_at
    FROM (SELECT url, html, {collapsed(plain(collapsed(plain(inner('html', 'article'), ' ')), ' '))} AS contenu FROM pages)
    WHERE contenu <> ''
    """
)
def page_articles(tables: Tables) -> DataFrame:
    rows = P.site_articles(tables.table("pages").select("url", "html"), run_time(), "Example", "article")
    return rows.withColumns(
        {c: moment_text(c) for c in ("date_publication", "created_at")}
    )


@query(
    f"""
    WITH dated AS (SELECT *, coalesce(date_text, '2026-01-01T00:00:00+00:00') AS date_publication FROM @blocks),
    bare AS (SELECT *, replace(replace({stripped('raw_text')}, {stripped('titre')}, ''), date_publication, '') AS rest
      FROM (SELECT * FROM dated))
    SELECT doc_id, sha256({stripped('titre')} || '-' || date_publication) AS id_article, {stripped('titre')} AS titre,
      {collapsed(plain(stripped('rest'), ' '))} AS contenu, date_publication,
      'https://actu.orange.mg/depeches/#page-' || CAST(page_num AS VARCHAR) AS url
    FROM bare
    """
)
def block_articles(tables: Tables) -> DataFrame:
    rows = B.block_articles(tables.view("blocks"), run_time())
    return rows.select(
        (F.col("page_num") * 10 + F.col("block_pos")).cast("long").alias("doc_id"),
        "id_article", "titre", "contenu", "date_publication", "url",
    )


_MESSAGES = f"""
    SELECT conv_id, turn, {stripped('text')} AS full_text,
      {stripped("split_part(" + stripped('text') + ", chr(10), 1)")} AS line,
      {stripped("substr(" + stripped('text') + ", length(split_part(" + stripped('text') + ", chr(10), 1)) + 2)")} AS rest
    FROM conversations
"""


@query(
    f"""
    SELECT conv_id, turn, substr(sha256(line || '-2026-01-01T00:00:00+00:00'), 1, 16) AS id_article,
      'Orange Actu WhatsApp' AS source, 'whatsapp_channel_selenium' AS source_type,
      substr(line, 1, 200) AS titre,
      {collapsed(plain("CASE WHEN rest = '' THEN full_text ELSE rest END", ' '))} AS contenu,
      '2026-01-01T00:00:00+00:00' AS date_publication, '2026-01-01T00:00:00+00:00' AS created_at
    FROM ({_MESSAGES}) WHERE length(full_text) >= 5
    """
)
def message_articles(tables: Tables) -> DataFrame:
    return M.message_articles(tables.table("conversations").select("conv_id", "turn", "text"), run_time())


# --- sites by configuration, and all producers together ---------------------------------

# Pages as those of three sites, two of which are configured, with a date in front of the article.
SITES = [
    ("Zero", "https://site0.example.org/list/", "h2.post-title a", "article", "span.date"),
    ("One", "https://site1.example.org/list/", "h2.post-title a", "article", "time.stamp"),
]


def dated_pages(tables: Tables) -> DataFrame:
    number = F.col("page_id").cast("string")
    site = (F.col("page_id") % 3).cast("string")
    day = F.concat((F.col("page_id") % 28 + 1).cast("string"), F.lit(" octobre 2025"))
    shown = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('<span class="date">'), day, F.lit("</span>"))).otherwise(
        F.concat(F.lit("<time class='stamp'>Le "), day, F.lit("</time>"))
    )
    return tables.table("pages").select(
        "page_id",
        F.concat(F.lit("https://site"), site, F.lit(".example.org/a/"), number).alias("url"),
        F.replace(F.col("html"), F.lit("<article>"), F.concat(shown, F.lit("<article>"))).alias("html"),
    )


def listings(tables: Tables) -> DataFrame:
    """List pages of up to twenty links each; links in no heading or one of another class do not count."""
    site, part = F.col("page_id") % 3, F.floor(F.col("page_id") / 60)
    link = F.concat(
        F.lit('<h2 class="post-title"><a href="/a/'), F.col("page_id").cast("string"), F.lit('">Titre <b>'),
        F.col("page_id").cast("string"), F.lit("</b></a></h2>"),
    )
    rows = tables.table("pages").select(site.alias("site"), part.alias("part"), "page_id", link.alias("link"))
    lists = rows.groupBy("site", "part").agg(F.array_sort(F.collect_list(F.struct("page_id", "link"))).alias("links"))
    return lists.select(
        F.concat(F.lit("https://site"), F.col("site").cast("string"), F.lit(".example.org/list/"), F.col("part").cast("string")).alias("url"),
        F.concat(
            F.lit('<a href="/a/0">no</a><h2 class="post-title-old"><a href="/a/0">no</a></h2><h2 data-class="post-title"><a href="/a/0">no</a></h2>'),
            F.array_join(F.transform("links", lambda x: x["link"]), ""),
        ).alias("html"),
    )


def _by_site(title: str) -> str:
    return f"""
        SELECT sha256(url) AS id_article, CASE WHEN page_id % 3 = 0 THEN 'Zero' ELSE 'One' END AS source, 'scrap_html' AS source_type,
          titre, contenu, url, strftime(make_timestamp(2025, 10, CAST(page_id % 28 + 1 AS INT), 0, 0, 0), '%Y-%m-%d %H:%M:%S') AS date_publication,
          '{RUN_TIME}' AS created_at
        FROM (SELECT page_id, 'https://site' || CAST(page_id % 3 AS VARCHAR) || '.example.org/a/' || CAST(page_id AS VARCHAR) AS url,
            {title} AS titre, {collapsed(plain(collapsed(plain(inner('html', 'article'), ' ')), ' '))} AS contenu FROM pages)
        WHERE contenu <> '' AND page_id % 3 < 2
    """


def _timed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: moment_text(c) for c in ("date_publication", "created_at")})


@query(_by_site(collapsed(plain(inner("html", "h1"), " "))))
def site_pages(tables: Tables) -> DataFrame:
    return _timed(P.page_articles(dated_pages(tables).select("url", "html"), run_time(), SITES))


@query(_by_site("'Titre ' || CAST(page_id AS VARCHAR)"))
def site_listings(tables: Tables) -> DataFrame:
    return _timed(P.listed_articles(listings(tables), dated_pages(tables).select("url", "html"), run_time(), SITES))


COMMON = ("id_article", "source", "source_type", "titre", "contenu", "url")


def produced(tables: Tables) -> DataFrame:
    """Feed, page, block and message articles as one table."""
    return unite(
        E.feed_entries(feeds_of(tables), run_time()).select(*COMMON),
        P.site_articles(tables.table("pages").select("url", "html"), run_time(), "Example", "article").select(*COMMON),
        B.block_articles(tables.view("blocks"), run_time()).select(*COMMON),
        M.message_articles(tables.table("conversations").select("text"), run_time()).select(*COMMON[:-1]),
    )


_BLOCK_SOURCE = "'" + "', '".join(fixed.BLOCK_SOURCE[:2]) + "'"
PRODUCED = f"""
    SELECT {', '.join(COMMON)} FROM ({ORACLES['feed_entries']})
    UNION ALL SELECT {', '.join(COMMON)} FROM ({ORACLES['page_articles']})
    UNION ALL SELECT id_article, {_BLOCK_SOURCE}, titre, contenu, url FROM ({ORACLES['block_articles']})
    UNION ALL SELECT id_article, source, source_type, titre, contenu, NULL FROM ({ORACLES['message_articles']})
"""


@query(PRODUCED)
def union_sources(tables: Tables) -> DataFrame:
    return produced(tables)

"""Feeds, pages, blocks, messages and tables."""

import pytest
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.operators import keys as K
from newsloom.schemas import PUBLISHED_SCHEMA
from newsloom.sources import blocks as B
from newsloom.sources import feeds as E
from newsloom.sources import messages as M
from newsloom.sources import pages as P
from newsloom.sources import tables as S

def now():
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


def rss(*items):
    return f"<?xml version='1.0'?><rss><channel><title>t</title>{''.join(items)}</channel></rss>"


def item(n, title="Un titre", summary="Un résumé assez long", extra=""):
    return f"<item><title>{title}</title><link>http://n/{n}</link><description>{summary}</description>{extra}</item>"


def entries(spark, *bodies, address="https://f.org/"):
    rows = [(address + str(i), body) for i, body in enumerate(bodies)]
    df = spark.createDataFrame(rows, "feed_url string, body string")
    return E.feed_entries(df, now()).orderBy("source", "entry_pos").collect()


def test_first_fifteen_before_any_filter(spark):
    body = rss(*[item(i, title="abc" if i < 3 else "Un titre") for i in range(16)])
    assert [r.entry_pos for r in entries(spark, body)] == list(range(3, 15))


def test_feed_edges(spark):
    rows = entries(
        spark,
        "﻿\n" + rss(item(1)),
        rss(item(2)).replace("</channel>", ""),  # not well-formed
        rss(),  # nothing in it
        rss("<item><title>Un titre</title><guid>http://g/3</guid><description>Un résumé assez long</description></item>"),
        rss("<item><title>Un titre</title><description>Un résumé assez long</description></item>"),  # no address
        rss(item(5, summary="x" * 16), item(6, summary="x" * 17)),  # 19 and 20 characters with the dots
        rss(item(7, summary="<![CDATA[<p>Premier</p>\n<p>un paragraphe</p>]]>", extra="<pubDate>bad</pubDate>")),
        rss("<item><link> http://n/8 </link><description>Un résumé assez long</description></item>"),
        "junk " + rss(item(9)),
        None,
    )
    assert [r.url for r in rows] == ["http://n/1", "http://g/3", "http://n/6", "http://n/8"]
    assert rows[-1].titre == "NO TITLE"
    assert all(str(r.date_publication) == "2026-01-01 00:00:00" or r.date_publication for r in rows)


def test_junk_in_front_is_cut_for_one_host_only(spark):
    body = "junk " + rss(item(1))
    assert len(entries(spark, body, address="https://midi-madagasikara.mg/feed/")) == 1
    assert entries(spark, body) == []


def test_atom(spark):
    body = (
        "<feed xmlns='http://www.w3.org/2005/Atom'><entry><title type='html'>Un titre</title>"
        "<link rel='self' href='http://s/'/><link rel='alternate' href='http://n/1'/>"
        "<published>2025-10-12T15:00:00+03:00</published><content type='html'>&lt;p&gt;Un résumé assez long&lt;/p&gt;</content>"
        "</entry></feed>"
    )
    (row,) = entries(spark, body)
    assert (row.url, row.titre, row.contenu) == ("http://n/1", "Un titre", "Un résumé assez long...")


def test_pages_by_site_and_links(spark):
    listing = "https://www.malagasynews.com/actualites/"
    html = (
        '<h1>T</h1><span class="date">12 octobre 2025</span>'
        '<div class="entry-content"><p>Bon</p><div>jour</div></div>'
    )
    pages = spark.createDataFrame(
        [("https://www.malagasynews.com/a", html), ("https://www.malagasynews.com/b", "<p>no</p>"), ("https://else.org/c", html)],
        "url string, html string",
    )
    (row,) = P.page_articles(pages, now()).collect()
    assert (row.titre, row.contenu, row.source) == ("T", "Bon jour", "Malagasy News")
    listings = spark.createDataFrame(
        [(listing, '<h2 class="post-title"><a href="../a">Le <b>titre</b></a></h2><h2><a href="/b">autre</a></h2>')],
        "url string, html string",
    )
    (row,) = P.listed_articles(listings, pages, now()).collect()
    assert (row.titre, row.url) == ("Le titre", "https://www.malagasynews.com/a")


def test_blocks(spark):
    rows = [
        (1, 0, "Titre", "12/10/2025", "Titre 12/10/2025 corps Titre fin"),
        (1, 1, "Autre", None, "Autre corps"),
        (2, 0, "Titre", "12/10/2025", "Titre 12/10/2025 corps Titre fin"),
    ]
    df = spark.createDataFrame(rows, "page_num int, block_pos int, titre string, date_text string, raw_text string")
    got = B.block_articles(df, now())
    first = K.keep_first(got, "id_article", "page_num", "block_pos").orderBy("page_num", "block_pos").collect()
    assert [(r.contenu, r.url.rsplit("#")[1]) for r in first] == [("corps fin", "page-1"), ("corps", "page-1")]
    assert first[1].date_publication == "2026-01-01T00:00:00+00:00"


def test_messages(spark):
    rows = [("abcd", None), ("abcde", "[10:32, 12/10/2025] X:"), (" Titre \nligne 1\nligne 2", ""), ("t" * 300, None)]
    df = spark.createDataFrame(rows, "text string, meta string")
    got = M.message_articles(df, now(), meta="meta").collect()
    assert [(r.titre, r.contenu) for r in got] == [("abcde", "abcde"), ("Titre", "ligne 1 ligne 2"), ("t" * 200, "t" * 300)]
    assert [r.date_publication[:5] for r in got] == ["[10:3", "2026-", "2026-"]
    assert all(len(r.id_article) == 16 for r in got)


@pytest.mark.parametrize("broken, fails", [(10, False), (11, True)])
def test_bad_record_budget(spark, tmp_path, broken, fails):
    path = str(tmp_path / "lines")
    good = '{"id_article": "a", "categorie": ["x"], "sentiment_score": 0.5, "created_at": "2025-01-01T00:00:00Z"}'
    lines = [(good,)] * 3 + [('{"id_article": ',)] * broken + [("",)]
    spark.createDataFrame(lines, "value string").write.text(path)
    if fails:
        with pytest.raises(S.BadRecordsError):
            S.load_json_lines(spark, path, PUBLISHED_SCHEMA)
    else:
        rows = S.load_json_lines(spark, path, PUBLISHED_SCHEMA).collect()
        assert len(rows) == 3 and rows[0].categorie == ["x"] and rows[0].created_at is not None


def test_create_table_if_missing(spark):
    S.create_table_if_missing(spark, "articles_clean_test", PUBLISHED_SCHEMA)
    S.create_table_if_missing(spark, "articles_clean_test", PUBLISHED_SCHEMA)
    assert spark.table("articles_clean_test").columns == PUBLISHED_SCHEMA.fieldNames()
    spark.sql("DROP TABLE articles_clean_test")


def test_write_by_day(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).select("id", (F.col("id") % 2).alias("day"))
    S.write_table(df, path, by="day")
    assert spark.read.parquet(path).where("day = 1").count() == 5
    with pytest.raises(Exception, match="(?i)exist"):
        S.write_table(df, path)


def test_sites_are_configured():
    assert [s[0] for s in fixed.SITES] == ["Malagasy News"]

"""Web pages to article rows, and list pages to links."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.functions import dates as D
from newsloom.functions import html as H
from newsloom.functions import ids as I
from newsloom.functions import selectors as E
from newsloom.functions import urls as U
from newsloom.functions.staging import with_once

_ANCHOR = r"(?is)<a(?=[\s>])[^>]*\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))[^>]*>(.*?)</a\s*>"


def page_links(
    pages: DataFrame, html: str = "html", url: str = "url", within: str | None = None
) -> DataFrame:
    """One row per link of a page: position, title and absolute address.

    With ``within``, a selector such as ``div.list > h2.post-title``, only the
    links inside what it selects count.
    """
    markup = F.col(html)
    if within is not None:
        inside = ", ".join(f"{one.strip()} a" for one in within.split(","))
        return selected_links(pages, E.elements(markup, inside), html, url)
    anchors = F.regexp_extract_all(markup, F.lit(_ANCHOR), F.lit(0))
    rows = pages.select(*pages.columns, F.posexplode(anchors).alias("link_pos", "_anchor"))
    href = F.concat(*[F.regexp_extract("_anchor", _ANCHOR, g) for g in (1, 2, 3)])
    label = F.regexp_extract("_anchor", _ANCHOR, 4)
    return _resolved(rows.withColumn("href", href).withColumn("_label", label), url).drop("_anchor", html)


def selected_links(pages: DataFrame, chosen: Column, html: str = "html", url: str = "url") -> DataFrame:
    """The links among the elements in ``chosen``: those with an address of their own."""
    rows = pages.select(*pages.columns, F.posexplode(chosen).alias("link_pos", "_label"))
    return _resolved(with_once(rows, {"href": E.attribute(F.col("_label"), "href")}), url).drop(html)


def _resolved(rows: DataFrame, url: str) -> DataFrame:
    return (
        rows.where(F.col("href") != "")
        .withColumn("titre", H.strip_html_nosep(F.col("_label")))
        .withColumn("link", U.resolve_url(F.col(url), F.col("href")))
        .drop("_label")
    )


def _articles(
    pages: DataFrame, run_time: Column, site: Column, content: Column, date: Column | None, title: Column | None
) -> DataFrame:
    """Articles of ``(url, html)`` by columns that read their parts; each is worked out once."""
    blocks = {"contenu": content, "_site": site}
    if title is not None:
        blocks["titre"] = title
    if date is not None:
        blocks["_date"] = date
    found = with_once(pages, blocks).where(F.col("contenu") != "")
    published = run_time if date is None else D.parse_date_or(F.col("_date"), run_time)
    cleaned = H.clean_html_text(found, "contenu", "contenu")
    return cleaned.select(
        I.sha256_id(F.col("url")).alias("id_article"),
        F.col("_site").alias("source"),
        F.lit(fixed.PAGE_SOURCE_TYPE).alias("source_type"),
        F.coalesce("titre", F.lit("")).alias("titre"),
        "contenu",
        "url",
        published.alias("date_publication"),
        run_time.alias("created_at"),
    )


def site_articles(
    pages: DataFrame,
    run_time: Column,
    site: str,
    content: str,
    date: str | None = None,
    title: str | None = "h1",
) -> DataFrame:
    """Articles of one site's pages ``(url, html)`` by its selectors.

    Pages without content are left out; a missing or unreadable date becomes
    the time of the run.  Without a title selector ``titre`` is taken as given.
    """
    html = F.col("html")
    parts = [None if selector is None else E.first_text(html, selector) for selector in (content, date, title)]
    return _articles(pages, run_time, F.lit(site), *parts)


class Sites:
    """Configured sites as columns: each page is read by the selectors of the site on its host.

    ``sites`` holds name, list address, link selector, content selector and date
    selector.  The columns are one case each, so a table is scanned once for all
    sites and a page costs the work of its own site only.
    """

    def __init__(self, sites: list[tuple] = fixed.SITES):
        self.sites = sites

    def _case(self, make: Callable[[tuple], Column], kind: str = "string") -> Column:
        host, case = U.netloc(F.col("url")), F.lit(None).cast(kind)
        for site in reversed(self.sites):
            case = F.when(host == U.netloc(F.lit(site[1])), make(site)).otherwise(case)
        return case

    def name(self) -> Column:
        return self._case(lambda site: F.lit(site[0]))

    def block(self, place: int) -> Column:
        return self._case(lambda site: E.first_text(F.col("html"), site[place]))

    def listed(self) -> Column:
        return self._case(lambda site: E.elements(F.col("html"), site[2]), "array<string>")


def page_articles(pages: DataFrame, run_time: Column, sites: list[tuple] = fixed.SITES) -> DataFrame:
    """Articles of all configured sites; a page belongs to the site on its host, others are left out."""
    by = Sites(sites)
    own = pages.where(by.name().isNotNull())
    return _articles(own, run_time, by.name(), by.block(3), by.block(4), E.first_text(F.col("html"), "h1"))


def listed_articles(
    listings: DataFrame, pages: DataFrame, run_time: Column, sites: list[tuple] = fixed.SITES
) -> DataFrame:
    """Articles that the sites' list pages link to, titled as they are there.

    ``listings`` and ``pages`` are ``(url, html)`` and meet by address.  An
    article listed twice comes out twice, with the same id.
    """
    by = Sites(sites)
    links = selected_links(listings.where(by.name().isNotNull()), by.listed())
    found = links.select("titre", F.col("link").alias("url")).join(pages.select("url", "html"), "url")
    own = found.where(by.name().isNotNull())
    return _articles(own, run_time, by.name(), by.block(3), by.block(4), None)

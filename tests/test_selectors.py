"""Selectors over the element stream, against an independent reader built on the standard library."""

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from newsloom.functions import html as H
from newsloom.functions import selectors as E
from newsloom.sources import pages as P

VOID = set(E.VOID)


class Tree(HTMLParser):
    """Elements with their parents; every text is noted with the elements it is in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.every, self.stack, self.texts = [], [], []

    def handle_starttag(self, tag, attrs):
        element = {"tag": tag, "attrs": {k: v or "" for k, v in attrs}, "parent": self.stack[-1] if self.stack else None, "n": len(self.every)}
        self.every.append(element)
        if tag not in VOID:
            self.stack.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.stack.pop()

    def handle_endtag(self, tag):
        if any(e["tag"] == tag for e in self.stack):
            while self.stack.pop()["tag"] != tag:
                pass

    def handle_data(self, data):
        self.texts.append((data, {e["n"] for e in self.stack}))


def fits(element, compound):
    attrs = element["attrs"]
    if compound.tag not in (None, element["tag"]) or not set(compound.classes) <= set(attrs.get("class", "").split()):
        return False
    for name, how, wanted in compound.attributes:
        value = attrs.get(name)
        if value is None:
            return False
        tests = {None: True, "=": value == wanted, "^=": how == "^=" and value.startswith(wanted), "*=": how == "*=" and wanted in value}
        if not tests[how]:
            return False
    return True


def holds(element, chain):
    if not fits(element, chain[-1]):
        return False
    if len(chain) == 1:
        return True
    above = element["parent"]
    while above is not None:
        if holds(above, chain[:-1]):
            return True
        if chain[-1].child:
            return False
        above = above["parent"]
    return False


def plainly(markup, selector):
    tree = Tree()
    tree.feed(markup)
    tree.close()
    found = [e for e in tree.every if any(holds(e, chain) for chain in E.parse(selector))]
    return ["".join(t for t, inside in tree.texts if e["n"] in inside) for e in found]


def texts(spark, samples, selector):
    rows = spark.createDataFrame([(k, s) for k, s in enumerate(samples)], "k int, s string")
    got = rows.select("k", F.transform(E.elements(F.col("s"), selector), lambda e: F.regexp_replace(e, H.TAG, "")).alias("t"))
    return [r.t for r in got.orderBy("k").collect()]


SELECTORS = [
    "h2.post-title a", "div.entry-content", "span.date", "div", "div div", "div > div", "div.a.b", ".a", "*", "p, a", "#x", "a[href]",
    "div.a > p a", "p > a[href='1']", "ul li", "a[href^='1'], b", "div .b a", "* > b", "section div.a > *",
]


def pages(n, seed):
    dice = random.Random(seed)
    names = ["div", "p", "a", "b", "ul", "li", "h2", "span", "section"]
    for _ in range(n):
        parts = []
        for k in range(dice.randint(1, 40)):
            name = dice.choice(names)
            kind = dice.random()
            if kind < 0.45:
                css = dice.choice(["", ' class="a"', " class='a b'", ' class="post-title"', ' class="post-title-old"', " class=date", ' data-class="a"', ' CLASS="entry-content a"'])
                more = dice.choice(["", ' href="1"', ' id="x"', " href='12' title='a > b'", " hidden"])
                parts.append(f"<{name.upper() if dice.random() < 0.1 else name}{css}{more}>")
            elif kind < 0.8:
                parts.append(f"</{name}>")
            elif kind < 0.87:
                parts.append(dice.choice(["<br>", "<img src=a>", "<hr/>", "<span/>"]))
            parts.append(f"t{k} ")
        yield "".join(parts)


@pytest.mark.parametrize("selector", SELECTORS)
def test_random_pages_equal_the_plain_reader(spark, selector):
    samples = list(pages(60, selector))
    assert texts(spark, samples, selector) == [plainly(s, selector) for s in samples]


def test_odd_markup(spark):
    samples = [None, "", "no tags & 1 < 2", "<!-- <p>a</p> --><script>'<p>b</p>'</script><p>c</p>", "<p title='<p>'>d", "</p><p>e</p></p>"]
    assert texts(spark, samples, "p") == [None, [], [], ["c"], ["d"], ["e"]]


def test_class_names_are_whole_words(spark):
    page = (
        '<h2 class="post-title-old"><a href="/old">old</a></h2><h2 class="pre-post-title"><a href="/pre">pre</a></h2>'
        '<h2 class="x post-title"><b><a href="/new?a=1&amp;b=2">Le <i>titre</i></a></b><a>none</a></h2><a href="/out">out</a>'
    )
    rows = spark.createDataFrame([("https://a.org/l/", page)], "url string, html string")
    links = P.selected_links(rows, E.elements(F.col("html"), "h2.post-title a")).collect()
    assert [(r.titre, r.href, r.link) for r in links] == [("Le titre", "/new?a=1&b=2", "https://a.org/new?a=1&b=2")]
    within = P.page_links(rows, within="h2.post-title").collect()
    assert [r.link for r in within] == ["https://a.org/new?a=1&b=2"]


@pytest.mark.parametrize("selector", ["", ">", "a >", "a,", "a[", "a..b", "a:hover", "a + b"])
def test_what_is_no_selector_is_refused(selector):
    with pytest.raises(ValueError):
        E.parse(selector)

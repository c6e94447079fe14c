"""Column functions on the edges that the tables do not reach."""

import datetime as dt
import hashlib
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from newsloom.functions import dates as D
from newsloom.functions import html as H
from newsloom.functions import selectors as E
from newsloom.functions import ids as I
from newsloom.functions import numbers as N
from newsloom.functions import text as T
from newsloom.functions import urls as U


def values(spark, inputs, make):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def python_normal(text):
    bare = unicodedata.normalize("NFD", text.lower())
    bare = "".join(c for c in bare if unicodedata.category(c) != "Mn")
    return " ".join(re.sub(r"[^\w\s]", " ", bare).split())


def test_normalize_text_equals_python(spark):
    samples = [
        "Élève À l'école", "İstanbul ΑΣ", "x² ½ _under_", "한글 각", "ﬁn…", "a\x1cb c", "", "  ", "Ça-va?",
    ]
    assert values(spark, samples, T.normalize_text) == [python_normal(s) for s in samples]
    assert values(spark, [None], T.normalize_text) == [""]


def test_strip_and_blank(spark):
    samples = ["  a b \n", " x\x1c", "", None, " \t\n"]
    assert values(spark, samples, T.strip) == ["a b", "x", "", None, ""]
    assert values(spark, samples, T.is_blank) == [False, False, True, True, True]


def test_has_length_equals_the_stripped_length(spark):
    samples = ["", " ", "a", " a ", "ab", "a b", " a\n\nb ", "\n\nabc\u00a0", "a\U0001f600b", "\U0001f600\U0001f600", None]
    for least in (0, 1, 2, 3, 5):
        expected = [s if s is None else len(s.strip()) >= least for s in samples]
        assert values(spark, samples, lambda c: T.has_length(c, least)) == expected


def test_words_and_ngrams(spark):
    assert values(spark, ["a b c", "a", ""], T.words) == [["a", "b", "c"], ["a"], []]
    grams = values(spark, ["a b c", "a", ""], lambda c: T.word_ngrams(T.words(c), 2))
    assert grams == [["a b", "b c"], [], []]


def cleaned(spark, samples):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(samples)], "i int, x string")
    return [r.y for r in H.clean_html_text(df, "x", "y").orderBy("i").collect()]


def test_clean_html_text(spark):
    assert cleaned(
        spark,
        [
            "<p>Un<b>deux</b></p> trois",
            "a<!-- no -->b<script>var x='</p>'</script>c<style>p{}</style>",
            "a < b &amp; c &lt;i&gt; &eacute;&#233;&#xe9; &#146; &foo; AT&T &copy 1",
            '<a title="x > y">link</a>',
            "fi: ﬁ … ½  end é",
            "<ruby>k<rt>note</rt></ruby>",
            "<!-- open",
            None,
            "",
        ],
    ) == [
        "Un deux trois",
        "a b c",
        "a < b & c <i> ééé ’ &foo; AT&T © 1",
        "link",
        "fi: fi ... 1⁄2 end é",
        "k",
        "",
        "",
        "",
    ]


def test_strip_html_nosep(spark):
    assert values(spark, ["a<b>b</b>c<br>d", "&amp;lt;"], H.strip_html_nosep) == ["abcd", "&lt;"]


def test_clean_summary(spark):
    long = "x" * 600
    samples = ["\n\n first  line \nsecond", "", None, "  \n ", long, "<p>a</p>"]
    assert values(spark, samples, H.clean_summary) == [
        "first line...", "", "", "", "x" * 500 + "...", "a...",
    ]


def test_first_text_nests_and_matches_classes(spark):
    samples = [
        '<div class="a body x">1<div>2<div>3</div></div>4</div>5',
        "<div class='body'>only</div>",
        "<DIV CLASS=body>open",
        '<div class="nobody">no</div>',
        None,
    ]
    assert values(spark, samples, lambda c: E.first_text(c, "div.body")) == ["1 2 3 4", "only", "open", None, None]
    assert values(spark, ["<article-x>n</article-x><article id=1>y</article>"], lambda c: E.first_text(c, "article")) == ["y"]


@pytest.mark.parametrize(
    "href, expected",
    [
        ("", "https://a.org/x/y.html?q=1"),
        ("http://b.org/z", "http://b.org/z"),
        ("//b.org/z", "https://b.org/z"),
        ("/z?k=1", "https://a.org/z?k=1"),
        ("z", "https://a.org/x/z"),
        ("../z", "https://a.org/z"),
        ("./z/./w", "https://a.org/x/z/w"),
        ("../../../z", "https://a.org/z"),
        ("?p=2", "https://a.org/x/y.html?p=2"),
        ("#top", "https://a.org/x/y.html?q=1#top"),
        ("mailto:x@y", "mailto:x@y"),
    ],
)
def test_resolve_url(spark, href, expected):
    assert values(spark, [href], lambda c: U.resolve_url(F.lit("https://a.org/x/y.html?q=1"), c)) == [expected]


def test_origin_key(spark):
    samples = [
        "https://www.lexpress.mg/feeds", "http://u@h.org:8080/x", "http", "httpfoo", "Orange Actu", "http:foo", None,
    ]
    assert values(spark, samples, U.origin_key) == [
        "lexpress.mg", "u@h.org:8080", "", "", "Orange Actu", "", None,
    ]


def test_ids(spark):
    assert values(spark, [" u "], I.md5_id) == [hashlib.md5(b" u ").hexdigest()]
    short = values(spark, ["t"], lambda c: I.short_title_date_id(c, F.lit("d")))[0]
    assert len(short) == 16
    assert values(spark, [None], lambda c: I.title_date_id(c, F.lit("d"))) == [None]


def test_safe_float(spark):
    samples = [
        "1.5", "NaN", "Infinity", "-Infinity", '{"$numberDouble": "0.25"}', "abc", None, "1.5f", "1e400", "-2e-1", "",
    ]
    assert values(spark, samples, N.safe_float) == [1.5, None, None, None, 0.25, None, None, None, None, -0.2, None]


NOON = dt.datetime(2025, 10, 12, 12, 0)


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2025-10-12T12:00:00Z", NOON),
        ("2025-10-12T15:00:00+03:00", NOON),
        ("2025-10-12 12:00:00", NOON),
        ('{"$date": "2025-10-12T12:00:00Z"}', NOON),
        ("Sun, 12 Oct 2025 15:00:00 +0300", NOON),
        ("12 Oct 2025 12:00 GMT", NOON),
        ("October 12, 2025 12:00", NOON),
        ("Publié le 12 octobre 2025 à 12:00", NOON),
        ("1er août 2025", dt.datetime(2025, 8, 1)),
        ("[12:00, 10/12/2025] X:", NOON),
        ("13/10/2025", dt.datetime(2025, 10, 13)),
        ("10/12/2025 12:00 pm", NOON),
        ("31/02/2025", None),
        ("hier", None),
        ("10:32", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_mixed_date(spark, raw, expected):
    got = values(spark, [raw], lambda c: F.date_format(D.parse_mixed_date(c), "yyyy-MM-dd HH:mm"))[0]
    assert got == (expected and expected.strftime("%Y-%m-%d %H:%M"))


def test_day_first(spark):
    got = values(spark, ["12/10/2025"], lambda c: F.date_format(D.parse_mixed_date(c, True), "MM-dd"))
    assert got == ["10-12"]


def test_iso_text(spark):
    samples = ["2025-10-12 12:00:00", "2025-10-12 12:00:00.25", None]
    assert values(spark, samples, lambda c: D.iso_text(c.cast("timestamp"))) == [
        "2025-10-12T12:00:00+00:00", "2025-10-12T12:00:00.250000+00:00", None,
    ]


def test_character_data_is_text(spark):
    samples = ["<p>a<![CDATA[ b < c ]]>d</p>", "<![CDATA[open", "<!DOCTYPE html><p>x</p>", "<script><![CDATA[no]]></script>y"]
    got = values(spark, samples, lambda c: H.plain_text(c, " "))
    assert [" ".join(g.split()) for g in got] == ["a b < c d", "open", "x", "y"]


def test_strip_by_a_list_takes_what_the_class_does(spark):
    texts = ["".join((chr(c), "a ", chr(c), "b", chr(c))) for c in [*range(1, 0x3100), 0xFEFF, 0x1F600] if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(s,) for s in texts], "c string")
    wanted = F.regexp_replace("c", rf"^{T.SPACE}+|{T.SPACE}+\z", "")
    assert df.where(T.strip(F.col("c")) != wanted).count() == 0
    # Only the ends of a text are read.
    assert "regexp" not in df.select(T.strip(F.col("c")))._jdf.queryExecution().optimizedPlan().toString()


def test_usual_letters_are_settled_before_the_long_class(spark):
    df = spark.range(1, 0xFFFF).where("id < 55296 OR id > 57343").select(F.concat(F.lit("aé"), F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")).alias("c"))
    wanted = F.col("c").rlike(rf"(?=[^\x00-\x7F])[^{H._stable_class()}]")
    assert df.where(F.col("c").rlike(H._UNSTABLE) != wanted).count() == 0
    assert H._UNSTABLE.count("&&") == 2


def test_markup_patterns_begin_with_the_bracket():
    assert H.HIDDEN.removeprefix("(?is)")[0] == "<" and H.HIDDEN.count("|<") == 0 and H.TAG.count("|<") == 0

"""Mixing, toxicity, languages, URL rules."""

import pytest
from pyspark.sql import functions as F

from newsloom.llm import langid, mixing, toxicity, url_rules

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def larger(spark):
    return lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")


def test_raked_shares_are_the_targets(make_docs):
    docs = [(k, "word " * (10 + k % 7), "en" if k % 3 else "fr", f"s{k % 4 if k % 5 else 0}") for k in range(2000)]
    targets = {
        "source": {"s0": 0.1, "s1": 0.2, "s2": 0.3, "s3": 0.4},
        "lang": {"en": 0.4, "fr": 0.6},
        "topic": {"general": 1.0},
    }
    rows = mixing.mixed(make_docs(*docs), targets, budget=0.3).toPandas()
    for margin, wanted in targets.items():
        cells = rows.drop_duplicates(["source", "lang", "topic"])
        shares = cells.groupby(margin)["weight"].sum()
        for value, share in wanted.items():
            assert abs(shares[value] - share) < 1e-3
    expected = (rows.n_tokens * rows.chance).sum()
    assert abs(expected - 0.3 * rows.n_tokens.sum()) < 1e-3 * rows.n_tokens.sum()
    drawn = rows[rows.sampled].n_tokens.sum()
    assert abs(drawn - expected) < 0.1 * expected
    assert mixing.sampled_documents(make_docs(*docs), targets, budget=0.3).count() == rows.sampled.sum()


def test_chances_stay_below_one_and_meet_the_budget(make_docs):
    docs = [(k, "a b c", "en", "rare" if k < 10 else "often") for k in range(1000)]
    rows = mixing.mixed(make_docs(*docs), {"source": {"rare": 0.9, "often": 0.1}}, budget=0.5).toPandas()
    assert (rows[rows.source == "rare"].chance == 1).all()
    assert abs((rows.n_tokens * rows.chance).sum() - 1500) < 1


def test_topics_are_the_most_marked(spark):
    texts = [("software licensed license",), ("software and licensed",), ("softwares",), (None,)]
    rows = spark.createDataFrame(texts, "text string").select(mixing.topic_of(F.col("text")).alias("t")).collect()
    assert [r["t"] for r in rows] == ["legal", "legal", "general", "general"]


def test_mixing_odd_documents(odd_docs, no_docs):
    rows = mixing.mixed(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(0 <= (r["chance"] or 0) <= 1 for r in rows)
    drawn = mixing.sampled_documents(odd_docs)
    assert drawn.columns[: len(odd_docs.columns)] == odd_docs.columns
    assert mixing.mixed(no_docs).count() == 0 and mixing.sampled_documents(no_docs).count() == 0


def test_folding_meets_disguised_words():
    for text in ("Idiot", "1d10t", "\u0456di\u043et", "\u00eddi\u00f6t", "id\u200biot", "\uff49\uff44\uff49\uff4f\uff54", "IDIOT!!"):
        assert toxicity.folded(toxicity.plain(text)) == "idiot", text
    assert toxicity.folded(toxicity.plain("10 words, 2024!")) == "10 words 2024"


def test_lexicon_matches_words_beginnings_and_exceptions():
    lexicon = toxicity.Lexicon({" idio": 5.0, " trash ": 5.0}, 1.0)
    assert lexicon.score("you idiot") > 0.5 and lexicon.score("idiotic people") > 0.5
    assert lexicon.score("trash") > 0.5 and lexicon.score("trashy") == 0.0
    assert lexicon.score("put it in the trash can") == 0.0
    assert lexicon.score("the trash can, you trash") > 0.0
    assert lexicon.score(None) == lexicon.score("") == lexicon.score("fidio") == 0.0
    assert toxicity.Lexicon({}, 1.0).score("idiot") == 0.0


def test_toxicity_of_documents_held_out(larger):
    rows = toxicity.judged(larger("documents"), larger("labels")).join(larger("labels"), "doc_id").where("held_out")
    right = rows.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("r")).first()["r"]
    assert right >= 0.93


def test_toxicity_of_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(6, 1, 1), (6, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.judged(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(r["score"] == 0.0 and r["predicted"] == 0 for r in rows)
    assert toxicity.judged(no_docs, labels).count() == 0


def test_language_of_documents_held_out(larger):
    rows = langid.identified(larger("documents")).join(larger("documents"), "doc_id").where("held_out")
    right = rows.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")).alias("r")).first()["r"]
    assert right >= 0.97


def test_language_of_odd_documents(odd_docs, no_docs, make_docs):
    rows = langid.identified(odd_docs).collect()
    assert {r["lang_pred"] for r in rows} == {"und"} and len(rows) == odd_docs.count()
    assert langid.identified(no_docs).count() == 0
    model = {"b": b"the cat sat on the mat and the dog", "a": "le chat est sur le tapis et le chien".encode()}
    docs = make_docs((1, None), (2, "12 34 !"), (3, "the dog and the cat sat on the mat"), (4, "le chien est sur le tapis et le chat"), (5, "q"))
    found = {r["doc_id"]: r for r in langid.predicted(docs, model).collect()}
    assert [found[k]["lang_pred"] for k in (1, 2, 3, 4, 5)] == ["und", "und", "b", "a", "b"]
    assert found[1]["score"] == 0.0 and found[5]["rejected"] and not found[3]["rejected"]


URLS = {
    1: ("http://a.net/x?y", "a.net", "/x", "net/", "block"),
    2: ("https://EXAMPLE.net/en/1", "example.net", "/en/1", "example.net/en/", "allow"),
    3: ("https://www.example.net/en", "www.example.net", "/en", "net/", "block"),
    4: ("ftp://m.example.com/de/?q", "m.example.com", "/de/", "example.com/de/", "block"),
    5: ("http://badexample.com/de/", "badexample.com", "/de/", None, "allow"),
    6: ("http://x.org/fr/a#b", "x.org", "/fr/a", "org/fr/", "allow"),
    7: ("http://org/fr/", "org", "/fr/", "org/fr/", "allow"),
    8: ("http://a.net", "a.net", "", None, "allow"),
    9: ("http://a.net:80/", "a.net:80", "/", None, "allow"),
    10: ("nothing", "", "", None, "allow"),
    11: (None, "", "", None, "allow"),
    12: ("x://É.NET/a://b.org/fr/", "É.net", "/a://b.org/fr/", "net/", "block"),
    13: ("http://?a", "", "", None, "allow"),
}


def test_fixed_rules(spark):
    pages = spark.createDataFrame([(k, v[0], "h") for k, v in URLS.items()], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = url_rules.judged(pages, labels).collect()
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows} == {k: v[1:] for k, v in URLS.items()}
    assert url_rules.judged(pages.limit(0), labels).count() == 0


def test_mined_rules_block_what_bad_pages_share(spark):
    urls = [(k, f"http://{'spam' if k % 5 == 0 else 'fine'}.h{k % 3}.com/{'win' if k % 10 == 0 else 'news'}/{k}") for k in range(600)]
    pages = spark.createDataFrame([*urls, (None, "http://spam.other.com/win/1"), (577, "http://spam.other.com/win/1")], "page_id long, url string")
    marks = [(k, int(k % 10 > 0), 0) for k in range(0, 400)] + [(0, 1, 0), (None, 0, 0), (3, None, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    rows = [r for r in url_rules.judged(pages, labels).collect()]
    assert len(rows) == 602
    assert all((r["verdict"] == "block") == ("/win/" in r["path"]) for r in rows)
    assert {r["mined_rule"] for r in rows} == {None, "path=win"}

"""Phrases by the index of their grams, against a search of each phrase."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from newsloom.operators import phrase_words as W
from newsloom.operators import phrases as X


def plainly(texts, phrases):
    return sorted((k, p) for k, t in texts for p in set(phrases) if p and t is not None and p in t)


@pytest.mark.parametrize("block", [100_000, 7])
def test_random_phrases(spark, block):
    dice = random.Random(block)
    words = ["".join(dice.choice("abcdé") for _ in range(dice.randint(1, 9))) for _ in range(60)]
    texts = [(k, " ".join(dice.choice(words) for _ in range(dice.randint(0, 40)))) for k in range(80)] + [(80, None), (81, "")]
    phrases = ["", "a", "b c", "é a"]
    for _ in range(120):
        whole = " ".join(dice.choice(words) for _ in range(dice.randint(1, 4)))
        start = dice.randint(0, len(whole) - 1)
        phrases.append(whole[start : start + dice.randint(1, 14)].strip())
    rows = spark.createDataFrame(texts, "k int, t string")
    index = X.phrase_index(spark.createDataFrame([(p,) for p in phrases + phrases[:5]], "phrase string"))
    found = X.phrases_in(rows, "t", index, block).collect()
    assert sorted((r.k, r.phrase) for r in found) == plainly(texts, phrases)
    found = X.phrases_in(rows, "t", index, block, automata=True).collect()
    assert sorted((r.k, r.phrase) for r in found) == plainly(texts, phrases)
    assert X.phrases_in(rows, "t", index.limit(0), block, automata=True).count() == 0


def test_phrases_that_look_alike_cost_what_is_found(spark):
    """Ten thousand phrases around the same few grams, in texts of those grams that hold a few of the phrases."""
    phrases = spark.range(10_000).select(F.concat(F.lit("ation ment"), F.col("id").cast("string"), F.lit("x")).alias("phrase"))
    texts = spark.range(50).select("id", F.concat(F.lit("station mention ation ment"), F.col("id").cast("string"), F.lit("x ation ment")).alias("t"))
    found = X.phrases_in(texts, "t", X.phrase_index(phrases), automata=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 0
    assert sorted((r.id, r.phrase) for r in found.collect()) == [(k, f"ation ment{k}x") for k in range(50)]


def test_an_anchor_is_inside_a_word(spark):
    phrases = ["climat social", "a b", "b", "ab cde", "zzzz climat"]
    index = {r.phrase: (r.gram, r.width) for r in X.phrase_index(spark.createDataFrame([(p,) for p in phrases], "phrase string")).collect()}
    assert set(index) == set(phrases)
    for phrase, (gram, width) in index.items():
        assert " " not in gram and gram in phrase and len(gram) == width == min(X.GRAM, max(map(len, phrase.split())))
    assert index["zzzz climat"][0] != "clim" and index["climat social"][0] not in ("clim", "lima", "imat")


def test_entries_that_are_equal_count_each(spark):
    phrases = spark.createDataFrame([("x", "ab"), ("x", "ab"), ("y", "ab"), ("y", "zz")], "categorie string, phrase string")
    texts = spark.createDataFrame([(1, "cab"), (2, "zz ab"), (3, "q")], "k int, t string")
    rows = X.category_hits(texts, "t", phrases, "categorie").collect()
    assert sorted((r.k, r.categorie, r.hits) for r in rows) == [(1, "x", 2), (1, "y", 1), (2, "x", 2), (2, "y", 2)]
    assert X.category_hits(texts, "t", phrases.limit(0), "categorie").count() == 0


def test_a_hundred_thousand_phrases_without_python(spark):
    word = F.concat_ws("", *[F.element_at(F.array(*[F.lit(s) for s in "ba be do fu gi ka lo mi nu pe".split()]), (F.floor(F.col("id") / 10**k) % 10 + 1).cast("int")) for k in range(5)])
    phrases = spark.range(100_000).select(word.alias("phrase"))
    texts = spark.range(300).select("id", F.concat_ws(" ", *[F.concat(F.lit("x"), F.element_at(F.array(*[F.lit(s) for s in "ba be do fu gi ka lo mi nu pe".split()]), ((F.col("id") + k) % 10 + 1).cast("int")), F.lit("dogikalomi")) for k in range(20)]).alias("t"))
    found = X.phrases_in(texts, "t", X.phrase_index(phrases))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    rows = {(r.id, r.phrase) for r in found.collect()}
    listed = {r.phrase for r in phrases.collect()}
    wanted = {(r.id, p) for r in texts.collect() for w in set(r.t.split()) for i in range(len(w)) if (p := w[i : i + 10]) in listed}
    assert rows == wanted and rows


def counted(texts, phrases):
    return {p: n for p in set(phrases) if p and (n := sum(t is not None and p in t for t in texts))}


@pytest.mark.parametrize("seed", range(12))
def test_counts_by_words(monkeypatch, seed):
    """Phrases of one to four parts, blanks at their ends and in a row, in texts alike."""
    dice = random.Random(seed)
    for name, values in [("DENSE", (1, 4096)), ("TEXT_BYTES", (20, 300, 1 << 20)), ("ENTRIES", (3, 50, 1 << 20))]:
        monkeypatch.setattr(W, name, dice.choice(values))

    def spoken(most):
        return " ".join("".join(dice.choice("abé漢") for _ in range(dice.randint(0, 4))) for _ in range(dice.randint(0, most)))

    texts = [spoken(12) for _ in range(60)] + [None, "", "a" * 50]
    phrases = {t[(k := dice.randrange(len(t))) : k + dice.randint(1, 15)] for t in texts if t for _ in range(3)}
    phrases = sorted(phrases | {spoken(4) for _ in range(40)} - {""})
    search = W.Search(W.Phrases(pa.array(phrases)))
    search.add(pa.array(texts[:25]))
    search.add(pa.array(texts[25:]))
    found = [(r["phrase"], r["n"]) for batch in search.found() for r in batch.to_pylist()]
    assert len(dict(found)) == len(found) and dict(found) == counted(texts, phrases)


@pytest.mark.parametrize("block", [None, 7])
def test_counted_phrases_add_up(spark, block):
    texts = [("a bc def",), ("xa bcd",), ("a bc def",), (None,), ("",), ("def",)]
    phrases = ["", "a bc", "a bc", "bc", "c d", "ef", "f", "a bc def", " bc", "zz", "e", "d", "def", "abc"]
    rows = spark.createDataFrame(texts, "t string").repartition(3)
    index = X.phrase_index(spark.createDataFrame([(p,) for p in phrases], "phrase string"))
    found = X.phrases_in(rows, "t", index, block, counted=True).groupBy("phrase").agg(F.sum("n").alias("n")).collect()
    assert {r.phrase: r.n for r in found} == counted([t for t, in texts], phrases)
    assert X.phrases_in(rows, "t", index.limit(0), block, counted=True).count() == 0


def test_more_phrases_are_no_more_passes(spark):
    """A quarter of a million phrases: the texts are read once, and what they hold is counted before it is rows."""
    phrases = spark.range(250_000).select(F.concat(F.lit("ation ment"), F.col("id").cast("string"), F.lit("x")).alias("phrase"))
    texts = spark.range(50).select(F.concat(F.lit("station mention ation ment"), F.col("id").cast("string"), F.lit("x ation ment")).alias("t"))
    found = X.phrases_in(texts.union(texts), "t", X.phrase_index(phrases), counted=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan and "Exchange" not in plan
    found = found.groupBy("phrase").agg(F.sum("n").alias("n")).collect()
    assert {r.phrase: r.n for r in found} == {f"ation ment{k}x": 2 for k in range(50)}


def test_openings_are_counted_where_they_are_found(spark, small):
    plan = entry.queries()["phrase_matches"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Generate" not in plan and "Python" not in plan

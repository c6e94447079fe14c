"""Models of any number of classes: blocks give what one matrix gives."""

import random

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.operators import categories as C
from newsloom.operators import language as G
from newsloom.operators import sentiment as S
from newsloom.plans.enrich import enrich_articles

LANGUAGES = 500


@pytest.fixture(scope="module")
def training():
    dice = random.Random(3)
    rows = []
    for k in range(LANGUAGES):
        letters = dice.sample("abcdefghijklmnopqrstuvwxyz", 7)
        rows.append((f"l{k:03d}", " ".join("".join(dice.choice(letters) for _ in range(dice.randint(2, 7))) for _ in range(40))))
    return rows


@pytest.fixture(scope="module")
def profiles(spark, training):
    return G.train_language_profiles(spark.createDataFrame(training, "l string, t string"), "t", "l").cache()


def test_five_hundred_languages(spark, training, profiles):
    blocks = G.language_weights(profiles)
    assert isinstance(blocks, DataFrame) and blocks.count() == 4
    names, matrix = G.language_weights(profiles, at_once=LANGUAGES)
    assert len(names) == LANGUAGES and matrix.shape == (G.GRAMS, LANGUAGES)
    texts = [(k, t[:60]) for k, (_, t) in enumerate(training)] + [(500, None), (501, "12 ??"), (502, "")]
    rows = spark.createDataFrame(texts, "k int, t string").withColumn("n", T.normalize_text(F.col("t")))
    got = sorted(G.detect_in_blocks(rows, F.col("n"), blocks, "found").collect(), key=lambda r: r.k)
    best = G.language_of((names, matrix))
    assert [r.found for r in got] == [best(r.n) for r in got]
    assert sum(r.found == f"l{k:03d}" for k, r in enumerate(got[:LANGUAGES])) > 0.9 * LANGUAGES
    assert [r.found for r in got[LANGUAGES:]] == [None, None, None]


def test_the_first_name_wins_a_tie(spark):
    same = [("b", "abc abc"), ("a", "abc abc"), ("c", "abc abc")]
    profiles = G.train_language_profiles(spark.createDataFrame(same, "l string, t string"), "t", "l")
    rows = spark.createDataFrame([("abc",)], "t string")
    for at_once in (1, 2):
        assert G.detect_in_blocks(rows, F.col("t"), G.language_blocks(profiles, at_once), "x").first().x == "a"


@pytest.mark.parametrize("neutral", [None, "1"])
def test_confidence_over_blocks(spark, neutral):
    rows = [("bravo magnifique succes", "2"), ("triste echec mauvais", "0"), ("moyen normal banal", "1")]
    profiles = G.train_language_profiles(spark.createDataFrame(rows, "t string, l string"), "t", "l")
    score = S.sentiment_of(G.language_weights(profiles), neutral=neutral)
    texts = spark.createDataFrame([("bravo succes",), ("triste",), ("banal",), ("magnifique echec",), (None,), ("1",)], "t string").coalesce(1)
    got = S.score_in_blocks(texts, F.col("t"), G.language_blocks(profiles, 1), "x", neutral=neutral).collect()
    assert [round(r.x, 9) for r in got] == [round(score(r.t), 9) for r in got]


def test_enrichment_by_blocks_is_enrichment_by_matrix(spark):
    rows = [("le chat est sur la table et il dort", "fr"), ("the cat is on the table and it sleeps", "en")]
    languages = G.train_language_profiles(spark.createDataFrame(rows, "t string, l string"), "t", "l")
    classes = G.train_language_profiles(spark.createDataFrame([("bravo le chat", "1"), ("triste la table", "0")], "t string, l string"), "t", "l")
    texts = ["le chat est triste sur la table", "the cat is on the table", "bravo le chat dort et il est sur la table", "x"]
    df = spark.createDataFrame([("un titre assez long", t * 3, "http://a.org") for t in texts], "titre string, contenu string, source string")
    want = enrich_articles(df, G.language_weights(languages), G.language_weights(classes)).collect()
    got = enrich_articles(df, G.language_blocks(languages, 1), G.language_blocks(classes, 1)).collect()
    flat = lambda rows: sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in rows)
    assert flat(got) == flat(want) and {r.langue for r in got} == {"fr", "mg"}


def test_fifty_thousand_centroids(spark):
    dim, n = 12, 50_000
    part = lambda k: (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(2001)) - 1000) / 1000.0
    means = spark.range(n).select(F.format_string("c%06d", "id").alias("label"), F.array(*[part(k) for k in range(dim)]).alias("v"))
    blocks = C.centroid_blocks(means, "label", "v", block_bytes=12 * 8 * 6_000)
    sizes = [(len(r["names"]), r["names"][0]) for r in blocks.orderBy("at").collect()]
    assert len(sizes) > 8 and max(s for s, _ in sizes) <= 6_000 and sorted(sizes, key=lambda s: s[1]) == sizes
    rows = spark.range(300).select("id", F.array(*[part(100 + k) for k in range(dim)]).alias("v"))
    rows = rows.union(spark.createDataFrame([(300, [0.0] * dim), (301, None)], "id long, v array<double>"))
    got = {r["id"]: (r.similarity, r.categorie) for r in C.nearest_category(rows, "v", blocks, threshold=0.5).collect()}
    listed = means.orderBy("label").toPandas()
    matrix = np.stack(listed["v"].to_numpy())
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    for row in rows.limit(300).collect():
        cosines = matrix @ (np.array(row.v) / np.linalg.norm(row.v))
        best = int(cosines.argmax())
        assert got[row["id"]][1] == listed["label"][best] and abs(got[row["id"]][0] - cosines[best]) < 1e-9
    assert got[300] == (0.0, "autre") and got[301] == (None, "autre")

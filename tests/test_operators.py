"""Operators on small tables: thresholds, ties, nulls and repeats."""

import pytest
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.functions import text as T
from newsloom.operators import categories as C
from newsloom.operators import keys as K
from newsloom.operators import language as G
from newsloom.operators import lexicon as L
from newsloom.operators import origin as O
from newsloom.operators import quality as Q
from newsloom.operators import repair as R
from newsloom.operators import sentiment as S
from newsloom.plans import enrich as E
from newsloom.plans import ingest as N
from newsloom.plans import publish as P
from newsloom.plans import reports

FILLER = "mot " * 12


def test_fixed_lists():
    assert len(set(fixed.MALAGASY_WORDS)) == 108
    assert len(set(fixed.POSITIVE_WORDS)) == 34 and len(set(fixed.NEGATIVE_WORDS)) == 31
    table = L.phrase_table()
    assert len(table) == 12 and sum(len(p) for _, p in table) == 242


def test_quality_gate_edges(spark):
    rows = [
        (1, "abcde", "x" * 30), (2, " abcd ", "x" * 30), (3, "abcde", " " + "x" * 29 + " "),
        (4, None, "x" * 30), (5, "abcde", None), (6, "", "x" * 30), (7, "  abcde\n", "x" * 31),
    ]
    df = spark.createDataFrame(rows, "i int, titre string, contenu string")
    assert [r.i for r in Q.quality_gate(df).orderBy("i").collect()] == [1, 7]


def test_short_and_long_leave_nulls_out(spark):
    df = spark.createDataFrame([("x" * 29,), ("x" * 30,), (None,)], "contenu string")
    assert (Q.short_content(df).count(), Q.long_content(df).count()) == (1, 1)


def test_counts_and_censuses(spark):
    df = spark.createDataFrame([("a", 1, ["x"]), ("", None, []), (None, 2, None), (" ", 3, ["y"])], "s string, n int, l array<string>")
    assert {r[0]: r[1] for r in Q.null_counts(df).collect()} == {"s": 1, "n": 1, "l": 1}
    assert {r[0]: r[1] for r in Q.blank_counts(df).collect()} == {"s": 3, "n": 1, "l": 2}
    bodies = [('{"d": "x"}',), ('{"d": 1}',), ('{"d": {"$date": "x"}}',), ("{}",), ('{"d": null}',)]
    census = Q.type_census(spark.createDataFrame(bodies, "b string"), "b", "d")
    assert {r[0]: r[1] for r in census.collect()} == {"STRING": 1, "BIGINT": 1, "OBJECT": 1, "MISSING": 1, "VOID": 1}


def test_mask_and_unmask(spark):
    df = spark.createDataFrame(
        [("a", ["x", "y"]), (" ", []), (None, None), ("VIDE", ["z"])], "titre string, l array<string>"
    )
    masked = R.mask_blanks(df)
    assert [tuple(r) for r in masked.collect()] == [("a", "x, y"), ("VIDE", "VIDE"), ("VIDE", "VIDE"), ("VIDE", "z")]
    assert [r.titre for r in R.unmask_blanks(masked, ["titre"]).collect()] == ["a", None, None, None]
    assert Q.rows_with_value(masked).count() == 3


def test_source_type_rules(spark):
    samples = [
        ("https://newsmada.com/feed/x", None), (" Malagasy News 2", ""), ("via Orange Actu", None),
        ("other", None), (None, None), ("https://newsmada.com/feed/", "kept"),
    ]
    df = spark.createDataFrame(samples, "source string, source_type string")
    assert [r.source_type for r in R.assign_source_type(df).collect()] == [
        "rss", "scrap_html", "scrap_selenium", "inconnu", "inconnu", "kept",
    ]


def test_strict_timestamps_raise(spark):
    df = spark.createDataFrame([("2025-01-01",), ("nope",)], "d string")
    assert R.coerce_timestamp(df, "d").where("d is null").count() == 1
    with pytest.raises(Exception, match="not a timestamp"):
        R.coerce_timestamp(df, "d", strict=True).collect()


def test_categories_as_list(spark):
    df = spark.createDataFrame([(["a", None],), ([],), (None,)], "l array<string>")
    assert [r[0] for r in df.select(R.categories_as_list(F.col("l"), "array<string>")).collect()] == [["a"], [], []]
    df = spark.createDataFrame([("a",), ("",), (None,)], "l string")
    assert [r[0] for r in df.select(R.categories_as_list(F.col("l"), "string")).collect()] == [["a"], [], []]


def test_keys(spark):
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "id_article string, n int")
    known = spark.createDataFrame([("b",), ("b",), (None,)], "id_article string")
    assert sorted(r.n for r in K.new_only(batch, known).collect()) == [1, 2, 4]
    assert sorted(r.n for r in K.known_only(batch, known).collect()) == [3]
    assert sorted(r.n for r in K.keep_first(batch.where("n < 4"), "id_article", F.desc("n")).collect()) == [2, 3]
    updates = spark.createDataFrame([("a", None)], "id_article string, n int")
    updated = K.keyed_update(batch, updates, "id_article", ["n"])
    assert sorted((r.n for r in updated.collect()), key=str) == [3, 4, None, None]
    twice = spark.createDataFrame([("a", 7, 1), ("a", 9, 3), ("a", 8, 2), ("b", None, 1), (None, 0, 1)], "id_article string, n int, at int")
    updated = K.keyed_update(batch, twice, "id_article", ["n"], "at")
    assert sorted((r.n for r in updated.collect()), key=str) == [4, 9, 9, None]
    with pytest.raises(Exception, match="more than one update of a"):
        K.keyed_update(batch, twice, "id_article", ["n"]).collect()
    assert K.delete_where(batch, F.col("id_article") == "a").count() == 2


def test_run_counters_add_up(spark):
    good = "x" * 30
    batch = spark.createDataFrame(
        [("a", "titre", good), ("b", "titre", good), ("b", "t", good), ("c", "t", good), ("", "titre", good), (None, "titre", good), ("a", "titre", good)],
        "id_article string, titre string, contenu string",
    )
    known = spark.createDataFrame([("b",)], "id_article string")
    counts = {r.status: r.n for r in K.run_counters(batch, known).collect()}
    assert counts == {"added": 2, "existing": 2, "skipped": 3}


def test_origin(spark):
    samples = [("https://www.lexpress.mg/x",), ("http://other.org/",), ("Orange Actu",), ("Autre",), (None,)]
    df = spark.createDataFrame(samples, "source string")
    expected = ["L’Express", "other.org", "Orange Actu", "Autre", None]
    assert [r[0] for r in df.select(O.origin_of(F.col("source"))).collect()] == expected
    names = spark.createDataFrame(list(fixed.ORIGIN_NAMES.items()), "domain string, origin string")
    joined = {r.source: r.origin for r in O.with_origin(df, names).collect()}
    assert joined == dict(zip((s[0] for s in samples), expected))
    assert O.with_origin(df, names.union(names.limit(1))).count() == len(samples)


def category(spark, text, **options):
    df = spark.createDataFrame([(text,)], "t string").select(T.normalize_text(F.col("t")).alias("n"))
    return df.select(C.categorize(F.col("n"), **options)).first()[0]


def test_categories(spark):
    assert category(spark, "onu onu onu") == ["autre"]  # too few words
    assert category(spark, FILLER + "sonum") == ["international"]  # inside a word
    assert category(spark, FILLER + "hôpitaly") == ["santé"]
    assert category(spark, FILLER + "trafic") == ["justice", "transport"]  # in two categories
    # 3 of 4 hits stay (0.75), 2 of 4 go (0.5); the order is the declared one.
    phrases = {"a": ["p1", "p2", "p3"], "b": ["q1", "q2", "q3", "q4"], "c": ["r1", "r2"]}
    assert category(spark, FILLER + "p1 p2 p3 q1 q2 q3 q4 r1 r2", phrases=phrases) == ["a", "b"]
    four = {k: [k * 3] for k in "zyxw"}
    assert category(spark, FILLER + "zzz yyy xxx www", phrases=four) == ["z", "y", "x"]


def test_nearest_description(spark):
    near = {"a": ["@"]}
    assert category(spark, "climat climat pollution ville ville mer", phrases=near) == ["environnement"]
    # One shared word among many: the cosine is below the threshold.
    far = " ".join(f"w{i}" for i in range(40)) + " climat"
    assert category(spark, far, phrases=near) == ["autre"]
    assert category(spark, "un deux trois quatre cinq six", phrases={"a": ["zzz"]}) == ["autre"]


def test_phrase_search_without_the_automaton(monkeypatch):
    phrases = ["ab", "abc", "c d", "zz"]
    texts = ["abc d", "xxabx", "", "c  d"]
    fast = [L.phrase_search(phrases)(t) for t in texts]
    monkeypatch.setitem(__import__("sys").modules, "ahocorasick", None)
    assert fast == [L.phrase_search(phrases)(t) for t in texts] == [["ab", "abc", "c d"], ["ab"], [], []]


def test_language_by_word_list(spark):
    def language(text, **options):
        df = spark.createDataFrame([(text,)], "t string")
        words = T.words(T.normalize_text(F.col("t")))
        return df.select(G.detect_language(F.col("t"), words, unlisted="?", **options)).first()[0]

    assert language("fa ") == "fr" and language(None) == "fr" and language("?! ...") == "fr"
    assert language("vaovao " * 3 + "mot " * 17) == "mg"  # 0.15
    assert language("vaovao " * 3 + "mot " * 18) == "?"


def test_settled_language(spark):
    rows = [("?", "fr"), ("?", "en"), ("?", None), ("mg", "fr"), ("fr", "en")]
    df = spark.createDataFrame(rows, "l string, d string")
    got = [r[0] for r in df.select(G.settled_language(F.col("l"), F.col("d"))).collect()]
    assert got == ["fr", "mg", "fr", "mg", "fr"]


def test_detector_and_profiles(spark):
    rows = [("le chat est sur la table et il dort", "fr"), ("the cat is on the table and it sleeps", "en")]
    profiles = G.train_language_profiles(spark.createDataFrame(rows, "t string, l string"), "t", "l")
    assert profiles.where("gram = ' th' and lang = 'en'").first().n == 2
    detect = G.ngram_detector(G.language_weights(profiles, 2))
    texts = spark.createDataFrame([("la table et le chat",), ("the table and the cat",), ("123 ??",), (None,)], "t string")
    got = [r[0] for r in texts.select(detect(F.col("t"))).collect()]
    assert got == ["fr", "en", None, None]


def test_sentiment(spark):
    words = [["tsara", "tsara", "ratsy"], ["ratsy"], ["tsara", "ratsy"], ["x"], []]
    df = spark.createDataFrame([(w,) for w in words], "w array<string>")
    assert [r[0] for r in df.select(S.lexicon_score(F.col("w"))).collect()] == [pytest.approx(1 / 3), -1.0, 0.0, 0.0, 0.0]
    scores = spark.createDataFrame([(0.2,), (0.21,), (-0.2,), (-0.21,), (None,)], "s double")
    assert [r[0] for r in scores.select(S.sentiment_label(F.col("s"))).collect()] == [
        "neutre", "positif", "neutre", "negatif", None,
    ]


def test_sentiment_model_beats_the_majority(spark):
    good, bad = "bravo magnifique succès", "triste échec colère"
    rows = [(f"{good} numéro {i}", 1) for i in range(30)] + [(f"{bad} numéro {i}", 0) for i in range(20)]
    df = spark.createDataFrame(rows, "t string, y int")
    model = G.language_weights(G.train_language_profiles(df.withColumn("y", F.col("y").cast("string")), "t", "y"), 2)
    scored = df.withColumn("score", S.model_sentiment(T.normalize_text(F.col("t")), model))
    assert scored.where((F.col("score") > 0) == (F.col("y") == 1)).count() == 50
    assert scored.where(F.abs("score") > 0.5).count() == 50
    score = S.sentiment_of(model)
    assert [score(" "), score(None), score("12")] == [0.0, 0.0, 0.0]
    # The whole text counts unless told otherwise.
    assert score("triste echec " + "bravo magnifique " * 50) > 0 > S.sentiment_of(model, chars=12)("triste echec " + "bravo magnifique " * 50)
    assert S.sentiment_of(model, neutral="1")("bravo magnifique") == 0.0


def test_nearest_category(spark):
    centroids = [("a", [1.0, 0.0]), ("b", [0.0, 2.0]), ("c", [0.0, 1.0])]
    df = spark.createDataFrame([(1, [2.0, 0.1]), (2, [0.0, 5.0]), (3, [0.0, 0.0]), (4, [-1.0, -1.0])], "i int, v array<double>")
    got = {r.i: r.categorie for r in C.nearest_category(df, "v", centroids).collect()}
    assert got == {1: "a", 2: "b", 3: "autre", 4: "autre"}


def test_enrichment_with_everything(spark):
    french = "Le gouvernement et le président parlent de la réforme dans la ville"
    malagasy = "Ny vaovao tsara dia izany no ataon ny firenena sy ny vahoaka tsara " * 2
    rows = [("a", "Titre un", french, "Orange Actu"), ("b", "Titre deux", malagasy, "https://www.newsmada.com/x"), ("c", "bad", french, None)]
    df = spark.createDataFrame(rows, "id string, titre string, contenu string, source string")
    training = spark.createDataFrame([(french, "fr"), ("the cat is on the table", "en")], "t string, l string")
    labelled = spark.createDataFrame([(french, "1"), ("autre texte de colère", "0")] * 5, "t string, y string")
    languages = G.language_weights(G.train_language_profiles(training, "t", "l"), 2)
    classes = G.language_weights(G.train_language_profiles(labelled, "t", "y"), 2)
    got = {r.id: r for r in E.enrich_articles(df, languages, classes).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"].langue, got["a"].categorie, got["a"].origin) == ("fr", ["politique"], "Orange Actu")
    assert got["a"].sentiment_score > 0.2 and got["a"].sentiment == "positif"
    assert (got["b"].langue, got["b"].sentiment_score, got["b"].origin) == ("mg", 1.0, "News Mada")
    renewed = E.reenrich(df, languages, classes)
    assert renewed.count() == 3 and renewed.where("id = 'c' and langue is null and contenu is not null").count() == 1
    assert renewed.where("id = 'a'").first().sentiment_score == got["a"].sentiment_score
    old = df.withColumns({"langue": F.lit("xx"), "categorie": F.array(F.lit("old"))})
    kept = E.reenrich(old, languages, classes).where("id = 'c'").first()
    assert (kept.langue, kept.categorie, kept.sentiment) == ("xx", ["old"], None)


def test_new_articles_and_second_run(spark, tmp_path):
    text = "un texte assez long pour passer la porte de qualité"
    rows = [("a", "titre un", text, "s"), ("a", "titre deux", text, "s"), ("b", "titre", text, "s"), ("", "titre", text, "s"), ("c", "t", text, "s")]
    df = spark.createDataFrame(rows, "id_article string, titre string, contenu string, source string")
    nothing = df.limit(0)
    assert sorted(r.titre for r in N.new_articles(df, nothing, F.desc("titre")).collect()) == ["titre", "titre un"]
    assert N.new_articles(df, nothing, keep_repeats=True).count() == 3
    path = str(tmp_path / "table")
    N.ingest(df, nothing, path)
    assert spark.read.parquet(path).count() == 2
    N.ingest(df, spark.read.parquet(path), path)
    assert spark.read.parquet(path).count() == 2


def test_published_rows(spark):
    df = spark.createDataFrame([(None, "NaN", "bad", "2025-01-01T00:00:00Z")], "titre string, sentiment_score string, created_at string, date_publication string")
    now = F.lit("2026-01-01").cast("timestamp")
    row = P.published_rows(df, now).first()
    assert (row.titre, row.url, row.sentiment_score, row.created_at, row.categorie) == ("", "", None, None, [])
    assert row.date_publication is not None
    assert P.published_rows(df, now, null_text="None").first().titre == "None"


def test_shares_and_crosstabs(spark):
    rows = [("a", "x"), ("a", "x"), ("a", "y"), ("b", None), (None, "x")]
    df = spark.createDataFrame(rows, "r string, c string")
    assert [tuple(r) for r in reports.value_counts(df, "r").collect()] == [("a", 3), ("b", 1)]
    assert sum(r.share for r in reports.value_shares(df, "r", 100.0).collect()) == pytest.approx(100)
    wide = reports.crosstab(df, "r", "c", ["x", "y", "z"])
    assert [tuple(r) for r in wide.collect()] == [("a", 2, 1, 0)]
    shares = reports.row_shares(reports.crosstab(df, "r", "c"), "r")
    assert shares.agg(F.sum("share")).first()[0] == pytest.approx(1)
    assert [r.pct for r in reports.segment_percent(reports.crosstab(df, "r", "c"), "r").orderBy("c").collect()] == [66.7, 33.3]


def test_daily_volume_fills_gaps(spark):
    rows = [("2025-01-01 10:00:00",), ("2025-01-03 23:59:59",), ("2025-01-09 00:00:00",), ("2024-12-31 00:00:00",), (None,)]
    df = spark.createDataFrame(rows, "t string").select(F.col("t").cast("timestamp").alias("t"))
    days = reports.daily_volume(df, "t", "2025-01-01", "2025-01-04").collect()
    assert [r.n for r in days] == [1, 0, 1, 0]
    # The denominator counts the row after the calendar's end.
    shares = reports.daily_share(df, "t", "2025-01-01", "2025-01-04").orderBy("day").collect()
    assert [r.share for r in shares] == pytest.approx([1 / 3, 0, 1 / 3, 0])


def test_origin_by_category_nulls_and_empties(spark):
    df = spark.createDataFrame([("s", None), ("s", []), ("s", ["a"]), (None, ["a"])], "origin string, categorie array<string>")
    got = {tuple(r) for r in reports.origin_by_category(df).collect()}
    assert got == {("s", "Autre", 1), ("s", "a", 1)}


def test_rows_are_numbered_in_order(spark):
    df = spark.range(0, 1000, 1, 7).select(((F.col("id") * 7919) % 1000).alias("v"))
    assert all(r.v == r.position for r in Q.numbered(df, "v").collect())
    assert sorted(r.v for r in Q.page_rows(df, 100, 50, F.desc("v")).collect()) == list(range(850, 900))
    assert Q.page_rows(df.limit(0), 0, 5, "v").count() == 0


def test_training_normalises_what_differs(spark):
    """Pieces between blanks are counted before they are normalised, with the same words in the end."""
    rows = [("Été d'ÉTÉ\nété  eté, ete", "fr"), ("Été\tΟΔΟΣ x1y", "fr"), (None, "fr"), ("", "de"), ("Éte 'été'", None)]
    df = spark.createDataFrame(rows, "t string, l string")
    profiles = G.train_language_profiles(df, "t", "l")
    plan = profiles._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("translate(") < plan.rindex("Aggregate")
    counts = {(r.lang, r.gram): r.n for r in profiles.collect()}
    assert counts[("fr", "ete")] == 6 and counts[("fr", " x ")] == 1 and counts[("fr", " d ")] == 1 and counts[(None, "ete")] == 2
    assert {lang for lang, _ in counts} == {"fr", None}

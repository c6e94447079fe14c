"""Language, sentiment, categories and the full enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsloom import fixed_values as fixed
from newsloom.catalog.registry import ORACLES, Tables, query
from newsloom.catalog.quality_queries import VALID, stripped
from newsloom.catalog.text_queries import DOMAIN, NAMES, PRODUCED, collapsed, normal, plain, produced
from newsloom.functions import text as T
from newsloom.functions.staging import with_once
from newsloom.operators import categories as C
from newsloom.operators import keys as K
from newsloom.operators import language as G
from newsloom.operators import lexicon as L
from newsloom.operators import phrases as X
from newsloom.operators import sentiment as S
from newsloom.plans import ingest as N
from newsloom.plans import models as M
from newsloom.plans import parts as Z
from newsloom.plans.enrich import enrich_articles as enrich
from newsloom.plans.enrich import reenrich as renew
from newsloom.session import scratch_path

# The documents are invented prose that hardly uses the default words, so every
# lookup also runs with lists of words that are frequent in it.
FREQUENT = ["de", "la", "le", "les", "que", "the", "and", "of", "der", "die"]
PRAISE = ["la", "the", "die", "en"]
COMPLAINT = ["of", "les", "der", "que"]
PHRASES = {
    "politique": ["tion", "the th", "of the"],
    "sport": ["and", "le "],
    "santé": ["Ère", "ere", "er ver", "on"],  # two entries that are equal once normalised
    "culture": ["ment", "que"],
}


def _values(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _listed(tokens: str, words) -> str:
    return f"len(list_filter({tokens}, lambda w: w IN ({_values(words)})))"


def _table(phrases) -> str:
    rows = [
        f"({place}, '{category}', '{phrase}')"
        for place, (category, listed) in enumerate(L.phrase_table(phrases))
        for phrase in listed
    ]
    return "(VALUES " + ", ".join(rows) + ") AS t(place, categorie, phrase)"


_WORDS = f"""
    SELECT doc_id, words, CASE WHEN words = '' THEN [] ELSE split(words, ' ') END AS ws
    FROM (SELECT doc_id, {normal('text')} AS words FROM documents)
"""


def normalized_of(tables: Tables) -> DataFrame:
    words = T.normalize_text(F.col("text"))
    return with_once(tables.table("documents").select("doc_id", "text"), {"words": words})


def words_of(tables: Tables) -> DataFrame:
    return with_once(normalized_of(tables), {"ws": T.words(F.col("words"))}).drop("words")


@query(
    f"""
    SELECT doc_id, {_listed('ws', fixed.MALAGASY_WORDS)} AS malagasy, {_listed('ws', fixed.POSITIVE_WORDS)} AS positive,
      {_listed('ws', fixed.NEGATIVE_WORDS)} AS negative, {_listed('ws', FREQUENT)} AS frequent, len(ws) AS words
    FROM ({_WORDS})
    """
)
def lexicon_hits(tables: Tables) -> DataFrame:
    ws = F.col("ws")
    return words_of(tables).select(
        "doc_id",
        L.lexicon_hits(ws, fixed.MALAGASY_WORDS).cast("long").alias("malagasy"),
        L.lexicon_hits(ws, fixed.POSITIVE_WORDS).cast("long").alias("positive"),
        L.lexicon_hits(ws, fixed.NEGATIVE_WORDS).cast("long").alias("negative"),
        L.lexicon_hits(ws, FREQUENT).cast("long").alias("frequent"),
        F.size("ws").cast("long").alias("words"),
    )


def _hits(phrases, name: str) -> str:
    return f"""
        SELECT doc_id, '{name}' AS phrases, categorie, count(*) AS hits
        FROM ({_WORDS}) JOIN {_table(phrases)} ON contains(words, phrase)
        GROUP BY doc_id, categorie
    """


@query(f"{_hits(None, 'default')} UNION ALL {_hits(PHRASES, 'corpus')}")
def keyword_hits(tables: Tables) -> DataFrame:
    names = {"default": L.phrase_table(), "corpus": L.phrase_table(PHRASES)}
    rows = [(name, category, phrase) for name, table in names.items() for category, listed in table for phrase in listed]
    phrases = tables.spark.createDataFrame(rows, "phrases string, categorie string, phrase string")
    return X.category_hits(normalized_of(tables).select("doc_id", "words"), "words", phrases, "phrases", "categorie")


_FRAGMENTS = f"""
    SELECT DISTINCT substr(ws[2], 2) || ' ' || ws[3] AS phrase FROM ({_WORDS}) WHERE len(ws) >= 3
    UNION SELECT DISTINCT ws[1] FROM ({_WORDS}) WHERE len(ws) >= 1
"""


@query(
    f"""
    SELECT phrase, count(*) AS n FROM ({_FRAGMENTS}) p JOIN ({_WORDS}) t ON contains(t.words, p.phrase)
    WHERE phrase <> '' GROUP BY phrase
    """
)
def phrase_matches(tables: Tables) -> DataFrame:
    """In how many documents each document's own opening words stand, inside words too."""
    texts = normalized_of(tables).select("doc_id", "words")
    place = scratch_path(tables.spark, "normalized")
    texts.write.parquet(place)  # they are read for their openings and searched
    texts = tables.spark.read.schema(texts.schema).parquet(place)
    first = with_once(texts, {"ws": F.filter(F.split("words", " ", 4), lambda w: w != "")})  # three words and the rest
    opening = F.concat(F.substring(F.col("ws")[1], 2, 1 << 30), F.lit(" "), F.col("ws")[2])
    opened = F.array(F.when(F.size("ws") >= 3, opening), F.when(F.size("ws") >= 1, F.col("ws")[0]))
    index = X.phrase_index(first.select(F.explode(opened).alias("phrase")))
    return X.phrases_in(texts, "words", index, counted=True).groupBy("phrase").agg(F.sum("n").alias("n"))


def _ranked(phrases) -> str:
    """Categories of a text by phrases: near the best, in order, three at most; null if none."""
    return f"""
        SELECT doc_id, string_agg(categorie, '|' ORDER BY place) AS named FROM (
          SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS rank FROM (
            SELECT doc_id, place, categorie, count(*) AS hits, max(count(*)) OVER (PARTITION BY doc_id) AS best
            FROM normed JOIN {_table(phrases)} ON contains(words, phrase)
            GROUP BY doc_id, place, categorie)
          WHERE hits >= best * CAST(0.7 AS DOUBLE))
        WHERE rank <= 3 GROUP BY doc_id
    """


def _described() -> str:
    """The closest description by cosine of word counts."""
    rows = [
        f"({place}, '{category}', '{word}')"
        for place, (category, text) in enumerate(fixed.CATEGORY_DESCRIPTIONS.items())
        for word in T.normalize_word(text).split()
    ]
    return f"""
        SELECT doc_id, arg_max(categorie, (score, -place)) AS nearest, max(score) AS score FROM (
          SELECT t.doc_id, d.place, d.categorie,
            sum(t.n * d.n) / (sqrt(any_value(t.squares)) * sqrt(any_value(d.squares))) AS score
          FROM (SELECT doc_id, word, n, sum(n * n) OVER (PARTITION BY doc_id) AS squares FROM (
              SELECT doc_id, word, count(*) AS n FROM (
                SELECT doc_id, unnest(split(words, ' ')) AS word FROM normed)
              WHERE word <> '' GROUP BY doc_id, word)) t
          JOIN (SELECT place, categorie, word, n, sum(n * n) OVER (PARTITION BY place) AS squares FROM (
              SELECT place, categorie, word, count(*) AS n FROM (VALUES {', '.join(rows)}) AS v(place, categorie, word)
              GROUP BY ALL)) d ON t.word = d.word
          GROUP BY t.doc_id, d.place, d.categorie) GROUP BY doc_id
    """


def _categories(phrases) -> str:
    return f"""
        SELECT n.doc_id, CASE WHEN n.words = '' OR len(split(n.words, ' ')) < 6 THEN 'autre'
          ELSE coalesce(r.named, CASE WHEN d.score >= 0.3 THEN d.nearest END, 'autre') END AS categorie
        FROM normed n LEFT JOIN ({_ranked(phrases)}) r ON n.doc_id = r.doc_id
        LEFT JOIN ({_described()}) d ON n.doc_id = d.doc_id
    """


@query(
    f"""
    WITH normed AS ({_WORDS})
    SELECT doc_id, 'default' AS phrases, categorie FROM ({_categories(None)})
    UNION ALL SELECT doc_id, 'corpus', categorie FROM ({_categories(PHRASES)})
    """
)
def categorize_keywords(tables: Tables) -> DataFrame:
    words = normalized_of(tables)
    named = words.select(
        "doc_id",
        F.array_join(C.categorize(F.col("words")), "|").alias("default"),
        F.array_join(C.categorize(F.col("words"), PHRASES), "|").alias("corpus"),
    )
    return named.unpivot(["doc_id"], ["default", "corpus"], "phrases", "categorie")


@query(
    f"""
    SELECT doc_id, 'default' AS lists, CASE WHEN length({stripped('text')}) < 5 OR len(ws) = 0 THEN 'fr'
        WHEN {_listed('ws', fixed.MALAGASY_WORDS)} / len(ws) >= CAST(0.15 AS DOUBLE) THEN 'mg' ELSE 'fr' END AS langue
    FROM ({_WORDS}) JOIN (SELECT doc_id AS d, text FROM documents) ON d = doc_id
    UNION ALL
    SELECT doc_id, 'corpus', CASE WHEN length({stripped('text')}) < 5 OR len(ws) = 0 THEN 'fr'
        WHEN {_listed('ws', FREQUENT)} / len(ws) >= CAST(0.15 AS DOUBLE) THEN 'mg' ELSE 'fr' END
    FROM ({_WORDS}) JOIN (SELECT doc_id AS d, text FROM documents) ON d = doc_id
    """
)
def detect_language_dict(tables: Tables) -> DataFrame:
    text, ws = F.col("text"), F.col("ws")
    languages = words_of(tables).select(
        "doc_id",
        G.detect_language(text, ws).alias("default"),
        G.detect_language(text, ws, words=FREQUENT).alias("corpus"),
    )
    return languages.unpivot(["doc_id"], ["default", "corpus"], "lists", "langue")


# Trigrams of blank-padded words, counted per language, as scaled log probabilities.
_GRAMS = f"""
    SELECT doc_id, lang, unnest(list_transform(range(1, length(p) - 1), lambda i: substr(p, i, 3))) AS gram
    FROM (SELECT doc_id, lang, concat(' ', unnest(split(letters, ' ')), ' ') AS p FROM (
      SELECT doc_id, lang, trim(regexp_replace({normal('text')}, '[^a-z]+', ' ', 'g')) AS letters FROM documents))
    WHERE p <> '  '
"""
_PROFILES = f"""
    SELECT lang, gram, n, CAST(round(ln((n + 1) / mass) * 10000) AS BIGINT) AS weight,
      CAST(round(ln(1 / mass) * 10000) AS BIGINT) AS unseen
    FROM (SELECT *, sum(n) OVER (PARTITION BY lang) + 19683 AS mass
      FROM (SELECT lang, gram, count(*) AS n FROM ({_GRAMS}) GROUP BY lang, gram))
"""


@query(_PROFILES)
def train_language_profiles(tables: Tables) -> DataFrame:
    return G.train_language_profiles(tables.table("documents"), "text", "lang")


_DETECTED = f"""
    SELECT doc_id, arg_max(lang, (score, -place)) AS detected FROM (
      SELECT g.doc_id, l.lang, l.place, sum(coalesce(p.weight, l.unseen) * g.n) AS score
      FROM (SELECT doc_id, gram, count(*) AS n FROM ({_GRAMS}) GROUP BY doc_id, gram) g
      CROSS JOIN (SELECT lang, min(unseen) AS unseen, row_number() OVER (ORDER BY lang) AS place
        FROM ({_PROFILES}) GROUP BY lang) l
      LEFT JOIN ({_PROFILES}) p ON p.lang = l.lang AND p.gram = g.gram
      GROUP BY g.doc_id, l.lang, l.place) GROUP BY doc_id
"""


@query(f"SELECT d.doc_id, x.detected FROM documents d LEFT JOIN ({_DETECTED}) x ON d.doc_id = x.doc_id")
def detect_language_ngram(tables: Tables) -> DataFrame:
    documents = tables.table("documents")
    detect = G.ngram_detector(M.language_model(tables.spark, documents, "text", "lang"))
    return documents.select("doc_id", detect(T.normalize_text(F.col("text"))).alias("detected"))


def _score(positive, negative) -> str:
    p, n = _listed("ws", positive), _listed("ws", negative)
    return f"CASE WHEN {p} + {n} = 0 THEN 0.0 ELSE CAST({p} - {n} AS DOUBLE) / ({p} + {n}) END"


_LABEL = "CASE WHEN score > 0.2 THEN 'positif' WHEN score < -0.2 THEN 'negatif' ELSE 'neutre' END"


@query(
    f"""
    SELECT doc_id, round({_score(fixed.POSITIVE_WORDS, fixed.NEGATIVE_WORDS)}, 6) AS score,
      round({_score(PRAISE, COMPLAINT)}, 6) AS corpus_score FROM ({_WORDS})
    """
)
def lexicon_sentiment_score(tables: Tables) -> DataFrame:
    ws = F.col("ws")
    return words_of(tables).select(
        "doc_id",
        F.round(S.lexicon_score(ws), 6).alias("score"),
        F.round(S.lexicon_score(ws, PRAISE, COMPLAINT), 6).alias("corpus_score"),
    )


@query(
    f"""
    SELECT doc_id, {_LABEL} AS sentiment FROM (SELECT doc_id, {_score(PRAISE, COMPLAINT)} AS score FROM ({_WORDS}))
    """
)
def sentiment_label(tables: Tables) -> DataFrame:
    score = S.lexicon_score(F.col("ws"), PRAISE, COMPLAINT)
    return words_of(tables).select("doc_id", S.sentiment_label(score).alias("sentiment"))


# The same trigrams and weights with the class of a labelled document as the label.
_CLASS_PROFILES = f"""
    SELECT class, gram, CAST(round(ln((n + 1) / mass) * 10000) AS BIGINT) AS weight,
      CAST(round(ln(1 / mass) * 10000) AS BIGINT) AS unseen
    FROM (SELECT *, sum(n) OVER (PARTITION BY class) + 19683 AS mass
      FROM (SELECT quality AS class, gram, count(*) AS n FROM ({_GRAMS}) g JOIN labels l ON l.doc_id = g.doc_id
            GROUP BY quality, gram))
"""
_CONFIDENCE = f"""
    SELECT doc_id, CASE WHEN bad >= good THEN -1 ELSE 1 END / (1 + exp(-abs(good - bad) / 10000)) AS model_score FROM (
      SELECT g.doc_id, sum(CASE WHEN c.class = 1 THEN coalesce(p.weight, c.unseen) * g.n ELSE 0 END) AS good,
        sum(CASE WHEN c.class = 0 THEN coalesce(p.weight, c.unseen) * g.n ELSE 0 END) AS bad
      FROM (SELECT doc_id, gram, count(*) AS n FROM ({_GRAMS}) GROUP BY doc_id, gram) g
      CROSS JOIN (SELECT class, min(unseen) AS unseen FROM ({_CLASS_PROFILES}) GROUP BY class) c
      LEFT JOIN ({_CLASS_PROFILES}) p ON p.class = c.class AND p.gram = g.gram
      GROUP BY g.doc_id)
"""


def sentiment_weights(tables: Tables):
    return M.sentiment_model(tables.spark, tables.table("documents"), tables.table("labels"), "doc_id", "text", "quality")


@query(
    f"""
    SELECT d.doc_id, round(coalesce(x.model_score, 0.0), 6) AS model_score
    FROM documents d LEFT JOIN ({_CONFIDENCE}) x ON d.doc_id = x.doc_id
    """
)
def model_sentiment(tables: Tables) -> DataFrame:
    score = S.model_sentiment(T.normalize_text(F.col("text")), sentiment_weights(tables))
    return tables.table("documents").select("doc_id", F.round(score, 6).alias("model_score"))


@query(
    """
    WITH means AS (SELECT label, list(mean ORDER BY pos) AS centroid FROM (
        SELECT label, pos, avg(x) AS mean FROM (
          SELECT label, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)
        GROUP BY label, pos) GROUP BY label)
    SELECT vec_id, round(similarity, 6) AS similarity, CASE WHEN similarity >= 0.3 THEN label ELSE 'autre' END AS categorie
    FROM (SELECT vec_id, max(cosine) AS similarity, CAST(arg_max(label, cosine) AS VARCHAR) AS label FROM (
        SELECT e.vec_id, m.label, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), m.centroid) AS cosine
        FROM embeddings e CROSS JOIN means m) GROUP BY vec_id)
    """
)
def nearest_category(tables: Tables) -> DataFrame:
    embeddings = tables.table("embeddings")
    means = C.class_means(embeddings, "label", "embedding")
    centroids = C.centroid_blocks(means, "label", "embedding")
    nearest = C.nearest_category(embeddings.select("vec_id", "embedding"), "embedding", centroids)
    return nearest.select("vec_id", F.round("similarity", 6).alias("similarity"), "categorie")


# --- the full enrichment --------------------------------------------------------------

_ENRICHMENT = dict(malagasy=FREQUENT, positive=PRAISE, negative=COMPLAINT, phrases=PHRASES, min_ratio=0.2)


def _enriched(rows: str, detected: str = _DETECTED, french: str = _CONFIDENCE) -> str:
    """Enrichment of ``doc_id, titre, contenu, source`` rows, with the corpus lists."""
    return f"""
        WITH valid AS (SELECT * FROM ({rows}) WHERE {VALID}),
        cleaned AS (SELECT doc_id, titre, source, {collapsed(plain('contenu', ' '))} AS contenu FROM valid),
        normed AS (SELECT *, CASE WHEN words = '' THEN [] ELSE split(words, ' ') END AS ws
          FROM (SELECT *, {normal('contenu')} AS words FROM cleaned)),
        detected AS ({detected}),
        spoken AS (SELECT n.*, CASE WHEN length(contenu) < 5 OR len(ws) = 0 THEN 'fr'
            WHEN {_listed('ws', FREQUENT)} / len(ws) >= CAST(0.2 AS DOUBLE) THEN 'mg'
            WHEN coalesce(detected, 'fr') = 'fr' THEN 'fr' ELSE 'mg' END AS langue
          FROM normed n LEFT JOIN detected d ON n.doc_id = d.doc_id),
        scored AS (SELECT s.*, CASE WHEN langue = 'mg' THEN {_score(PRAISE, COMPLAINT)}
            ELSE coalesce(f.model_score, 0.0) END AS score
          FROM spoken s LEFT JOIN ({french}) f ON f.doc_id = s.doc_id)
        SELECT s.doc_id, titre, contenu, source, langue, round(score, 6) AS sentiment_score, {_LABEL} AS sentiment,
          c.categorie, coalesce(o.origin, {DOMAIN}) AS origin
        FROM scored s JOIN ({_categories(PHRASES)}) c ON s.doc_id = c.doc_id
        LEFT JOIN (VALUES {NAMES}) AS o(domain, origin) ON o.domain = {DOMAIN}
    """


def _models(tables: Tables) -> dict:
    return {
        "language_model": M.language_model(tables.spark, tables.table("documents"), "text", "lang"),
        "sentiment_model": sentiment_weights(tables),
    }


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "sentiment_score": F.round("sentiment_score", 6),
            "categorie": F.array_join("categorie", "|"),
        }
    )


@query(_enriched("SELECT doc_id, titre, contenu, source FROM @articles"))
def enrich_articles(tables: Tables) -> DataFrame:
    rows = tables.view("articles").select("doc_id", "titre", "contenu", "source")
    return _flat(enrich(rows, **_models(tables), **_ENRICHMENT))


@query(
    f"""
    WITH renewed AS ({_enriched("SELECT doc_id, titre, contenu, source FROM @articles")})
    SELECT r.doc_id, r.titre, coalesce(n.contenu, r.contenu) AS contenu, r.source,
      CASE WHEN n.doc_id IS NULL THEN r.langue ELSE n.langue END AS langue, n.sentiment_score, n.sentiment,
      n.categorie, n.origin
    FROM @articles r LEFT JOIN renewed n ON r.doc_id = n.doc_id
    """
)
def reenrich(tables: Tables) -> DataFrame:
    rows = tables.view("articles").select("doc_id", "titre", "contenu", "source", "langue")
    return _flat(renew(rows, **_models(tables), **_ENRICHMENT))


@query(ORACLES["reenrich"])
def reenrich_parts(tables: Tables) -> DataFrame:
    """The same in two runs over the files of a table: the second goes on where the first was ended."""
    path = scratch_path(tables.spark, "parts")
    rows = tables.view("articles").select("doc_id", "titre", "contenu", "source", "langue")
    rows.repartition(4, "doc_id").write.parquet(f"{path}/table")
    table, models = tables.spark.read.schema(rows.schema).parquet(f"{path}/table"), _models(tables)
    for lots in (1, None):
        Z.change_in_parts(table, f"{path}/out", lambda part: renew(part, **models, **_ENRICHMENT), lot_bytes=1, max_lots=lots)
    return _flat(Z.read_parts(tables.spark, f"{path}/out"))


# --- ingest: all producers, known ids, gate, enrichment, append ---------------------------

_KNOWN = "substr(id_article, 1, 1) < '4'"
_FIRST = f"""
    SELECT id_article AS doc_id, titre, contenu, source FROM (
      SELECT *, row_number() OVER (PARTITION BY id_article ORDER BY url NULLS FIRST, titre, contenu) AS place
      FROM ({PRODUCED}) WHERE {VALID} AND id_article <> '')
    WHERE place = 1 AND NOT {_KNOWN}
"""


# Both models on the new rows' cleaned texts; their profiles are those of the documents.
_NEW_GRAMS = """
    SELECT doc_id, gram, count(*) AS n FROM (
      SELECT doc_id, unnest(list_transform(range(1, length(p) - 1), lambda i: substr(p, i, 3))) AS gram
      FROM (SELECT doc_id, concat(' ', unnest(split(letters, ' ')), ' ') AS p FROM (
        SELECT doc_id, trim(regexp_replace(words, '[^a-z]+', ' ', 'g')) AS letters FROM normed))
      WHERE p <> '  ')
    GROUP BY doc_id, gram
"""
_NEW_DETECTED = f"""
    SELECT doc_id, arg_max(lang, (score, -place)) AS detected FROM (
      SELECT g.doc_id, l.lang, l.place, sum(coalesce(p.weight, l.unseen) * g.n) AS score
      FROM ({_NEW_GRAMS}) g
      CROSS JOIN (SELECT lang, min(unseen) AS unseen, row_number() OVER (ORDER BY lang) AS place
        FROM ({_PROFILES}) GROUP BY lang) l
      LEFT JOIN ({_PROFILES}) p ON p.lang = l.lang AND p.gram = g.gram
      GROUP BY g.doc_id, l.lang, l.place) GROUP BY doc_id
"""
_NEW_CONFIDENCE = f"""
    SELECT doc_id, CASE WHEN bad >= good THEN -1 ELSE 1 END / (1 + exp(-abs(good - bad) / 10000)) AS model_score FROM (
      SELECT g.doc_id, sum(CASE WHEN c.class = 1 THEN coalesce(p.weight, c.unseen) * g.n ELSE 0 END) AS good,
        sum(CASE WHEN c.class = 0 THEN coalesce(p.weight, c.unseen) * g.n ELSE 0 END) AS bad
      FROM ({_NEW_GRAMS}) g
      CROSS JOIN (SELECT class, min(unseen) AS unseen FROM ({_CLASS_PROFILES}) GROUP BY class) c
      LEFT JOIN ({_CLASS_PROFILES}) p ON p.class = c.class AND p.gram = g.gram
      GROUP BY g.doc_id)
"""


def _batch(tables: Tables) -> DataFrame:
    """The produced articles, read and shaped once for all that is done with them."""
    rows, path = produced(tables), scratch_path(tables.spark, "produced")
    rows.write.parquet(path)
    return tables.spark.read.schema(rows.schema).parquet(path)


def _known_table(tables: Tables, batch: DataFrame) -> str:
    """A table that holds some of the produced articles already, at a new path."""
    path = scratch_path(tables.spark, "ingested")
    known = batch.where(_KNOWN).dropDuplicates(["id_article"])
    known = known.withColumns({c: F.lit("known article " * 3) for c in ("titre", "contenu")})
    N.enrich_articles(known, **_models(tables)).write.parquet(path)
    return path


@query(
    f"""
    SELECT doc_id AS id_article, titre, contenu, langue, sentiment_score, sentiment, categorie, origin
    FROM ({_enriched(_FIRST, _NEW_DETECTED, _NEW_CONFIDENCE)})
    """
)
def ingest_pipeline(tables: Tables) -> DataFrame:
    """The rows that two runs over the same batch add to a table: the second adds none."""
    batch = _batch(tables)
    path = _known_table(tables, batch)
    known = tables.spark.read.parquet(path)
    columns = ["id_article", "titre", "contenu", "langue", "sentiment_score", "sentiment", "categorie", "origin"]
    models = _models(tables)
    for _ in range(2):
        N.ingest(batch, tables.spark.read.schema(known.schema).parquet(path), path, **models, **_ENRICHMENT)
    return _flat(tables.spark.read.schema(known.schema).parquet(path).where(f"NOT ({_KNOWN})").select(*columns))


@query(
    f"""
    SELECT CASE WHEN id_article IS NULL OR id_article = '' THEN 'skipped' WHEN {_KNOWN} THEN 'existing'
      WHEN {VALID} THEN 'added' ELSE 'skipped' END AS status, count(*) AS n
    FROM ({PRODUCED}) GROUP BY 1
    """
)
def ingest_counters(tables: Tables) -> DataFrame:
    batch = _batch(tables)
    return K.run_counters(batch, tables.spark.read.parquet(_known_table(tables, batch)).select("id_article"))

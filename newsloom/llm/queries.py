"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import (
    alignment,
    decontaminate,
    divergence,
    langid,
    line_dedup,
    mixing,
    near_dup,
    pii,
    quality,
    substrings,
    token_counts,
    toxicity,
    url_rules,
)
from newsloom.llm.shared import settle

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    """Register a function of a reader of tables under its own name."""

    def register(make):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            settle(spark)
            return make(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))

        QUERIES[make.__name__] = run
        if sql is not None:
            ORACLES[make.__name__] = sql
        return make

    return register


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Shingle sets of documents and of benchmark items.
_SHINGLES = f"""
    {{name}}_words AS (
      SELECT {{id}}, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM {{table}}
    ), {{name}} AS (
      SELECT DISTINCT {{id}}, array_to_string(w[k:least(k + 4, len(w))], ' ') AS shingle
      FROM (SELECT {{id}}, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS k FROM {{name}}_words WHERE len(w) > 0)
    )"""
_DOC_SHINGLES = _SHINGLES.format(name="shingles", id="doc_id", table="documents")
_ITEM_SHINGLES = _SHINGLES.format(name="items", id="item_id", table="benchmark")


@query(
    f"""
    WITH RECURSIVE {_DOC_SHINGLES}, sizes AS (
      SELECT d.doc_id, count(s.shingle) AS n FROM documents d LEFT JOIN shingles s ON s.doc_id = d.doc_id GROUP BY d.doc_id
    ), linked AS (
      SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
      JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
    ), reach AS (
      SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN linked l ON l.a = r.b
    ), lowest AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
    SELECT s.doc_id, n AS n_shingles, low AS component_id, s.doc_id = low AS kept
    FROM sizes s JOIN lowest l ON l.a = s.doc_id
    """
)
def op1_minhash_near_dedup(table) -> DataFrame:
    """The component of near duplicates of every document."""
    return near_dup.near_duplicates(table("documents"))


@query()
def op2_mix_sources(table) -> DataFrame:
    """Every document's cell, chance and draw, for tempered targets."""
    return mixing.mixed(table("documents"))


@query(
    """
    WITH raw AS (
      SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
    ), starts AS (
      SELECT doc_id, x, unnest(generate_series(0, len(x) // 2 - 50)) AS s FROM raw WHERE len(x) >= 100
    ), strings AS (
      SELECT doc_id, s, substr(x, 2 * s::BIGINT + 1, 100) AS str FROM starts
    ), copies AS (
      SELECT doc_id, s, doc_id > min(doc_id) OVER (PARTITION BY str) AS is_copy FROM strings
    ), marked AS (
      SELECT doc_id, s, s - 50 > coalesce(lag(s) OVER (PARTITION BY doc_id ORDER BY s), -100) AS opens
      FROM copies WHERE is_copy
    ), grouped AS (
      SELECT doc_id, s, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM marked
    ), spans AS (
      SELECT doc_id, g, min(s) AS a, max(s) + 50 AS b FROM grouped GROUP BY doc_id, g
    ), edges AS (
      SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS prev,
             row_number() OVER (PARTITION BY doc_id ORDER BY a DESC) AS from_end FROM spans
    ), pieces AS (
      SELECT e.doc_id, sum(b - a) AS removed, count(*) AS n,
             string_agg(substr(x, 2 * prev::BIGINT + 1, 2 * (a - prev)::BIGINT), '' ORDER BY a) ||
             substr(any_value(x), 2 * max(b)::BIGINT + 1) AS kept
      FROM edges e JOIN raw r ON r.doc_id = e.doc_id GROUP BY e.doc_id
    )
    SELECT r.doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
           coalesce(n, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
    FROM raw r LEFT JOIN pieces p ON p.doc_id = r.doc_id
    """
)
def op3_suffix_dedup(table) -> DataFrame:
    """Bytes of every document that earlier documents hold, and a digest of the rest."""
    return substrings.deduplicated(table("documents"))


@query(
    f"""
    WITH {_DOC_SHINGLES}, {_ITEM_SHINGLES}, sizes AS (SELECT item_id, count(*) AS n FROM items GROUP BY item_id),
    hits AS (
      SELECT s.doc_id, i.item_id FROM shingles s JOIN items i ON i.shingle = s.shingle JOIN sizes z ON z.item_id = i.item_id
      GROUP BY s.doc_id, i.item_id, z.n HAVING 100 * count(*) >= 75 * z.n
    )
    SELECT d.doc_id, coalesce(string_agg(h.item_id::VARCHAR, ',' ORDER BY h.item_id), '') AS item_ids,
           count(h.item_id)::BIGINT AS n_items, count(h.item_id) > 0 AS contaminated
    FROM documents d LEFT JOIN hits h ON h.doc_id = d.doc_id GROUP BY d.doc_id
    """
)
def op4_benchmark_decontamination(table) -> DataFrame:
    """The benchmark items that every document holds."""
    rows = decontaminate.contaminated(table("documents"), table("benchmark"))
    return rows.withColumn("item_ids", F.array_join("item_ids", ","))


def _certified_cutoffs() -> str:
    """One row for each stratum and rule: the strictest cutoff before the first that fails."""
    counts = " UNION ALL ".join(
        f"SELECT lang, '{rule}' AS rule, {k} AS step, {cut} AS cutoff, count(*) AS n, count(*) FILTER (WHERE {rule} > {cut}) AS bad FROM good GROUP BY lang"
        for rule, cuts in quality.CUTOFFS.items()
        for k, cut in enumerate(cuts)
    )
    rate = quality.RISK / len(quality.CUTOFFS)
    level = f"{quality.ALPHA} / (greatest((SELECT count(DISTINCT lang) FROM good), 1) * {len(quality.CUTOFFS)})"
    return f"""
      SELECT lang, rule, max_by(cutoff, step) FILTER (WHERE held) AS cutoff FROM (
        SELECT *, bool_and(passes) OVER (PARTITION BY lang, rule ORDER BY step) AS held FROM (
          SELECT *, bad < n AND list_sum(list_transform(range(0, bad + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1)
            - lgamma(n - i + 1) + i * ln({rate}) + (n - i) * ln(1 - {rate})))) <= {level} AS passes FROM ({counts})))
      GROUP BY lang, rule
    """


_CUTS = ", ".join(f"any_value(cutoff) FILTER (WHERE rule = '{rule}')::BIGINT AS {rule}_cut" for rule in quality.CUTOFFS)
_ABOVE = " OR ".join(f"coalesce({rule} > {rule}_cut, false)" for rule in quality.CUTOFFS)


@query(
    r"""
    WITH split_texts AS (
      SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
      FROM documents
    ), windows AS (
      SELECT doc_id, k, array_to_string(w[k:k + 2], ' ') AS triple
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS k FROM split_texts WHERE len(w) > 2)
    ), repeated AS (
      SELECT doc_id, k FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, triple) AS n FROM windows) WHERE n > 1
    ), covered AS (
      SELECT doc_id, count(DISTINCT at_word) AS n FROM (
        SELECT doc_id, unnest([k, k + 1, k + 2]) AS at_word FROM repeated) GROUP BY doc_id
    ), base AS (
      SELECT s.doc_id, lang, len(w)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
             length(regexp_replace(text, '\PL', '', 'g')) AS letters, length(regexp_replace(text, '\P{{Lu}}', '', 'g')) AS upper,
             length(regexp_replace(text, '[^!]', '', 'g')) AS bangs
      FROM split_texts s LEFT JOIN covered c ON c.doc_id = s.doc_id
    ), measured AS (
      SELECT * EXCLUDE (letters, upper, bangs), n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             (1000 * n_symbols // greatest(n_words, 1))::BIGINT AS symbols,
             (1000 * upper // greatest(letters, 1))::BIGINT AS capitals,
             (1000 * n_repeat_words // greatest(n_words, 1))::BIGINT AS repeats,
             (1000 * bangs // greatest(n_words, 1))::BIGINT AS marks
      FROM base
    ), good AS (
      SELECT * FROM measured WHERE NOT base_failed AND doc_id IN (
        SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1)
    ), cutoffs AS (SELECT lang, {cuts} FROM ({certified}) GROUP BY lang)
    SELECT m.*, {cut_names}, NOT base_failed AND NOT ({above}) AS kept
    FROM measured m LEFT JOIN cutoffs c ON c.lang = m.lang
    """.format(
        cuts=_CUTS, certified=_certified_cutoffs(), above=_ABOVE, cut_names=", ".join(f"coalesce({r}_cut, -1) AS {r}_cut" for r in quality.CUTOFFS)
    )
)
def op5_quality_rules(table) -> DataFrame:
    """Base counts, certified cutoffs of the document's language (-1: none), and the verdict."""
    rows = quality.judged(table("documents"), table("labels"))
    cuts = [F.coalesce(f"{rule}_cut", F.lit(-1).cast("long")).alias(f"{rule}_cut") for rule in quality.CUTOFFS]
    return rows.select("doc_id", *quality.BASE, "base_failed", "kept", "lang", *quality.CUTOFFS, *cuts)


@query()
def op6_pii(table) -> DataFrame:
    """Personal data in every document: base spans and those found by context."""
    return pii.digest(pii.found(table("documents")))


@query(
    r"""
    WITH texts AS (
      SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL
    ), numbered AS (
      SELECT doc_id, unnest(lines) AS line, unnest(generate_series(1, len(lines))) AS idx FROM texts
    ), worded AS (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS pos,
             len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
      FROM numbered WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
    ), pairs AS (
      SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY idx) AS next_line FROM worded
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS nth,
             row_number() OVER (PARTITION BY line, next_line ORDER BY doc_id, pos) AS nth_pair
      FROM pairs
    ), spread AS (
      SELECT line FROM worded GROUP BY line HAVING count(DISTINCT doc_id) >= {min_docs}
    ), gone AS (
      SELECT doc_id, pos FROM ranked WHERE (words >= {min_words} OR line IN (FROM spread)) AND nth > 1
      UNION SELECT doc_id, pos FROM ranked WHERE next_line IS NOT NULL AND nth_pair > 1
      UNION SELECT doc_id, pos + 1 FROM ranked WHERE next_line IS NOT NULL AND nth_pair > 1
    ), marked AS (
      SELECT n.doc_id, n.idx, n.line, w.pos IS NOT NULL AS worded, g.pos IS NOT NULL AS gone
      FROM numbered n LEFT JOIN worded w ON w.doc_id = n.doc_id AND w.idx = n.idx
      LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.pos = w.pos
    ), starts AS (
      SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY idx), false) AS starts FROM marked
    )
    SELECT doc_id, count(*) FILTER (WHERE worded)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_removed,
           count(*) FILTER (WHERE starts)::BIGINT AS n_runs,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY idx) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM starts GROUP BY doc_id
    UNION ALL
    SELECT doc_id, 0, 0, 0, sha256('') FROM documents WHERE text IS NULL
    """.format(min_words=line_dedup.MIN_WORDS, min_docs=line_dedup.MIN_DOCS)
)
def op7_line_dedup(table) -> DataFrame:
    """Deleted line runs of every document and a digest of the text that is left."""
    rows = line_dedup.deduplicated(table("documents"))
    return rows.select(
        "doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    )


@query()
def op8_toxicity(table) -> DataFrame:
    """The toxicity score of every document."""
    return toxicity.judged(table("documents"), table("labels"))


@query()
def op9_language_id(table) -> DataFrame:
    """The language of every document."""
    return langid.identified(table("documents"))


@query()
def op10_url_filters(table) -> DataFrame:
    """The verdict on every page's address."""
    return url_rules.judged(table("pages"), table("labels"))


@query()
def op11_cross_tokenizer_alignment(table) -> DataFrame:
    """Tokens of two vocabularies laid side by side, for every document."""
    return alignment.aligned(table("documents"))


@query()
def op12_token_counts(table) -> DataFrame:
    """The tokens of every document, counted by merging."""
    return token_counts.counted(table("documents"))


@query(
    r"""
    WITH texts AS (
      SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row_no,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
      FROM documents
    ), kept AS (
      SELECT lang, term FROM (SELECT DISTINCT row_no, lang, unnest(w) AS term FROM texts) GROUP BY lang, term HAVING count(*) >= {least}
    ), counts AS (
      SELECT t.lang, source, t.term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM texts) t
      JOIN kept k ON k.lang = t.lang AND k.term = t.term GROUP BY t.lang, source, t.term
    ), sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
    groups AS (
      SELECT g.lang, g.source, coalesce(sum(n), 0) AS total, coalesce(any_value(v), 0) AS v
      FROM (SELECT DISTINCT lang, source FROM texts) g LEFT JOIN sizes s ON s.lang = g.lang
      LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source
    ), shares AS (
      SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, 1 + ({unit}::HUGEINT * (coalesce(n, 0) + {prior})) // (total + {prior} * v) AS p
      FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    ), whole AS (
      SELECT lang, term, 1 + ({unit}::HUGEINT * (sum(n) + {prior})) // (sum(sum(n)) OVER (PARTITION BY lang) + {prior} * count(*) OVER (PARTITION BY lang)) AS q
      FROM shares GROUP BY lang, term
    ), differences AS (
      SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY a.lang, a.source, b.source
    ), listed AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
      FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
      LEFT JOIN differences d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
      UNION ALL
      SELECT s.lang, s.source, 'term', s.term, (p - q)::BIGINT FROM shares s JOIN whole w ON w.lang = s.lang AND w.term = s.term WHERE n > 0 AND p > q
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM listed
    )
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= {top}
    """.format(least=divergence.MIN_DOCS, unit=divergence.UNIT, prior=divergence.PRIOR, top=divergence.TOP_TERMS)
)
def op13_source_divergence_audit(table) -> DataFrame:
    """How far apart sources of a language are, and the terms that mark each."""
    return divergence.audited(table("documents"))

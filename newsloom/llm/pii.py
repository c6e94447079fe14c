"""Personal data: base patterns, and more found by bootstrapped contexts.

The base patterns find e-mail addresses, IP numbers, payment cards and phone
numbers, leftmost and without overlaps within a kind.  What they find, and the seed
secrets (hex digests), are instances; the text around an instance is a lexical
pattern.  Contexts come from every token that looks like an identifier: it holds a
digit or an @.  A token in which a valid base span begins is a seed; a span of
several tokens is one instance, in the context of its first token, and the others
are no part of the graph.  A pattern is the two words before the token, the sign that opens it
and the sign that closes it.

Patterns and instances form a graph that Spark scores in rounds.  The score of an
instance starts at 1 for a seed, and 0 else.  The score of a pattern is the mean
score of its distinct instances, counted with a prior against it; the score of an
instance becomes 1 less the chance that all patterns that hold it are wrong.  After
``ROUNDS`` rounds, patterns of a high score with enough distinct seeds are trusted,
and every token in a trusted pattern that no base span covers is a new span of kind
``id``.

All work is DataFrame functions; only (pattern, instance) counts are shuffled, not
texts.  A word is hashed text here, so long tokens cost no more than short ones.

Cases: a null or empty text has no spans; rows are told apart by themselves, so
repeated rows and null ids give equal spans; a corpus without seeds trusts no
pattern; a text may be of any length; an empty table gives an empty one; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.shared import cut, settle

#: Base patterns.  Possessive repeats and the look back keep a scan linear: a match
#: can only begin where a run of its characters begins or the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

#: Tokens that may be identifiers, seeds among them that are no base kind, and the
#: kind of what contexts find.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
SECRET = r"(?:[0-9a-f]{32,}|[0-9A-F]{32,})"
FOUND = "id"

ROUNDS = 3
#: Strength of the prior against a pattern, in instances; seeds it needs; its least score.
PRIOR = 5.0
MIN_SEEDS = 10
MIN_SCORE = 0.6


_BLANKS = r"[\x20\x09-\x0D]+"
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Characters before a token that its context is read from, and words of them.
CONTEXT_CHARS = 64
CONTEXT_WORDS = 2

_KEY = ("doc_id", "text_id")


def _matches(text: Column, kind: str, pattern: str) -> Column:
    """The matches of a pattern: kind, ordinal, characters since the last match, what is before, value."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(
        values,
        F.split(text, pattern, -1),  # one more than the values: the rest of the text
        lambda value, gap: F.struct(value.alias("value"), F.length(gap).alias("gap"), F.right(gap, F.lit(CONTEXT_CHARS)).alias("before")),
    )
    return F.transform(
        F.filter(parts, lambda x: x["value"].isNotNull()),
        lambda x, at: F.struct(
            F.lit(kind).alias("kind"), at.alias("nth"), x["gap"].alias("gap"), x["before"].alias("before"), x["value"].alias("value")
        ),
    )


def _placed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_id, kind, start, end, before, value) of all matches, in code points."""
    none = F.array().cast("array<struct<kind:string,nth:int,gap:int,before:string,value:string>>")
    text = F.col("text")

    def where(sign: str, kind: str, pattern: str) -> Column:
        return F.when(F.contains(text, F.lit(sign)), _matches(text, kind, pattern)).otherwise(none)

    found = F.concat(
        where("@", "email", EMAIL),
        _matches(text, "ip", IP),
        _matches(text, "card", CARD),
        where("+", "phone", PHONE),
        _matches(text, "token", TOKEN),
    )
    rows = docs.where("text IS NOT NULL").select(*_KEY, F.inline(found))
    so_far = Window.partitionBy(*_KEY, "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(so_far).cast("int")
    return rows.distinct().withColumn("end", end).select(
        *_KEY, "kind", (F.col("end") - F.length("value")).alias("start"), "end", "before", "value"
    )


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    signs = F.reverse(F.split(digits, ""))
    doubled = F.transform(
        F.filter(signs, lambda c: c != ""),
        lambda c, at: F.when(at % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, x: total + x) % 10 == 0


def valid(kind: Column, value: Column) -> Column:
    """Whether a match of a base kind passes the check of its kind."""
    part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
    digits = F.regexp_replace(value, "[^0-9]", "")
    size = F.length(digits)
    return (
        F.when(kind == "ip", value.rlike(rf"^{part}\.{part}\.{part}\.{part}$"))
        .when(kind == "card", size.between(13, 19) & luhn(F.when(size.between(13, 19), digits).otherwise("1")))
        .when(kind == "phone", size.between(9, 15))
        .otherwise(F.lit(True))
    )


def _with_base(matches: DataFrame) -> DataFrame:
    """Tokens with ``based``, the end and value of the longest valid base span that begins
    in them or null, and ``inside``, whether an earlier one reaches into them.

    One pass in the order of the text: each base span goes to the token it begins in.
    """
    is_token = F.col("kind") == "token"
    rows = matches.where(is_token | valid(F.col("kind"), F.col("value")))
    so_far = Window.partitionBy(*_KEY).orderBy("start", (~is_token).cast("int")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({
        "own": F.max(F.when(is_token, F.col("start"))).over(so_far),
        "reach": F.max(F.when(~is_token, F.col("end"))).over(so_far),
    })
    token = F.max(F.when(is_token, F.struct("start", "end", "before", "value", F.coalesce(F.col("reach") > F.col("start"), F.lit(False)).alias("inside"))))
    based = F.max(F.when(~is_token, F.struct("end", "start", "value")))
    return rows.groupBy(*_KEY, "own").agg(token.alias("token"), based.alias("based")).select(*_KEY, "token.*", "based")


def contexts(tokens: DataFrame) -> DataFrame:
    """Tokens with ``core``, its place, the pattern around it and whether it is a seed."""
    core = F.btrim("value", F.lit(_PUNCTUATION))
    cleaned = F.regexp_replace(F.lower("before"), r"[^\p{L}\p{N}=:\x20\x09-\x0D]", "")
    words = F.filter(F.split(cleaned, _BLANKS), lambda w: w != "")
    words = F.slice(words, F.greatest(F.size(words) - CONTEXT_WORDS + 1, F.lit(1)), CONTEXT_WORDS)
    placed = tokens.withColumn("core", core).where("core != ''").withColumn("skipped", F.expr("locate(core, value) - 1"))
    # The sign in front of a base span opens it, not one of its own such as a phone's +.
    opening = F.expr("right(left(value, least(skipped, coalesce(based.start - start, skipped))), 1)")
    closing = F.expr("substring(value, skipped + length(core) + 1, 1)")
    pattern = F.concat_ws(" ", F.array_join(words, " "), F.concat(opening, F.lit("<x>"), closing))
    kinds = F.array(*[
        F.when(F.col("core").rlike(f"^(?:{expression})$") & valid(F.lit(kind), F.col("core")), kind)
        for kind, expression in (("email", EMAIL), ("ip", IP), ("card", CARD), ("secret", SECRET))
    ])
    seed = F.col("based").isNotNull() | (F.size(F.filter(kinds, lambda k: k.isNotNull())) > 0)
    several = F.coalesce(F.col("based.end") > F.col("end"), F.lit(False))
    return placed.withColumn("seed", seed).where("seed OR NOT inside").select(
        *_KEY,
        (F.col("start") + F.col("skipped")).alias("start"),
        (F.col("start") + F.col("skipped") + F.length("core")).alias("end"),
        pattern.alias("pattern"),
        F.xxhash64(F.when(several, F.btrim("based.value", F.lit(_PUNCTUATION))).otherwise(F.col("core"))).alias("instance"),
        "seed",
    )


def trusted_patterns(tokens: DataFrame) -> DataFrame:
    """(pattern, score, seeds) of the patterns that the graph's rounds trust."""
    edges = cut(tokens.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pii-edges")
    seeds = edges.groupBy("pattern").agg(F.sum(F.col("seed").cast("long")).alias("seeds"))
    scores = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("believed"))
    for _ in range(ROUNDS):
        patterns = cut(
            edges.join(scores, "instance").groupBy("pattern").agg((F.sum("believed") / (F.count("*") + PRIOR)).alias("score")), "pii-patterns"
        )
        doubt = F.sum(F.log1p(-F.least("score", F.lit(1 - 1e-9))))
        scores = cut(
            edges.join(patterns, "pattern").groupBy("instance").agg(
                F.greatest(F.max(F.col("seed").cast("double")), 1 - F.exp(doubt)).alias("believed")
            ),
            "pii-scores",
        )
    return patterns.join(seeds, "pattern").where((F.col("score") >= MIN_SCORE) & (F.col("seeds") >= MIN_SEEDS))


def _order(kind: Column) -> Column:
    order = F.lit(len(KINDS))
    for at, name in enumerate(KINDS):
        order = F.when(kind == name, at).otherwise(order)
    return order


def found(docs: DataFrame) -> DataFrame:
    """(doc_id, spans), one row per row of ``docs``: sorted structs (nth kind, start, end, kind)."""
    settle(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    narrow = narrow.withColumn("text_id", F.xxhash64("text"))
    placed = cut(_placed(narrow), "pii-matches")
    base = placed.where((F.col("kind") != "token") & valid(F.col("kind"), F.col("value"))).select(*_KEY, "kind", "start", "end")
    tokens = cut(contexts(_with_base(placed)), "pii-tokens")
    more = tokens.join(trusted_patterns(tokens).select("pattern"), "pattern", "left_semi").select(*_KEY, F.lit(FOUND).alias("kind"), "start", "end")
    span = F.struct(_order(F.col("kind")).alias("nth"), "start", "end", "kind")
    spans = base.union(more).groupBy(*_KEY).agg(F.array_sort(F.collect_list(span)).alias("all"))
    own = F.filter("all", lambda x: x["kind"] != FOUND)
    free = F.filter(
        "all",
        lambda x: (x["kind"] == FOUND) & ~F.exists("own", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])),
    )
    spans = spans.withColumn("own", own).withColumn("spans", F.concat("own", free)).select(
        F.col("doc_id").alias("_doc"), F.col("text_id").alias("_text"), "spans"
    )
    rows = narrow.select(*_KEY)
    joined = rows.join(spans, rows["doc_id"].eqNullSafe(spans["_doc"]) & rows["text_id"].eqNullSafe(spans["_text"]), "left")
    none = F.array().cast("array<struct<nth:int,start:int,end:int,kind:string>>")
    return joined.select("doc_id", F.coalesce("spans", none).alias("spans"))


def digest(rows: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of the base spans and all spans as text."""

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["kind"] != FOUND)
    return rows.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans")
    )

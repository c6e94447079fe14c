"""Mix sources to target weights: raked token weights and calibrated sampling.

Documents are counted into cells (source, language, topic).  Iterative
proportional fitting rakes the token weights of the cells until the shares by
source, by language and by topic are the targets.  A document's chance is then
its cell's weight per token times one factor, at most 1; the factor is calibrated
so that the expected tokens are the budget.  A document is drawn when the hash of
its id lies below its chance, so the draw is the same on every run.

Targets are given as shares per value, or come from the corpus: its own token
shares to a power below 1, which lifts small sources.  A value without a target
counts as 0 when targets are given.  Targets that contradict each other (an empty
cell leaves no way) end after ``ROUNDS`` rounds with the last raked margin right.

Cases: null source, language and text are the value ''; a text without words has
no tokens and, in a cell of its own weight, the cell's chance; rows that share a
doc_id are drawn together; a null doc_id draws like any other value; an empty
table gives an empty result; documents keep all their columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.shared import cut, settle, unused

#: Expected tokens of the sample, as a share of all.
BUDGET = 0.5
#: The power of the corpus share that is the default target, by margin.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.5}
#: Rounds of raking, and the largest error of a margin's share that ends it.
ROUNDS = 40
TOLERANCE = 1e-6
ROUNDS_PER_CUT = 4

MARGINS = ("source", "lang", "topic")

#: Topics by the words that mark them, whole and in lower case; the topic with
#: most marks wins, the first of equals.  Texts without a mark are "general".
TOPICS = {
    "legal": ("license", "licensed", "copyright", "lizenz", "licence", "licencia"),
    "technology": ("token", "software", "code", "data", "daten", "logiciel", "datos"),
    "contact": ("mail", "example", "phone", "telefon", "contact", "kontakt", "correo"),
}
OTHER = "general"
SEED = 20


def topic_of(text: Column, topics: dict[str, tuple[str, ...]] = TOPICS) -> Column:
    lowered = F.lower(text)

    def marked(words: tuple[str, ...]) -> str:
        return rf"\b(?:{'|'.join(words)})\b"

    # Most texts have no mark at all, which one pass shows.
    some = lowered.rlike(marked(tuple(w for words in topics.values() for w in words)))
    counts = F.array(*[F.regexp_count(lowered, F.lit(marked(words))) for words in topics.values()])
    names = F.array(*[F.lit(name) for name in topics])
    most = F.transform(F.array(counts), lambda c: F.get(names, F.array_position(c, F.array_max(c)).cast("int") - 1))
    return F.when(some, F.get(most, F.lit(0))).otherwise(OTHER)


def features(docs: DataFrame) -> list[Column]:
    """The margins' values and the tokens of a document."""

    def value(name: str) -> Column:
        given = F.col(name).cast("string") if name in docs.columns else F.lit(None).cast("string")
        return F.coalesce(given, F.lit(""))

    text = F.col("text").cast("string")
    tokens = F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return [value("source"), value("lang"), F.when(text.isNull(), "").otherwise(topic_of(text)), tokens]


def _targets(cells: DataFrame, margin: str, given: dict[str, float] | None) -> DataFrame:
    """(margin, target share), summing to 1 over the values that have tokens."""
    shares = cells.groupBy(margin).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    if given is None:
        weight = F.pow(F.col("tokens"), F.lit(TEMPER[margin]))
    else:
        table = F.create_map(*[F.lit(x) for pair in given.items() for x in pair]) if given else F.create_map()
        weight = F.coalesce(table[F.col(margin)].cast("double"), F.lit(0.0))
    weighted = shares.select(margin, weight.alias("w"))
    total = weighted.agg(F.sum("w")).scalar()
    return weighted.select(margin, (F.col("w") / F.nullif(total, F.lit(0.0))).alias(f"{margin}_target"))


def raked(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """The cells with ``weight``, their share of the sample's tokens."""
    for margin in MARGINS:
        cells = cells.join(_targets(cells, margin, (targets or {}).get(margin)), margin, "left")
    weighted = cut(cells.withColumn("weight", F.col("tokens").cast("double")), "mix-cells")
    for _ in range(0, ROUNDS, ROUNDS_PER_CUT):
        for _ in range(ROUNDS_PER_CUT):
            for margin in MARGINS:
                have = F.sum("weight").over(Window.partitionBy(margin))
                scaled = F.col("weight") * F.col(f"{margin}_target") / F.nullif(have, F.lit(0.0))
                weighted = weighted.withColumn("weight", F.coalesce(scaled, F.lit(0.0)))
        weighted = cut(weighted, "mix-cells")
        worst = weighted.select(*[
            F.abs(F.sum("weight").over(Window.partitionBy(m)) - F.coalesce(f"{m}_target", F.lit(0.0))).alias(m) for m in MARGINS
        ]).agg(F.greatest(*[F.max(m) for m in MARGINS]).alias("worst")).first()["worst"]
        if (worst or 0.0) <= TOLERANCE:
            break
    return weighted


def with_chances(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Raked cells with ``chance``: min(1, factor * weight per token), for the budget."""
    rated = cells.withColumn("rate", F.coalesce(F.col("weight") / F.nullif("tokens", F.lit(0)), F.lit(0.0)))
    total = rated.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    wanted, factor = budget * total, 0.0
    while True:
        full = F.col("rate") * factor >= 1
        sums = rated.agg(
            F.sum(F.when(full, F.col("tokens"))).alias("full"), F.sum(F.when(~full, F.col("weight"))).alias("rest")
        ).first()
        left, rest = wanted - (sums["full"] or 0), sums["rest"] or 0.0
        if rest <= 0 or left <= 0 or left / rest <= factor * (1 + 1e-12):
            break
        factor = left / rest
    return rated.withColumn("chance", F.least(F.lit(1.0), F.col("rate") * factor))


def _drawn(prefix: str = "") -> Column:
    """True with the chance of the row, by the hash of its id alone."""
    uniform = (F.xxhash64(F.lit(SEED), F.col("doc_id")).bitwiseAND(F.lit((1 << 53) - 1))) / F.lit(float(1 << 53))
    return uniform < F.col(f"{prefix}chance")


def _cells(rows: DataFrame, targets, budget) -> DataFrame:
    cells = rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens"))
    chances = with_chances(raked(cells, targets), budget)
    return cut(chances.select(*MARGINS, "weight", "chance"), "mix-chances")


def mixed(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, n_tokens, cell weight, chance, sampled."""
    settle(docs.sparkSession)
    made = [c.alias(n) for n, c in zip((*MARGINS, "n_tokens"), features(docs), strict=True)]
    rows = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *made), "mix-rows")
    return rows.join(_cells(rows, targets, budget), list(MARGINS), "left").select(
        "doc_id", *MARGINS, "n_tokens", "weight", "chance", _drawn().alias("sampled")
    )


def sampled_documents(
    docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET
) -> DataFrame:
    """The drawn documents with their columns, and mix_topic, mix_tokens, mix_weight, mix_chance.

    The cells are a small table, so the texts are not shuffled.  Where the documents
    have one of the added names already, underscores are put before the added ones.
    """
    settle(docs.sparkSession)
    own, added = unused(docs, "_mix_"), unused(docs, "mix_")
    named = [f"{own}{m}" for m in MARGINS]
    made = [c.alias(f"{own}{n}") for n, c in zip((*MARGINS, "n_tokens"), features(docs), strict=True)]
    # Written with what was read from the texts, so that they are read once.
    tagged = cut(docs.select("*", *made), "mix-rows")
    cells = _cells(tagged.select(*[F.col(f"{own}{c}").alias(c) for c in (*MARGINS, "n_tokens")]), targets, budget)
    cells = cells.toDF(*named, f"{own}weight", f"{own}chance")
    given = {"topic": "topic", "tokens": "n_tokens", "weight": "weight", "chance": "chance"}
    return tagged.join(cells, named, "left").where(_drawn(own)).select(
        *docs.columns, *[F.col(f"{own}{c}").alias(f"{added}{name}") for name, c in given.items()]
    )

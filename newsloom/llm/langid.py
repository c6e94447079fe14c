"""Language by compression: the language whose dictionary packs a text best.

Training texts of a language become a raw-content zstandard dictionary.  A text is
folded to its letters and compressed in blocks, each block alone, with every
dictionary; the language with the fewest bytes in all is the prediction, among equals
the one with most training documents.  Blocks keep a long text from becoming its own dictionary, so
every part of it is judged by what the language has.  A narrow margin between best
and second best rejects the prediction: the best guess stays beside the flag.

The model is bounded: at most ``DICT_DOCS`` training documents with letters a language,
in the order of a hash of their ids (of their texts where they have none), of each the
``DOC_CHARS`` characters from the first letter on, so no document is too long to learn from, and
``DICT_BYTES`` of folded text of them.  Every text is read whole when predicted.

Cases: a null text or one without letters is ``und`` with score 0 and rejected;
without any training language every text is; rows are independent, so repeated
rows and null ids get the prediction of their text; an empty table gives an empty
one; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.shared import map_batches, settle

DICT_DOCS = 200
DOC_CHARS = 8000
DICT_BYTES = 32 * 1024
BLOCK_BYTES = 4096
#: Lazy search for matches of four bytes or more: what tells languages apart is
#: short, and the default levels look for longer matches only.
SEARCH = dict(
    strategy=zstandard.STRATEGY_LAZY2,
    window_log=18,
    chain_log=16,
    hash_log=15,
    search_log=4,
    min_match=4,
    target_length=8,
    write_checksum=False,
    write_content_size=False,
    write_dict_id=False,
)
#: Least share of the best size by which the second must be larger.
MARGIN = 0.01
NONE = "und"

_OTHERS = re.compile(r"[\W\d_]+")
_LETTER = r"\p{L}"


def folded(text: str) -> bytes:
    """The words of letters in lower case, one blank between them."""
    return _OTHERS.sub(" ", text.lower()).strip().encode()


def has_letters(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Packer:
    """The dictionaries of all languages, ready to compress."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = list(dictionaries)
        self.packers = []
        search = zstandard.ZstdCompressionParameters(**SEARCH)
        for language in self.languages:
            known = zstandard.ZstdCompressionDict(dictionaries[language], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=search)
            self.packers.append(zstandard.ZstdCompressor(dict_data=known, compression_params=search))

    def sizes(self, raw: bytes) -> list[int]:
        blocks = [raw[k : k + BLOCK_BYTES] for k in range(0, len(raw), BLOCK_BYTES)]
        return [sum(len(packer.compress(block)) for block in blocks) for packer in self.packers]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin.  The score is 1 where no other language comes near."""
        if not self.languages or not has_letters(text):
            return NONE, 0.0, 0.0
        sizes = self.sizes(folded(text))
        best = min(sizes)
        at = sizes.index(best)
        others = [s for k, s in enumerate(sizes) if k != at]
        margin = (min(others) - best) / best if others else 1.0
        return self.languages[at], min(1.0, margin / (margin + MARGIN)) if margin else 0.0, margin


def dictionaries(training: DataFrame) -> dict[str, bytes]:
    """Folded training text of each language, the most frequent first, from (doc_id, text, lang)."""
    fit = training.where("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    fit = fit.where(F.col("text").rlike(_LETTER)).withColumn("key", key)
    order = Window.partitionBy("lang").orderBy("key")
    chosen = (
        fit.select("lang", "key").withColumn("nth", F.row_number().over(order))
        .where(F.col("nth") <= DICT_DOCS)
        .groupBy("lang", "key").agg(F.min("nth").alias("nth"))
    )
    part = F.regexp_extract("text", rf"(?s){_LETTER}.{{0,{DOC_CHARS - 1}}}", 0)
    rows = fit.join(chosen, ["lang", "key"]).select("lang", "nth", part.alias("text")).distinct().orderBy("lang", "nth", "text")
    counts = fit.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
    made = {row["lang"]: b"" for row in counts.toLocalIterator()}
    for row in rows.select("lang", "text").toLocalIterator():
        held = made[row["lang"]]
        if len(held) < DICT_BYTES and has_letters(row["text"]):
            made[row["lang"]] = (held + b" " + folded(row["text"]))[-DICT_BYTES:]
    return {language: held for language, held in made.items() if held}


def held_out(doc_id: Column) -> Column:
    """Documents of the fold that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predicted(docs: DataFrame, model: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of each row of ``docs``."""
    spark = settle(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    ready: list[Packer] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not ready:
            ready.append(Packer(shared.value))
        found = [ready[0].predict(text) for text in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
                pa.array([f[2] < margin for f in found], pa.bool_()),
            ],
            names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
        )

    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, work, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def identified(docs: DataFrame) -> DataFrame:
    """Learn from the labelled documents that are not held out, predict all."""
    training = docs.where(~held_out(F.col("doc_id").cast("long")))
    return predicted(docs, dictionaries(training))

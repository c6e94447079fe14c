"""How the vocabularies of sources differ, counted through a minimal acyclic transducer.

Terms are runs of letters (A-Z lower-cased, every character beyond ASCII a letter).
Each language keeps the terms that at least ``MIN_DOCS`` of its documents hold.  The
kept terms, sorted by their bytes, are built into transducers: automata that share
beginnings and endings, have no two states with the same continuations, and whose
arcs carry numbers that add up to the term's ordinal in its language.  The texts are
then streamed through them for recounting: all terms of a stretch of text step from
state to state together, and the sums of the numbers are the keys of the counts.
Equal values are ranked by ordinal, which is the order of the terms.

How it is spread:

* Terms are counted in each task before they are shuffled.  The kept ones are sorted
  by range; a task reads its range in order and closes a transducer after
  ``BLOCK_BYTES`` of terms, so no language has to fit anywhere.
* Transducers are taken in shelves of at most ``SHELF_BYTES`` (and one transducer
  more); a shelf is broadcast and the texts are streamed through it, the counts of
  each pass being written.  The bound does not depend on the corpus; a vocabulary of
  ten million terms is one or two passes.
* Shares of all pairs of sources are compared in tiles: at most ``TILE`` sources by
  ``TILE`` sources by ``SPAN`` terms are in one group, whatever the number of either,
  and a term that a source lacks takes the share of a count of zero.

Shares are whole numbers of billionths, worked out with decimals, so nothing overflows
or rounds.

Cases: a null text, language or source is the empty string; a group without terms has
a share for every kept term like any other; a language without kept terms has pairs of
value 0 and no terms; ties are in order of the item's bytes; repeated rows count each;
other columns are ignored, whatever their names; an empty table gives an empty one; a
term may be as long as its text.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.staging import with_once
from newsloom.llm.shared import cut, settle

#: Documents of a language that must hold a term.
MIN_DOCS = 30
#: Terms of a group that are listed.
TOP_TERMS = 50
#: Added to each count; the unit of the shares.
PRIOR = 5
UNIT = 1_000_000_000

#: Text that is worked on together, terms of a transducer, transducers of a shelf.
CHUNK_BYTES = 8 << 20
BLOCK_BYTES = 1 << 20
SHELF_BYTES = 64 << 20
#: Sources and terms of a tile.
TILE = 32
SPAN = 1024

_LETTERS = bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: Bytes of text to bytes of terms; what belongs to no term becomes 0.
_FOLD = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b in _LETTERS else 0 for b in range(256))


def folded(text: str) -> bytes:
    """The bytes of a text, lower-cased, with 0 for all that parts terms."""
    return text.encode().translate(_FOLD)


class Builder:
    """A minimal acyclic automaton from words that come in order of their bytes.

    The states of the last word may still change; those that the next word leaves are
    closed, deepest first, and a closed state that equals an earlier one is that one.
    """

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.labels: list[bytes] = []
        self.targets: list[tuple[int, ...]] = []
        self.finals: list[bool] = []
        self.words: list[int] = []  # words that can be read from a state on
        self.last = b""
        self.open: list[list] = [[False, bytearray(), []]]  # final, labels, targets

    def _close_below(self, depth: int) -> None:
        while len(self.open) > depth + 1:
            final, labels, targets = self.open.pop()
            key = (final, bytes(labels), tuple(targets))
            state = self.known.get(key)
            if state is None:
                state = self.known[key] = len(self.finals)
                self.finals.append(final)
                self.labels.append(key[1])
                self.targets.append(key[2])
                self.words.append(final + sum(self.words[t] for t in targets))
            self.open[-1][2].append(state)

    def add(self, word: bytes) -> None:
        same = 0
        for x, y in zip(word, self.last, strict=False):
            if x != y:
                break
            same += 1
        self._close_below(same)
        for byte in word[same:]:
            self.open[-1][1].append(byte)
            self.open.append([False, bytearray(), []])
        self.open[-1][0] = True
        self.last = word

    def finish(self) -> dict[str, bytes]:
        """The arcs in order of state and byte, and the final states, as packed arrays."""
        self.open.insert(0, [False, bytearray(b"\0"), []])
        self._close_below(0)  # the root is closed like any other state
        root = self.open[0][2][0]
        keys, targets, skips = [], [], []
        for state, (labels, ahead) in enumerate(zip(self.labels, self.targets, strict=True)):
            skip = int(self.finals[state])
            for byte, target in zip(labels, ahead, strict=True):
                keys.append(state << 8 | byte)
                targets.append(target)
                skips.append(skip)
                skip += self.words[target]
        return {
            "root": root,
            "arcs": np.array(keys, np.int64).tobytes(),
            "targets": np.array(targets, np.int32).tobytes(),
            "skips": np.array(skips, np.int32).tobytes(),
            "finals": np.packbits(np.array(self.finals, bool)).tobytes(),
            "n_terms": self.words[root],
        }


class Transducer:
    """Ordinals of terms from the packed arrays of a builder."""

    def __init__(self, row):
        self.root, self.first = row["root"], row["first"]
        self.arcs = np.frombuffer(row["arcs"], np.int64)
        self.targets = np.frombuffer(row["targets"], np.int32)
        self.skips = np.frombuffer(row["skips"], np.int32)
        self.finals = np.unpackbits(np.frombuffer(row["finals"], np.uint8)).astype(bool)

    def ordinals(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The ordinal of each stretch of ``data``; -1 for what is no term."""
        found = np.full(len(starts), -1, np.int64)
        if not len(self.arcs):
            return found
        alive = np.arange(len(starts))
        state = np.full(len(starts), self.root, np.int64)
        number = np.zeros(len(starts), np.int64)
        step = 0
        while len(alive):
            here = lengths[alive] == step
            ended = alive[here & self.finals[state]]
            found[ended] = self.first + number[here & self.finals[state]]
            alive, state, number = alive[~here], state[~here], number[~here]
            key = state << 8 | data[starts[alive] + step]
            at = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            goes = self.arcs[at] == key
            alive, at = alive[goes], at[goes]
            state, number = self.targets[at].astype(np.int64), number[goes] + self.skips[at]
            step += 1
        return found

    def terms(self) -> Iterator[bytes]:
        """All terms, in order."""
        firsts = np.searchsorted(self.arcs, np.arange(len(self.finals) + 1) << 8)
        path, waiting = bytearray(), [(self.root, 0, 0)]
        while waiting:
            state, byte, depth = waiting.pop()
            del path[max(depth - 1, 0) :]
            if depth:
                path.append(byte)
            if self.finals[state]:
                yield bytes(path)
            for k in range(firsts[state + 1] - 1, firsts[state] - 1, -1):
                waiting.append((int(self.targets[k]), int(self.arcs[k]) & 255, depth + 1))


def groups_and_texts(docs: DataFrame) -> DataFrame:
    """lang, source and text, nulls as the empty string."""
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """The rows of a task in stretches of ``CHUNK_BYTES`` of text, as lists."""
    waiting, size = defaultdict(list), 0
    for batch in batches:
        for name in batch.schema.names:
            waiting[name] += batch.column(name).to_pylist()
        size += batch.nbytes
        if size >= CHUNK_BYTES:
            yield waiting
            waiting, size = defaultdict(list), 0
    if waiting and len(next(iter(waiting.values()))):
        yield waiting


def kept_terms(texts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term): what enough documents of a language hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            seen = defaultdict(Counter)
            for lang, text in zip(chunk["lang"], chunk["text"], strict=True):
                seen[lang].update({*folded(text).split(b"\0")})
            for lang, counts in seen.items():
                counts.pop(b"", None)
                langs = pa.array([lang] * len(counts), pa.string())
                terms = pa.array(list(counts), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([langs, terms, pa.array(list(counts.values()), pa.int64())], ["lang", "term", "n"])

    counts = texts.select("lang", "text").mapInArrow(run, "lang string, term string, n long")
    return counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term")


PACKED = "root int, arcs binary, targets binary, skips binary, finals binary, n_terms long"


def transducers(kept: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per transducer: lang, the ordinal of its first term, its shelf, its arrays; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("lang", pa.string()), ("root", pa.int32()), *[(c, pa.binary()) for c in ("arcs", "targets", "skips", "finals")], ("n_terms", pa.int64())]
        )

        def made(lang: str, builder: Builder) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"lang": lang, **builder.finish()}], schema)

        builder, current, size = None, None, 0
        for batch in batches:
            for lang, term in zip(batch.column("lang").to_pylist(), batch.column("term").to_pylist(), strict=True):
                if builder and (lang != current or size >= block_bytes):
                    yield made(current, builder)
                    builder = None
                if builder is None:
                    builder, current, size = Builder(), lang, 0
                word = term.encode()
                builder.add(word)
                size += len(word)
        if builder:
            yield made(current, builder)

    ordered = kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    built = cut(ordered.mapInArrow(run, f"lang string, {PACKED}").withColumn("at", F.monotonically_increasing_id()), "transducers")
    # The windows are over one short row for each transducer.
    size = F.expr("length(arcs) + length(targets) + length(skips) + length(finals)").cast("long")
    earlier = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    of_lang = Window.partitionBy("lang").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = built.select("at", "lang", "n_terms", size.alias("size")).select(
        "at",
        F.coalesce(F.sum("n_terms").over(of_lang), F.lit(0)).alias("first"),
        F.floor(F.coalesce(F.sum("size").over(earlier), F.lit(0)) / SHELF_BYTES).alias("shelf"),
    )
    return cut(built.join(placed, "at"), "vocabulary")


def numbered_terms(vocabulary: DataFrame) -> DataFrame:
    """(lang, ordinal, term), read back from the transducers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                terms = pa.array(list(Transducer(row).terms()), pa.binary()).cast(pa.string())
                numbers = pa.array(np.arange(row["first"], row["first"] + len(terms)))
                langs = pa.array([row["lang"]] * len(terms), pa.string())
                yield pa.RecordBatch.from_arrays([langs, numbers, terms], ["lang", "ordinal", "term"])

    return vocabulary.drop("at", "shelf").mapInArrow(run, "lang string, ordinal long, term string")


COUNTED = "lang string, source string, ordinal long, n long"


def _counts(chunk: dict[str, list], shelf: dict[str, list[Transducer]]) -> Iterator[pa.RecordBatch]:
    """The kept terms of a stretch of rows, counted for each group."""
    by_lang = defaultdict(list)
    for row in zip(chunk["lang"], chunk["source"], chunk["text"], strict=True):
        if row[0] in shelf:
            by_lang[row[0]].append(row[1:])
    for lang, rows in by_lang.items():
        sources = sorted({s for s, _ in rows})
        number = {s: k for k, s in enumerate(sources)}
        texts = [folded(t) for _, t in rows]
        data = np.frombuffer(b"\0" + b"\0".join(texts) + b"\0", np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts])
        inside = np.diff((data != 0).astype(np.int8))
        starts = np.flatnonzero(inside == 1) + 1
        lengths = np.flatnonzero(inside == -1) + 1 - starts
        of_row = np.array([number[s] for s, _ in rows], np.int64)[np.searchsorted(ends, starts)]
        for transducer in shelf[lang]:
            ordinals = transducer.ordinals(data, starts, lengths)
            held = ordinals >= 0
            keys, n = np.unique(of_row[held] << 40 | ordinals[held], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(keys), pa.string()),
                    pa.array(sources, pa.string()).take(pa.array(keys >> 40)),
                    pa.array(keys & ((1 << 40) - 1)),
                    pa.array(n.astype(np.int64)),
                ],
                ["lang", "source", "ordinal", "n"],
            )


def recounted(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(lang, source, ordinal, n): the kept terms of every group, one pass of the texts for each shelf."""
    spark = texts.sparkSession
    found = spark.createDataFrame([], COUNTED)
    shelves = [r["shelf"] for r in vocabulary.select("shelf").distinct().orderBy("shelf").collect()]
    for shelf in shelves:
        rows = vocabulary.where(F.col("shelf") == shelf).drop("shelf", "at").collect()  # at most SHELF_BYTES and one more
        packed = spark.sparkContext.broadcast([r.asDict() for r in rows])
        langs = sorted({r["lang"] for r in rows})

        def run(batches: Iterator[pa.RecordBatch], packed=packed) -> Iterator[pa.RecordBatch]:
            loaded = defaultdict(list)
            for row in packed.value:
                loaded[row["lang"]].append(Transducer(row))
            for chunk in _chunks(batches):
                yield from _counts(chunk, loaded)

        counts = texts.where(F.col("lang").isin(langs)).mapInArrow(run, COUNTED)
        found = found.union(cut(counts.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "recounted"))
        packed.destroy()
    return found


def _share(count: str, total: str, kept: str) -> str:
    """The share in billionths of a count among ``kept`` terms that sum to ``total``, exactly."""
    return f"1 + (CAST({UNIT} AS DECIMAL(10, 0)) * ({count} + {PRIOR})) DIV ({total} + {PRIOR} * {kept})"


def _tile_sums(key: tuple, rows: pa.Table) -> pa.Table:
    """Sums of the differences of shares for all pairs of sources in a tile."""
    source, place, share = (rows.column(c).to_numpy() for c in ("number", "place", "share"))
    width = rows.column("width")[0].as_py()
    numbers, which = np.unique(source, return_inverse=True)
    shares = np.zeros((len(numbers), width), np.int64)
    rest = place < 0  # the share of a term that the source does not have
    shares[which[rest]] = share[rest][:, None]
    shares[which[~rest], place[~rest]] = share[~rest]
    first, second, sums = [], [], []
    low, high = key[2].as_py(), key[3].as_py()
    for k in np.flatnonzero(numbers // TILE == low):
        others = np.flatnonzero((numbers // TILE == high) & (numbers > numbers[k]))
        first.append(np.full(len(others), numbers[k]))
        second.append(numbers[others])
        sums.append(np.abs(shares[others] - shares[k]).sum(axis=1))
    n = sum(map(len, sums))
    return pa.table(
        {
            "lang": pa.array([key[0].as_py()] * n, pa.string()),
            **{c: pa.array(np.concatenate(v).astype(np.int64)) for c, v in (("a", first), ("b", second), ("value", sums))},
        }
    )


def pair_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) for source numbers a < b: the sum of the differences of their shares."""
    spans = groups.where("kept > 0")
    rest = spans.select(
        "lang", "number", "kept", F.explode(F.expr(f"sequence(0L, (kept - 1) DIV {SPAN})")).alias("span"),
        F.lit(-1).cast("long").alias("place"), F.expr(_share("0L", "total", "kept")).alias("share"),
    )
    held = counts.join(spans, ["lang", "source"]).select(
        "lang", "number", "kept", F.expr(f"ordinal DIV {SPAN}").alias("span"), F.expr(f"ordinal % {SPAN}").alias("place"),
        F.expr(_share("n", "total", "kept")).alias("share"),
    )
    tiles = spans.groupBy("lang").agg((F.max("number") / TILE).cast("long").alias("last_tile"))
    dealt = (
        rest.union(held)
        .join(tiles, "lang")
        .withColumn("other", F.explode(F.expr("sequence(0L, last_tile)")))
        .select(
            "lang", "span", F.expr(f"least(number DIV {TILE}, other)").alias("low"), F.expr(f"greatest(number DIV {TILE}, other)").alias("high"),
            "number", F.col("place").cast("int").alias("place"), "share", F.expr(f"least({SPAN}, kept - span * {SPAN})").cast("int").alias("width"),
        )
    )
    sums = dealt.groupBy("lang", "span", "low", "high").applyInArrow(_tile_sums, "lang string, a long, b long, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audited(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank: see the module."""
    settle(docs.sparkSession)
    texts = groups_and_texts(docs)
    vocabulary = transducers(kept_terms(texts, min_docs), block_bytes)
    counts = cut(recounted(texts, vocabulary), "term-counts")

    sizes = vocabulary.groupBy("lang").agg(F.sum("n_terms").alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    in_lang = Window.partitionBy("lang").orderBy("source")
    groups = cut(
        texts.select("lang", "source").distinct()
        .join(totals, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .select(
            "lang", "source", F.coalesce("total", F.lit(0).cast("long")).alias("total"), F.coalesce("kept", F.lit(0).cast("long")).alias("kept"),
            (F.row_number().over(in_lang) - 1).cast("long").alias("number"),
        ),
        "groups",
    )

    values = pair_values(counts, groups)
    one, other = groups.select("lang", "source", "number"), groups.select("lang", F.col("source").alias("item"), F.col("number").alias("item_number"))
    pairs = (
        one.join(other, "lang").where("number <> item_number")
        .withColumns({"a": F.least("number", "item_number"), "b": F.greatest("number", "item_number")})
        .join(values, ["lang", "a", "b"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))

    whole = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("n_lang"))
    whole_total = groups.groupBy("lang").agg(F.sum("total").alias("total_lang"))
    shares = with_once(
        counts.join(groups, ["lang", "source"]).join(whole, ["lang", "ordinal"]).join(whole_total, "lang"),
        {"value": F.expr(f"({_share('n', 'total', 'kept')}) - ({_share('n_lang', 'total_lang', 'kept')})")},
    ).where("value > 0")
    by_ordinal = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    terms = (
        shares.select("lang", "source", "ordinal", "value", F.row_number().over(by_ordinal).alias("rank"))
        .where(F.col("rank") <= top_terms)
        .join(numbered_terms(vocabulary), ["lang", "ordinal"])
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    )
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")

"""Benchmark decontamination: MinHash containment search, verified exactly.

An item of the benchmark is found in a document when the document's shingle set
holds at least ``percent`` of the item's.  The item may be far smaller than the
document, so sets are compared within partitions by size: a partition of documents
up to ``u`` shingles and one of items from ``q`` shingles turn the containment
into a Jaccard similarity of at least ``t q / (u + q - t q)``, and get the number
of bands and rows that let a true pair pass with the chance ``1 - MISS``, out of one
sketch of fixed width per set.  Where documents are so much longer that even single
places of the sketch cannot promise that, a sketch as wide as needed would be no
smaller than the set itself: the document's whole set is then searched for the
item's shingles.  Every candidate is verified on the full shingle sets.

The benchmark goes to the tasks in blocks of ``BLOCK_SHINGLES`` shingles at most
(more only for a single larger item), so what a task holds of it is bounded; each
block passes over the documents once and the hits are united.

Cases: a null or empty text has no shingles and neither finds nor is found; a text
of fewer than five words is one shingle, so a short item is found only in an equal
short text; rows of the benchmark that share an item_id are found when any of them
is, and a row without item_id is no item; an empty benchmark finds nothing; every
row of the documents gives one row, whatever its doc_id; a text may be of any length;
an empty table gives an empty one; other columns pass through, whatever their names.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.shared import id_text, settle, shingle_set
from newsloom.llm.sketch import band_keys, sketch

#: Percent of an item's shingles that a document must hold.
PERCENT = 75
#: Places of every sketch, and the chance that a true pair is no candidate.
PLACES = 256
MISS = 1e-5
#: Shingles of the benchmark that a task holds at once.
BLOCK_SHINGLES = 1_000_000


def size_class(size: int) -> int:
    """The partition of sets from ``2**c`` to ``2**(c + 1) - 1`` elements."""
    return int(size).bit_length() - 1


def banding(doc_class: int, item_class: int, percent: int = PERCENT) -> tuple[int, int] | None:
    """(rows, bands) for two partitions; None where the sketch is too narrow."""
    t = percent / 100
    most, least = 2 ** (doc_class + 1) - 1, 2**item_class
    largest_item = 2 ** (item_class + 1) - 1
    # The smallest similarity is that of the smallest item in the largest document.
    similarity = min(t * q / (most + q - t * q) for q in (least, largest_item))
    chosen = None
    for rows in (1, 2, 3, 4):
        bands = math.ceil(math.log(MISS) / math.log1p(-(min(similarity, 0.999) ** rows)))
        if rows * bands <= PLACES:
            chosen = rows, bands
    return chosen


class Items:
    """A block of the benchmark as the tasks search it."""

    def __init__(self, ids: list, sets: list[np.ndarray], percent: int):
        self.ids, self.sets, self.percent = ids, sets, percent
        self.classes = defaultdict(list)
        for k, found in enumerate(sets):
            self.classes[size_class(len(found))].append(k)
        self.sketches = [sketch(found, PLACES) for found in sets]
        self.tables = {}
        self.shapes = {}

    def index(self, item_class: int, shape: tuple[int, int] | None) -> Index:
        """The items of a partition by their band keys, or without a shape by all their shingles."""
        if (item_class, shape) not in self.tables:
            members = self.classes[item_class]
            keys = [self.sets[k] if shape is None else band_keys(self.sketches[k], *shape) for k in members]
            owners = np.repeat(np.array(members), [len(k) for k in keys])
            self.tables[item_class, shape] = Index(np.concatenate(keys), owners)
        return self.tables[item_class, shape]

    def shape(self, doc_class: int, item_class: int) -> tuple[int, int] | None:
        if (doc_class, item_class) not in self.shapes:
            self.shapes[doc_class, item_class] = banding(doc_class, item_class, self.percent)
        return self.shapes[doc_class, item_class]

    def candidates(self, found: np.ndarray) -> set[int]:
        chosen, places = set(), None
        doc_class = size_class(len(found))
        for item_class in self.classes:
            if 2**item_class * self.percent > 100 * len(found):
                continue  # too few shingles for the smallest of these items
            shape = self.shape(doc_class, item_class)
            if shape is not None and places is None:
                places = sketch(found, PLACES)
            wanted = found if shape is None else band_keys(places, *shape)
            chosen.update(self.index(item_class, shape).owners_of(wanted))
        return chosen

    def hits(self, text: str | None) -> list[tuple[int, int]]:
        """(item, shared shingles) of the items found in a text."""
        found = shingle_set(text)
        if not len(found):
            return []
        hits = []
        for k in sorted(self.candidates(found)):
            item = self.sets[k]
            at = np.minimum(np.searchsorted(found, item), len(found) - 1)
            shared = int((found[at] == item).sum())
            if 100 * shared >= self.percent * len(item):
                hits.append((self.ids[k], shared))
        return hits


class Index:
    """Sorted keys with their owners; a bitmap of the keys' leading bits answers most misses."""

    def __init__(self, keys: np.ndarray, owners: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], owners[order]
        self.marked = np.zeros(1 << 20, bool)
        self.marked[self.keys >> np.uint64(44)] = True

    def owners_of(self, wanted: np.ndarray) -> list[int]:
        likely = wanted[self.marked[wanted >> np.uint64(44)]]
        low, high = np.searchsorted(self.keys, likely, "left"), np.searchsorted(self.keys, likely, "right")
        return [k for a, b in zip(low.tolist(), high.tolist(), strict=True) for k in self.owners[a:b].tolist()]


def _blocks(benchmark: DataFrame):
    """The benchmark's rows, a bounded block at a time."""
    ids, sets, held = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    for row in rows.where("item_id IS NOT NULL").toLocalIterator():
        found = shingle_set(row["text"])
        if not len(found):
            continue
        if sets and held + len(found) > BLOCK_SHINGLES:
            yield ids, sets
            ids, sets, held = [], [], 0
        ids.append(row["item_id"])
        sets.append(found)
        held += len(found)
    if sets:
        yield ids, sets


def found_items(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(row columns of ``docs``, items): all its columns, and the sorted item ids found in ``text``.

    ``items`` is an array of item_id as text; the texts are not shuffled.
    """
    spark = settle(docs.sparkSession)
    name = "items"
    while name in docs.columns:
        name = "_" + name
    at = docs.columns.index("text")
    schema = T.StructType(docs.schema.fields + [T.StructField(name, T.ArrayType(T.StringType()))])
    out = docs.withColumn(name, F.array().cast("array<string>"))
    for ids, sets in _blocks(benchmark):
        block = spark.sparkContext.broadcast((ids, sets))

        def run(batches, block=block):
            items = Items(*block.value, percent)
            for batch in batches:
                earlier = batch.column(batch.num_columns - 1).to_pylist()
                found = [
                    sorted({*(x or []), *(k for k, _ in items.hits(text))})
                    for x, text in zip(earlier, batch.column(at).to_pylist(), strict=True)
                ]
                columns = [*batch.columns[:-1], pa.array(found, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

        out = out.mapInArrow(run, schema)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_ids, n_items, contaminated), one row per row of ``docs``; item ids in order."""
    kind = benchmark.schema["item_id"].dataType
    rows = found_items(id_text(docs), benchmark, percent)
    item_ids = F.array_sort(F.col("items").cast(T.ArrayType(kind)))
    return rows.select("doc_id", item_ids.alias("item_ids")).select(
        "doc_id", "item_ids", F.size("item_ids").cast("long").alias("n_items"), (F.size("item_ids") > 0).alias("contaminated")
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents with their columns, without those that hold an item."""
    rows = found_items(docs, benchmark, percent)
    return rows.where(F.size(rows.columns[-1]) == 0).select(*docs.columns)

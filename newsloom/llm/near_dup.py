"""Near duplicates: similarity sketches, banding, exact verification, components.

Two documents are linked when their shingle sets have
``100 * intersection >= 75 * union``.  Documents with equal sets are one class,
represented by the smallest id.  Classes that share a band of the sketch are
candidates; a pair is dropped when sizes exclude the link or when the sketches
agree in so few places that a link has a chance below 1e-9, and what remains is
verified on the full sets.  With 32 bands of 4 places a linked pair at the limit
misses all bands with the chance 5e-6.

A bucket of candidates is not expanded into pairs.  Its members are compared with
one centre, the member that shares most buckets with others; verified links join
components, and a bucket that lies in one component is closed.  After two such
rounds the documents of the buckets still open, mostly ones that share a passage and
little else, are put into new buckets by their rarest shingles, where few of them
can still be linked (see ``_rare_shingles``).  More and more centres follow there, only
between different components, until every member has been compared, joined or
excluded.  So a group of near copies costs about its size, and no link between
different components is lost.

Sets are 64-bit shingle ids, so two different shingles of a compared pair count as
equal with a chance near 1e-11.

Cases: a null or empty text has the empty set and is linked with nothing; a text of
fewer than five words is one shingle; rows that share a doc_id are one document,
linked by any of its texts, and stay or go together; a row without doc_id is
linked with nothing, has no component and stays; an empty table gives an empty one;
other columns pass through, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.shared import components, cut, id_text, map_batches, settle, shingle_set, wanted
from newsloom.llm.sketch import band_keys, sketch

#: A link: 100 * intersection >= PERCENT * union.
PERCENT = 75
PLACES = 128
BAND_ROWS = 4
#: Rounds of one centre for each bucket of a band.
ROUNDS = 2
#: The chance with which a linked pair may be dropped by its sketches.
MISS = 1e-9


def fewest_agreements(places: int = PLACES, percent: int = PERCENT, miss: float = MISS) -> int:
    """Agreements that a linked pair falls short of with at most the chance ``miss`` (exact binomial)."""
    p, total = percent / 100, 0.0
    for k in range(places + 1):
        total += math.comb(places, k) * p**k * (1 - p) ** (places - k)
        if total > miss:
            return k
    return places


def summarised(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands, sketch) of each document."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, keys, bands, bytes_ = [], [], [], []
        for text in batch.column(1).to_pylist():
            found = shingle_set(text)
            sizes.append(len(found))
            keys.append(xxhash.xxh3_128_digest(found.tobytes()))
            if len(found):
                places = sketch(found, PLACES)
                bands.append(band_keys(places, BAND_ROWS, PLACES // BAND_ROWS).view(np.int64))
                # The places' low bits name the place; the byte above them is compared.
                bytes_.append(((places >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8).tobytes())
            else:
                bands.append(np.empty(0, np.int64))
                bytes_.append(b"")
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(bytes_, pa.binary()),
            ],
            names=["doc_id", "n_shingles", "set_key", "bands", "sketch"],
        )

    return map_batches(
        id_text(docs), work, "doc_id long, n_shingles long, set_key binary, bands array<long>, sketch binary"
    )


def _plausible(pairs: DataFrame, summary: DataFrame) -> DataFrame:
    """Pairs whose sizes and sketches leave a link possible."""
    small = summary.select("doc_id", "n_shingles", "sketch")
    joined = pairs.join(small.toDF("a", "na", "sa"), "a").join(small.toDF("b", "nb", "sb"), "b")
    joined = joined.where(100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")).select("a", "b", "sa", "sb")
    # One byte of a place agrees by chance in 1 of 256; that only lets more pairs through.
    least = fewest_agreements()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        left = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, PLACES)
        right = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, PLACES)
        enough = (left == right).sum(axis=1) >= least
        return pa.RecordBatch.from_arrays(
            [batch.column(0).filter(pa.array(enough)), batch.column(1).filter(pa.array(enough))], names=["a", "b"]
        )

    return map_batches(joined, work, "a long, b long")


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, set) of the documents named; of the other texts only what a Bloom filter lets through is shuffled."""
    texts = id_text(docs).join(wanted(ids), "doc_id", "left_semi")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingle_set(text).tobytes() for text in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "set"])

    return cut(map_batches(texts, work, "doc_id long, set binary"), "dup-sets")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that the full sets link."""
    known = wanted(sets)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = []
        for left, right in zip(batch.column(2), batch.column(3), strict=True):
            x = np.frombuffer(left.as_buffer(), np.uint64)
            y = np.frombuffer(right.as_buffer(), np.uint64)
            both = len(x) + len(y) - len(np.union1d(x, y))
            held.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        mask = pa.array(held, pa.bool_())
        return pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    joined = pairs.join(known.toDF("a", "x"), "a").join(known.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return map_batches(joined, work, "a long, b long").distinct()


def _buckets(summary: DataFrame, classes: DataFrame) -> DataFrame:
    """(bucket, doc, share, n, size): classes in bands shared by two or more."""
    reps = summary.where("n_shingles > 0").join(
        classes.select("set_key", F.col("rep").alias("doc_id")), ["set_key", "doc_id"], "left_semi"
    )
    bands = reps.dropDuplicates(["doc_id", "set_key"]).select(
        F.explode("bands").alias("bucket"), F.col("doc_id").alias("doc"), F.col("n_shingles").alias("share")
    )
    shared = bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return cut(bands.join(shared, "bucket").withColumn("n", F.col("share")), "dup-buckets")


def _rare_shingles(sets: DataFrame, open_docs: DataFrame) -> DataFrame:
    """(bucket, doc, share, n, size): the open documents under their rarest shingles.

    Shingles are ordered from rare to frequent; one that a single open document
    holds comes before all others and joins nothing.  ``share`` is the number of
    shingles of the set from this one on.  The first shingle that two linked sets
    have in common leaves each of them as many as they share, three quarters at
    least; so a set needs no bucket for shingles with fewer from there on, and in a
    bucket two sets that cannot share enough from there on are not compared.
    """
    known = sets.join(wanted(open_docs), "doc_id", "left_semi")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.list_(pa.int64()))], names=["doc", "shingles"])

    listed = map_batches(known, work, "doc long, shingles array<long>")
    rows = cut(listed.select("doc", F.size("shingles").alias("n"), F.explode("shingles").alias("bucket")), "dup-shingles")
    counts = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    # What a set holds alone takes the first places of its order and needs no row.
    shared = rows.join(counts, "bucket")
    behind = F.row_number().over(Window.partitionBy("doc", "n").orderBy(F.desc("size"), F.desc("bucket")))
    kept = shared.withColumn("share", behind).where(100 * F.col("share") >= PERCENT * F.col("n"))
    return cut(kept.select("bucket", "doc", "share", F.col("n").cast("long").alias("n"), "size"), "dup-buckets")


def _may_link(share: str, n: str, other_share: str, other_n: str) -> Column:
    """Whether two sets can be linked by their sizes and the parts that they can share."""
    return (100 + PERCENT) * F.least(share, other_share) >= PERCENT * (F.col(n) + F.col(other_n))


class _Search:
    """Rounds of comparing the members of buckets with centres; ``places`` is what they have joined."""

    def __init__(self, summary: DataFrame, sets: DataFrame):
        spark = summary.sparkSession
        self.summary, self.sets = summary, sets
        self.found = self.tested = spark.createDataFrame([], "a long, b long")
        self.places = spark.createDataFrame([], "node long, component long")

    def rounds(self, members: DataFrame, limit: int | None = None) -> DataFrame:
        """Members of the buckets still open after ``limit`` rounds of one centre each.

        Without a limit there are 256, 65,536 ... centres, until none is open.
        """
        reach = members.groupBy("doc").agg(F.sum("size").alias("reach"))
        # A document that has several sets is in a bucket by the largest.
        members = members.groupBy("bucket", "doc").agg(F.max("share").alias("share"), F.min("n").alias("n"))
        members, done = members.join(reach, "doc"), 0
        while True:
            here = members.join(self.places, members.doc == self.places.node, "left").select(
                "bucket", "doc", "share", "n", "reach", F.coalesce("component", "doc").alias("component")
            )
            split = here.groupBy("bucket").agg(
                F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")
            )
            here = cut(here.join(split.where("low < high").select("bucket", "size"), "bucket"), "dup-members")
            if done == limit or here.isEmpty():
                return here
            centres = 1 if limit else 256 ** (done + 1)
            nth = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("reach"), "doc"))
            chosen = here.withColumn("nth", nth).where(F.col("nth") <= centres)
            names = {"doc": "centre", "share": "centre_share", "n": "centre_n", "component": "own"}
            chosen = cut(chosen.select("bucket", *[F.col(c).alias(name) for c, name in names.items()]), "dup-centres")
            met = here.join(chosen, "bucket").where("component != own").where(_may_link("share", "n", "centre_share", "centre_n"))
            pairs = met.select(F.least("doc", "centre").alias("a"), F.greatest("doc", "centre").alias("b")).distinct()
            self._compare(cut(pairs.join(self.tested, ["a", "b"], "left_anti"), "dup-pairs"))
            # In a bucket of one member more than centres every pair has been compared.
            members = here.where(F.col("size") > centres + 1).join(
                chosen.select("bucket", F.col("centre").alias("doc")), ["bucket", "doc"], "left_anti"
            )
            members, done = members.select("bucket", "doc", "share", "n", "reach"), done + 1

    def _compare(self, pairs: DataFrame) -> None:
        self.tested = self.tested.union(pairs)
        plausible = cut(_plausible(pairs, self.summary), "dup-plausible")
        linked = cut(_linked(plausible, self.sets), "dup-links")
        if not linked.isEmpty():
            self.found = self.found.union(linked)
            self.places = components(self.found)


def links(docs: DataFrame, summary: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, component) of the classes' representatives that have a link."""
    members = _buckets(summary, classes)
    sets = _sets(docs, cut(members.select(F.col("doc").alias("doc_id")).distinct(), "dup-ids"))
    search = _Search(summary, sets)
    still_open = search.rounds(members, ROUNDS)
    if not still_open.isEmpty():
        open_docs = cut(still_open.select(F.col("doc").alias("doc_id")).distinct(), "dup-ids")
        search.rounds(_rare_shingles(sets, open_docs))
    return search.places


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    settle(docs.sparkSession)
    summary = cut(summarised(docs), "dup-summary")
    named = summary.where("doc_id IS NOT NULL")
    classes = cut(named.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("rep")), "dup-classes")
    # A document of several texts ties their classes together.
    held = named.join(classes, "set_key", "left").select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"))
    held = cut(held, "dup-members")
    places = links(docs, summary, classes)
    several = held.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    if not several.isEmpty():
        ties = held.join(several.select("doc_id"), "doc_id", "left_semi").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
        places = components(places.toDF("a", "b").union(ties))
    rows = held.join(places, held.rep == places.node, "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
    unnamed = summary.where("doc_id IS NULL").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return rows.union(unnamed).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def kept_documents(docs: DataFrame, as_came: DataFrame | None = None) -> DataFrame:
    """The documents with their columns, without those that a smaller id stands for.

    With ``as_came`` the texts that the documents' ids have there are compared, not
    those in ``docs``: earlier steps may have cut texts so that copies no longer look
    alike.  Only ids of ``docs`` take part, so one document of each group stays.
    """
    texts = docs
    if as_came is not None:
        settle(docs.sparkSession)
        ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
        texts = cut(id_text(as_came).join(wanted(cut(ids, "dup-ids")), "doc_id", "left_semi"), "dup-texts")
    gone = cut(near_duplicates(texts).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct(), "dup-gone")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")

"""Exact substring duplicates by blockwise suffix sorting with a difference cover.

A byte is removed when a string of ``WIDTH`` bytes over it also starts in a document
of a smaller doc_id.  So the suffixes of all documents are sorted by their first
``WIDTH`` bytes, and within each class of equals those of larger ids are copies.

Suffixes are dealt into buckets by the least hash of the ``GRAM``-byte strings in
their first ``WIDTH`` bytes.  Equal suffixes have equal buckets, and neighbours mostly
share theirs, so a run of neighbouring suffixes travels as one segment of text
instead of one string each.  A segment that a smaller document of the same task has
too is settled there and is not sent, so a passage that a third of all documents
share arrives once for each task.

One bucket at a time is sorted, so memory is bounded by the size of a bucket, about
``BUCKET_BYTES`` of the corpus.  Suffixes are sorted by a 64-bit fingerprint of the
first ``WIDTH`` bytes; the order within a class does not matter, equality does.
Ties, which is what long repeats are, are resolved by a difference cover: the
positions whose residue modulo ``PERIOD`` lies in ``COVER`` are sampled, and the
samples are ranked beforehand by their next ``WIDTH - PERIOD + 1`` bytes.  For any two
suffixes there is a shift below ``PERIOD`` that takes both to samples; they are
equal when those ranks are and the few bytes before and behind are.  Tied suffixes
that turn out to differ are told apart by their bytes.

Documents longer than a task's chunk are cut into pieces that overlap by
``WIDTH - 1`` bytes.  Texts are UTF-8 bytes; matches never cross documents.

Cases: a null text is empty; a text shorter than ``WIDTH`` has no string and loses
nothing; rows that share a doc_id are told apart by their text and are never each
other's copy; a row without doc_id has no place in the order and loses nothing; an
empty table gives an empty one; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.shared import cut, map_batches, mixed, settle, wanted

WIDTH = 50
#: Bytes whose least hash chooses the bucket.
GRAM = 10
#: A perfect difference set: every residue but 0 is one difference of two members.
PERIOD = 21
COVER = (0, 1, 4, 14, 16)
#: Bytes of text that a task prepares at once, of segments it gathers before it
#: packs them bucket by bucket, and of the corpus in a bucket.
CHUNK_BYTES = 4 << 20
PACK_BYTES = 48 << 20
BUCKET_BYTES = 2 << 20
#: Positions worked on at a time, so that what is in hand stays in the cache.
BLOCK = 1 << 15

_NEXT = WIDTH - PERIOD + 1  # bytes that a sample is ranked by
_K = mixed(np.arange(1, 9, dtype=np.uint64)) | np.uint64(1)


def shifts() -> np.ndarray:
    """For each two residues the least shift that takes both into the cover."""
    found = np.full((PERIOD, PERIOD), -1, np.int64)
    for shift in range(PERIOD - 1, -1, -1):
        inside = np.isin((np.arange(PERIOD) + shift) % PERIOD, COVER)
        found[np.ix_(inside, inside)] = shift
    return found


SHIFTS = shifts()


def _words(raw: bytes) -> np.ndarray:
    """The eight bytes from every position, as one unsigned number; ``raw`` is padded by 7 bytes."""
    return np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))


def segments(raw: bytes, piece_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, key) of the runs of suffixes with one least gram hash.

    ``raw`` is the pieces one after the other; ``piece_of`` is the piece of each byte.
    A segment reaches from its first suffix to the last byte of its last one.
    """
    n = len(raw) - WIDTH + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),)
    words, span = _words(raw + b"\0" * 7), WIDTH - GRAM + 1
    least = np.empty(n, np.uint64)
    for low in range(0, n, BLOCK):
        high = min(low + BLOCK, n) + span - 1
        part = words[low:high] * _K[0]
        part += words[low + GRAM - 8 : high + GRAM - 8] * _K[1]
        part = mixed(part)
        width = 1
        while width < span:  # the minimum over windows twice as wide each time
            step = min(width, span - width)
            part = np.minimum(part[:-step], part[step:])
            width += step
        least[low : low + len(part)] = part
    inside = piece_of[:n] == piece_of[WIDTH - 1 :]
    new = np.empty(n, bool)
    new[0] = True
    new[1:] = (least[1:] != least[:-1]) | (piece_of[1:n] != piece_of[: n - 1]) | ~inside[:-1]
    starts = np.flatnonzero(new & inside)
    ends_at = np.flatnonzero(inside & np.append(new[1:] | ~inside[1:], True))
    return starts, ends_at + WIDTH, least[starts]


def _planes(values: np.ndarray) -> bytes:
    """Numbers as differences, byte by byte of equal weight: mostly zeros, which pack well."""
    steps = np.diff(values.astype(np.int64), prepend=0)
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(raw: bytes) -> np.ndarray:
    steps = np.frombuffer(raw, np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view(np.int64).ravel())


Segments = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]


def pack(parts: list[Segments]) -> bytes:
    """Segments of one bucket: doc ids, text ids, each segment's document, start and length, and the text."""
    sizes = np.array([len(p[0]) for p in parts])
    owner = np.concatenate([p[2] + before for p, before in zip(parts, np.cumsum(sizes) - sizes, strict=True)])
    columns = [np.concatenate([p[k] for p in parts]) for k in (0, 1, 3, 4)]
    columns.insert(2, owner)
    counts = np.array([len(c) for c in columns], np.int64)
    raw = [counts.tobytes(), *map(_planes, columns), *(p[5] for p in parts)]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(raw))


def unpack(raw: bytes) -> Segments:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    at, columns = 5 * 8, []
    for size in np.frombuffer(raw, np.int64, 5).tolist():
        columns.append(_numbers(raw[at : at + 8 * size]))
        at += 8 * size
    return *columns, raw[at:]


Piece = tuple[int, int, int, bytes]  # doc_id, text id, offset in the text, bytes


def prepared(pieces: list[Piece], buckets: int) -> Iterator[tuple[int, Segments | None, tuple | None]]:
    """(bucket, segments, None) for each bucket, and (_, None, spans) settled here.

    Spans are arrays of doc_id, text id, start, end.
    """
    pieces = sorted(pieces, key=lambda p: p[:3])
    raw = b"".join(p[3] for p in pieces)
    ids = np.array([p[0] for p in pieces], np.int64)
    texts = np.array([p[1] for p in pieces], np.int64)
    sizes = np.array([len(p[3]) for p in pieces], np.int64)
    first = np.cumsum(sizes) - sizes
    offset = np.array([p[2] for p in pieces], np.int64) - first
    starts, ends, keys = segments(raw, np.repeat(np.arange(len(pieces), dtype=np.int32), sizes))
    if not len(starts):
        return
    owner = np.searchsorted(first, starts, "right") - 1
    # Empty pieces share their first byte with the next one, which comes last among equals.
    order = np.lexsort((starts, ends - starts, keys))
    leader = np.arange(len(starts))
    same = (keys[order][1:] == keys[order][:-1]) & ((ends - starts)[order][1:] == (ends - starts)[order][:-1])
    for a, b in zip(order[:-1][same].tolist(), order[1:][same].tolist(), strict=True):
        k = leader[a]
        if raw[starts[k] : ends[k]] == raw[starts[b] : ends[b]]:
            leader[b] = k
    copy = ids[owner] > ids[owner[leader]]
    if copy.any():
        own = owner[copy]
        yield -1, None, (ids[own], texts[own], starts[copy] + offset[own], ends[copy] + offset[own])
    sent = np.flatnonzero(~copy)
    bucket = (mixed(keys[sent]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sent, bucket = sent[order], bucket[order]
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        chosen = sent[low:high]
        held, at = np.unique(owner[chosen], return_inverse=True)
        text = b"".join([raw[a:b] for a, b in zip(starts[chosen].tolist(), ends[chosen].tolist(), strict=True)])
        own = owner[chosen]
        yield int(bucket[low]), (ids[held], texts[held], at, starts[chosen] + offset[own], ends[chosen] - starts[chosen], text), None


def equal_classes(raw: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes, class): those of the positions ``at`` whose first WIDTH bytes occur twice.

    The classes are numbered in the order of their fingerprints.
    """
    words = _words(raw + b"\0" * 7)
    prints = np.empty(len(at), np.uint64)
    for low in range(0, len(at), BLOCK):
        here = at[low : low + BLOCK]
        part = words[here] * _K[0]
        for k, shift in enumerate((8, 16, 24, 32, 40, WIDTH - 8), 1):
            part += words[here + shift] * _K[k]
        prints[low : low + BLOCK] = mixed(part)
    ordered = np.sort(prints)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    del ordered
    # A bitmap of the leading bits leaves few suffixes to be looked up.
    marked = np.zeros(1 << 22, bool)
    marked[twice >> np.uint64(42)] = True
    few = np.flatnonzero(marked[prints >> np.uint64(42)])
    few = few[np.isin(prints[few], twice)]
    few = few[np.argsort(prints[few], kind="stable")]
    at, prints = at[few], prints[few]
    if not len(at):
        return at, np.empty(0, np.int64)
    new = np.r_[True, prints[1:] != prints[:-1]]
    classes = np.cumsum(new) - 1
    leaders = at[np.flatnonzero(new)][classes]

    # The cover's samples that a tie will ask for, ranked by their bytes.
    shift = SHIFTS[at % PERIOD, leaders % PERIOD]
    asked = np.zeros(len(raw), bool)
    asked[at + shift] = True
    asked[leaders + shift] = True
    samples = np.flatnonzero(asked)
    keys = [words[samples + k].byteswap() for k in (0, 8, 16, _NEXT - 8)]
    order = np.lexsort(keys[::-1])
    differs = np.zeros(len(order), np.int64)
    for key in keys:
        differs[1:] |= key[order][1:] != key[order][:-1]
    ranks = np.empty(len(raw), np.int32)
    ranks[samples[order]] = np.cumsum(differs)

    tied = ranks[at + shift] == ranks[leaders + shift]
    for k in (0, 8, PERIOD - 9, _NEXT, _NEXT + 8, WIDTH - 8):  # before the shift, and behind the ranked bytes
        tied &= words[at + k] == words[leaders + k]
    if not tied.all():
        mixed_up = np.isin(classes, np.unique(classes[~tied]))
        strings = [raw[a : a + WIDTH] for a in at[mixed_up].tolist()]
        names = {s: k for k, s in enumerate(sorted(set(strings)))}
        classes[mixed_up] = classes[-1] + 1 + np.array([names[s] for s in strings])
        order = np.argsort(classes, kind="stable")
        at, classes = at[order], classes[order]
    return at, classes


def sorted_bucket(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc_id, text id, start, end) of the copies in the segments of one bucket."""
    ids, texts, starts, lengths, parts = [], [], [], [], []
    for payload in payloads:
        held, held_texts, owner, start, length, text = unpack(payload)
        ids.append(held[owner])
        texts.append(held_texts[owner])
        starts.append(start)
        lengths.append(length)
        parts.append(text)
    ids, texts, starts, lengths = map(np.concatenate, (ids, texts, starts, lengths))
    raw = b"".join(parts)
    del parts
    first = np.cumsum(lengths) - lengths
    suffixes = lengths - (WIDTH - 1)
    at = np.repeat(first - (np.cumsum(suffixes) - suffixes), suffixes)
    at += np.arange(len(at))
    at, classes = equal_classes(raw, at)
    if not len(at):
        return tuple(np.empty(0, np.int64) for _ in range(4))
    owner = np.searchsorted(first, at, "right") - 1
    edges = np.flatnonzero(np.r_[True, classes[1:] != classes[:-1]])
    smallest = np.repeat(np.minimum.reduceat(ids[owner], edges), np.diff(np.r_[edges, len(at)]))
    copy = ids[owner] > smallest
    at, owner = at[copy], owner[copy]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    if not len(at):
        return tuple(np.empty(0, np.int64) for _ in range(4))
    opens = np.r_[True, (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])]
    closes = np.r_[opens[1:], True]
    own = owner[opens]
    shift = starts[own] - first[own]
    return ids[own], texts[own], at[opens] + shift, at[closes] + shift + WIDTH


_SPAN = "doc_id long, text_id long, start long, end long"


def copied_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_id, start, end): spans of copies, overlapping where they do, from (doc_id, text_id, text)."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(1, math.ceil(size / BUCKET_BYTES))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[Segments]] = {}
        spans: list[tuple[int, bytes]] = []
        held = 0

        def settle_chunk(pieces: list[Piece]) -> int:
            size = 0
            for bucket, found, settled in prepared(pieces, buckets):
                if found is None:  # takes part in no sorting; dealt by chance
                    spans.append((int(settled[2].sum() % buckets), np.stack(settled).astype(np.int64).tobytes()))
                else:
                    waiting.setdefault(bucket, []).append(found)
                    size += len(found[5])
            return size

        def out() -> pa.RecordBatch:
            where = [*waiting, *(b for b, _ in spans)]
            packed = [*map(pack, waiting.values()), *[None] * len(spans)]
            settled = [*[None] * len(waiting), *(raw for _, raw in spans)]
            waiting.clear()
            spans.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(where, pa.int64()), pa.array(packed, pa.binary()), pa.array(settled, pa.binary())],
                names=["bucket", "packed", "spans"],
            )

        pieces, size = [], 0
        for batch in batches:
            for doc_id, text_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode()
                for offset in range(0, max(len(raw) - WIDTH + 1, 0), CHUNK_BYTES):
                    pieces.append((doc_id, text_id, offset, raw[offset : offset + CHUNK_BYTES + WIDTH - 1]))
                    size += len(pieces[-1][3])
                    if size >= CHUNK_BYTES:
                        held += settle_chunk(pieces)
                        pieces, size = [], 0
                    if held >= PACK_BYTES:
                        yield out()
                        held = 0
        if pieces:
            settle_chunk(pieces)
        if waiting or spans:
            yield out()

    def sort(table: pa.Table) -> pa.Table:
        packed = [x for x in table.column("packed").to_pylist() if x is not None]
        found = [np.frombuffer(x, np.int64).reshape(4, -1) for x in table.column("spans").to_pylist() if x is not None]
        if packed:
            found.append(np.stack(sorted_bucket(packed)))
        every = np.concatenate(found, axis=1)
        return pa.table({name: pa.array(every[k]) for k, name in enumerate(("doc_id", "text_id", "start", "end"))})

    dealt = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(prepare, "bucket long, packed binary, spans binary")
    return dealt.groupBy("bucket").applyInArrow(sort, _SPAN)


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Maximal spans, in order."""
    found: list[list[int]] = []
    for start, end in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1][1] = max(found[-1][1], end)
        else:
            found.append([start, end])
    return found


def deduplicated(docs: DataFrame, keep_bytes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs``.

    With ``keep_bytes`` also ``kept``, the bytes that are left: cutting may split a
    character, so they need not be a text.  Only the texts of documents that lose
    something are shuffled.
    """
    settle(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Rows that share a doc_id are told apart by their text; mostly there are none, and 0 packs best.
    several = cut(narrow.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 AND doc_id IS NOT NULL").drop("n"), "substring-ids")
    alike = narrow.join(several.withColumn("again", F.lit(True)), "doc_id", "left")
    narrow = alike.select("doc_id", F.when(F.col("again"), F.xxhash64("text")).otherwise(F.lit(0).cast("long")).alias("text_id"), "text")
    spans = copied_spans(narrow).groupBy("doc_id", "text_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    spans = cut(spans, "substring-spans")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text, found in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            raw, runs = text.encode(), merged([(s["start"], s["end"]) for s in found])
            edges = [0, *(x for run in runs for x in run), len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            rows.append((len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
        made = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=names)

    names = ["doc_id", "text_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    hit = narrow.join(wanted(spans), ["doc_id", "text_id"])
    cut_texts = cut(
        map_batches(
            hit.dropDuplicates(["doc_id", "text_id"]),
            work,
            "doc_id long, text_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
        ),
        "substring-kept",
    )
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = narrow.select(
        "doc_id", "text_id", F.octet_length(raw).cast("long").alias("size"), F.sha2(raw, 256).alias("sha"),
        *([raw.alias("bytes")] if keep_bytes else []),
    )
    joined = rows.join(cut_texts, ["doc_id", "text_id"], "left")
    return joined.select(
        "doc_id",
        F.col("size").alias("n_bytes"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        *([F.coalesce("kept", "bytes").alias("kept")] if keep_bytes else []),
    )

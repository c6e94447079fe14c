"""Tokens of two tokenizers laid side by side, each distinct text worked on once.

A text with a blank before it is cut into tokens by a byte-level vocabulary (A) and a
piece vocabulary (B).  Both are read as runs of the same bytes.  Offsets where a token
of both ends cut the text into groups; an A token and a B token are linked where their
byte ranges overlap.  As tokens leave no gap, every link is one stretch between two
neighbouring ends of either side.

Documents are shuffled by their full text, combined in each task first, so a text
that a third of all documents share arrives once for each task.  A distinct text is
tokenised and aligned once, and counts as often as it has documents.  Texts are worked
on in blocks of ``BLOCK_BYTES``: a block has one row for each id pair in it, with the
documents that hold it, and each of its texts keeps the places of its pairs in the
block's list.  The pair rows are added up and joined with their sums by pair, a hot
pair having one row for each block; the sums go back to their block, whose texts add
them up.  At last the measures meet the doc_ids by a digest of the text; adaptive
execution splits the documents of a hot text.  Nothing is collected or broadcast, and
the memory of a task follows ``BLOCK_BYTES`` or its longest text.

Both vocabulary files are at the same paths on every machine.

Cases: a null or empty text, and one that does not come back byte for byte from both
sides (U+2581 in it, for instance), has no tokens, zeros and no digest; special
strings are ordinary text; rows that share a doc_id or a text each have their row and
count each as a document; ties for an A id's highest count all count as best; other
columns are ignored, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.shared import cut, id_text, settle

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")

#: Bytes of text that are aligned together; tokens that are written out together.
BLOCK_BYTES = 2 << 20
WRITTEN_TOKENS = 1 << 19

MEASURES = ("n_a", "n_b", "n_groups", "n_links")

#: A row is a text (with a digest) or one pair of a block (with a pair).
ALIGNED = (
    "block long, digest binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "places array<int>, times array<int>, place int, pair long, documents long"
)


class Strings:
    """Byte strings by number, laid end to end."""

    def __init__(self, strings: list[bytes]):
        self.sizes = np.fromiter(map(len, strings), np.int32, len(strings))
        self.starts = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        self.flat = np.frombuffer(b"".join(strings), np.uint8)

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        """The bytes of the numbered strings, one after the other."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if max(total, len(self.flat)) < 1 << 31 else np.int64
        shift = (self.starts[numbers] - (ends - sizes)).astype(kind)
        return self.flat[np.repeat(shift, sizes) + np.arange(total, dtype=kind)]


class ByteVocabulary:
    """The tokens of a byte-level vocabulary, with the bytes of each.

    Where the file's merges stand in the order of their ids and its texts are split by
    the usual pattern, tokens are found by rank, which is the same and several times
    faster; otherwise by the file's own tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # Printable bytes are written as themselves, the others by the characters from 256 on.
        printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        others = (b for b in range(256) if b not in printable)
        byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            if all(c in byte_of for c in token):
                self.bytes[number] = bytes(byte_of[c] for c in token)
        self.ranked = self._by_rank()

    def _by_rank(self):
        import tiktoken

        made = json.loads(self.tokenizer.to_str())
        model, split = made["model"], made["pre_tokenizer"] or {}
        numbers = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model.get("merges", [])]
        plain = made["normalizer"] is None and not model.get("ignore_merges") and not model.get("unk_token")
        usual = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        ranks = {token: k for k, token in enumerate(self.bytes) if token}
        if not (plain and usual and numbers == sorted(set(numbers)) and len(ranks) == 256 + len(numbers)):
            return None
        return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def tokens(self, texts: list[str]) -> list[list[int]]:
        if self.ranked is not None:
            return [self.ranked.encode_ordinary(" " + t) for t in texts]
        found = self.tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in found]


class PieceVocabulary:
    """The tokens of a piece vocabulary that puts a blank before a text, with the bytes of each."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)
        ]

    def tokens(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@dataclass
class Vocabularies:
    """Both vocabularies, their tokens' bytes, and ids as they are written, with what may follow one."""

    a: ByteVocabulary
    b: PieceVocabulary
    bytes_a: Strings
    bytes_b: Strings
    ids: int
    written: Strings


@lru_cache(maxsize=4)
def vocabularies(byte_path: str, piece_path: str) -> Vocabularies:
    """Loaded once in each worker."""
    a, b = ByteVocabulary(byte_path), PieceVocabulary(piece_path)
    ids = max(len(a.bytes), len(b.bytes))
    written = [b"%d%s" % (k, after) for after in (b",", b"|", b";", b"") for k in range(ids)]
    return Vocabularies(a, b, Strings(a.bytes), Strings(b.bytes), ids, Strings(written))


class Side:
    """The tokens of one vocabulary in some texts: ids in a row, and how many each text has."""

    def __init__(self, tokens: list[list[int]], strings: Strings):
        self.counts = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.ids = np.fromiter(chain.from_iterable(tokens), np.int32, int(self.counts.sum()))
        self.ends = np.cumsum(strings.sizes[self.ids], dtype=np.int64)
        lasts = np.cumsum(self.counts)
        reached = np.concatenate([[0], self.ends])[np.concatenate([[0], lasts])]
        self.bytes = np.diff(reached)  # of each text

    def marks(self, total: int) -> np.ndarray:
        """For each offset whether a token ends there."""
        found = np.zeros(total + 1, bool)
        found[self.ends] = True
        return found


class Block:
    """The alignment of some texts, none of them empty."""

    def __init__(self, texts: list[str], byte_path: str, piece_path: str):
        both = vocabularies(byte_path, piece_path)
        kept = list(range(len(texts)))
        raw = [b" " + t.encode() for t in texts]
        tokens_a, tokens_b = both.a.tokens(texts), both.b.tokens(texts)
        while True:  # once more where a text does not come back from its tokens
            a = Side([tokens_a[k] for k in kept], both.bytes_a)
            b = Side([tokens_b[k] for k in kept], both.bytes_b)
            sizes = np.fromiter((len(raw[k]) for k in kept), np.int64, len(kept))
            bounds = np.cumsum(sizes)
            right = (a.bytes == sizes) & (b.bytes == sizes)
            if right.all():
                whole = np.frombuffer(b"".join(raw[k] for k in kept), np.uint8)
                for side, strings in ((a, both.bytes_a), (b, both.bytes_b)):
                    wrong = np.flatnonzero(strings.joined(side.ids) != whole)
                    right[np.searchsorted(bounds, wrong, "right")] = False
                if right.all():
                    break
            kept = [k for k, good in zip(kept, right, strict=True) if good]
        #: Which of the texts have tokens; the other attributes are about those alone.
        self.texts, self.n_a, self.n_b = kept, a.counts, b.counts
        total = int(bounds[-1]) if kept else 0
        is_a, is_b = a.marks(total), b.marks(total)
        is_both, is_last = is_a & is_b, np.zeros(total + 1, bool)
        is_last[bounds] = True
        upto_a, upto_b, upto_both, upto_last = (np.cumsum(x, dtype=np.int32) for x in (is_a, is_b, is_both, is_last))
        links, shared = np.flatnonzero(is_a | is_b), np.flatnonzero(is_both)
        text = (upto_last[links] - is_last[links]).astype(np.int64)
        self.n_links = np.bincount(text, minlength=len(kept))
        self.n_groups = np.bincount(upto_last[shared] - is_last[shared], minlength=len(kept))
        self._pairs(text, a.ids[upto_a[links] - is_a[links]], b.ids[upto_b[links] - is_b[links]], both)
        # In the written order the B tokens of earlier groups come before an A token, the A tokens of its group before a B token.
        through_a, through_b = upto_a[shared].astype(np.int64), upto_b[shared].astype(np.int64)
        before_b = np.concatenate([[0], through_b[:-1]]) if len(shared) else through_b
        order = np.empty(len(a.ids) + len(b.ids), np.int32)
        order[np.arange(len(a.ids)) + before_b[upto_both[a.ends] - is_both[a.ends]]] = a.ids
        order[np.arange(len(b.ids)) + through_a[upto_both[b.ends] - is_both[b.ends]]] = b.ids
        order[through_a + before_b - 1] += both.ids  # the last A token of a group
        order[through_a + through_b - 1] += 2 * both.ids  # the last token of a group
        lasts = upto_a[bounds].astype(np.int64) + upto_b[bounds]
        order[lasts - 1] += both.ids  # the last token of a text
        self.digests = list(_digests(order, lasts, both.written))

    def _pairs(self, text: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, both: Vocabularies) -> None:
        """The pairs of the block, and for each text which of them it has, how often."""
        bits_b = len(both.b.bytes).bit_length()
        bits = bits_b + len(both.a.bytes).bit_length()
        keys = text << bits | ids_a.astype(np.int64) << bits_b | ids_b
        keys.sort()
        firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        self.times = np.diff(np.append(firsts, len(keys)))
        held = keys[firsts]
        self.text = held >> bits
        codes, self.place = np.unique(held & ((1 << bits) - 1), return_inverse=True)
        self.pairs = codes >> bits_b << 32 | codes & ((1 << bits_b) - 1)

    def documents(self, copies: np.ndarray) -> np.ndarray:
        """For each pair how many documents hold it, ``copies`` being those of each text with tokens."""
        found = np.zeros(len(self.pairs), np.int64)
        np.add.at(found, self.place, copies[self.text])
        return found


def _digests(order: np.ndarray, lasts: np.ndarray, written: Strings) -> Iterator[str]:
    """The digest of each text's written groups; some texts at a time are written out."""
    first = done = 0
    while done < len(lasts):
        upto = max(done + 1, int(np.searchsorted(lasts, first + WRITTEN_TOKENS, "right")))
        numbers = order[first : lasts[upto - 1]]
        ends = np.cumsum(written.sizes[numbers], dtype=np.int64)[lasts[done:upto] - first - 1]
        data = written.joined(numbers).tobytes()
        for start, end in zip([0, *ends.tolist()], ends.tolist(), strict=False):
            yield hashlib.sha256(data[start:end]).hexdigest()
        first, done = int(lasts[upto - 1]), upto


def _rows(number: int, texts: list[str], copies: list[int], byte_path: str, piece_path: str) -> pa.RecordBatch:
    """The rows of one block: its texts with tokens and its pairs."""
    block = Block(texts, byte_path, piece_path)
    n, m = len(block.texts), len(block.pairs)
    firsts = np.searchsorted(block.text, np.arange(n + 1))
    lists = np.concatenate([firsts, np.full(m, firsts[-1])]).astype(np.int32)
    list_null = pa.array(np.arange(n + m) >= n)
    none_text, none_pair = pa.nulls(m, pa.int64()), pa.nulls(n, pa.int64())

    def listed(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(lists), pa.array(values.astype(np.int32)), mask=list_null)

    digests = [hashlib.sha256(texts[k].encode()).digest() for k in block.texts]
    columns = [
        pa.array(np.full(n + m, number, np.int64)),
        pa.array(digests + [None] * m, pa.binary()),
        *[pa.concat_arrays([pa.array(getattr(block, c).astype(np.int64)), none_text]) for c in MEASURES],
        pa.array(block.digests + [None] * m, pa.string()),
        listed(block.place),
        listed(block.times),
        pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(np.arange(m, dtype=np.int32))]),
        pa.concat_arrays([none_pair, pa.array(block.pairs.astype(np.int64))]),
        pa.concat_arrays([none_pair, pa.array(block.documents(np.array([copies[k] for k in block.texts], np.int64)))]),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ALIGNED.split(", ")])


def aligned_blocks(texts: DataFrame, byte_path: str, piece_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of all blocks of distinct texts, from (text, copies), written.

    A block's number is that of its task and its place in the task; it is read only
    from the written table, so a task that runs again cannot change it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting, copies, size = [], [], 0
        for batch in batches:
            for text, n in zip(batch.column("text").to_pylist(), batch.column("copies").to_pylist(), strict=True):
                waiting.append(text)
                copies.append(n)
                size += len(text)
                if size >= block_bytes:
                    yield _rows(number, waiting, copies, byte_path, piece_path)
                    waiting, copies, size, number = [], [], 0, number + 1
        if waiting:
            yield _rows(number, waiting, copies, byte_path, piece_path)

    return cut(texts.mapInArrow(run, ALIGNED), "aligned")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold an id pair, and whether its A id has none with more."""
    counts = cut(rows.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("documents").alias("n")), "pair-counts")
    highest = counts.groupBy(F.expr("shiftright(pair, 32)").alias("a")).agg(F.max("n").alias("top"))
    return counts.withColumn("a", F.expr("shiftright(pair, 32)")).join(highest, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _summed(texts: pa.Table, pairs: pa.Table) -> pa.Table:
    """The texts of one block with the sums over their links."""
    counts = np.zeros(pairs.num_rows, np.int64)
    best = np.zeros(pairs.num_rows, np.int64)
    place = pairs.column("place").to_numpy()
    counts[place] = pairs.column("n").to_numpy()
    best[place] = pairs.column("best").to_numpy()
    places, times = (texts.column(c).combine_chunks() for c in ("places", "times"))
    held, often = places.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    text = np.repeat(np.arange(len(places)), places.value_lengths().to_numpy())
    sums = []
    for values in (best, counts):
        total = np.zeros(len(places), np.int64)
        np.add.at(total, text, values[held] * often)
        sums.append(pa.array(total))
    kept = texts.select(["digest", *MEASURES, "groups_sha256"])
    return kept.append_column("n_best", sums[0]).append_column("count_sum", sums[1])


def text_measures(docs: DataFrame, byte_path: str, piece_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each distinct text with tokens: its digest and measures."""
    texts = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    rows = aligned_blocks(texts, byte_path, piece_path, block_bytes)
    sums = rows.where("pair IS NOT NULL").select(F.col("block").alias("of_block"), "place", "pair").join(pair_counts(rows), "pair").drop("pair")
    own = rows.where("digest IS NOT NULL").select("block", "digest", *MEASURES, "groups_sha256", "places", "times")
    schema = "digest binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return cut(own.groupBy("block").cogroup(sums.groupBy("of_block")).applyInArrow(_summed, schema), "text-measures")


def aligned(
    docs: DataFrame, byte_path: str = BYTE_VOCABULARY, piece_path: str = PIECE_VOCABULARY, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    settle(docs.sparkSession)
    docs = id_text(docs)
    measures = text_measures(docs, byte_path, piece_path, block_bytes)
    ids = docs.select("doc_id", F.when(F.col("text") != "", F.unhex(F.sha2(F.col("text").cast("binary"), 256))).alias("digest"))
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in (*MEASURES, "n_best", "count_sum")]
    return ids.join(measures, "digest", "left").select("doc_id", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))

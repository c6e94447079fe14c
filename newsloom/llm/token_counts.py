"""Token counts of documents by byte-pair merging that never makes a token.

A text becomes the symbols of the vocabulary's alphabet: its characters, with a
blank written as U+2581 and one put before the text; a character that is no entry
stands for its UTF-8 bytes.  The symbols are a linked list, and a heap holds the
adjacent pairs whose joined text is an entry.  The pair of the lowest rank (the
leftmost of equals) is popped and merged and its two new neighbour pairs are pushed,
until the heap is empty.  The count is the number of symbols at the start less the
merges; no identifier is looked up.

A merge only joins characters that stand side by side in some entry, so a text falls
into segments that can be worked on by themselves: characters that no entry of two
or more holds stand alone, and, where no entry has U+2581 behind another character,
each blank begins a segment.  Segments come again and again, so a worker keeps the
counts of short ones, at most ``KEPT_SEGMENTS``; that saves time and changes nothing.

The work is one map over the documents: no shuffle, memory for one Arrow batch and
the heap of the longest segment.  The vocabulary is a file at the same ``path`` on
every machine: a BPE model with byte fallback, identity normalisation and a blank
put in front; any other is refused.

Cases: a null or empty text has no tokens; special strings are ordinary text; rows
that share a doc_id each have their row; other columns are ignored, whatever their
names; an empty table gives an empty one; a text may be of any length (the heap costs
n log n even without a single blank).
"""

from __future__ import annotations

import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from newsloom.llm.shared import id_text, map_batches, settle

MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Documents with more tokens are over the limit.
LIMIT = 4096

BLANK = "▁"
#: A worker remembers the counts of so many segments of at most so many characters.
KEPT_SEGMENTS = 500_000
KEPT_LENGTH = 40


class Merger(dict):
    """Counts of segments; one that is not remembered is merged."""

    def __init__(self, path: str):
        super().__init__()
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize(" ﬁ  ½ ") != f"{BLANK}{BLANK}ﬁ{BLANK}{BLANK}½{BLANK}":
            raise ValueError(f"{path} changes texts before it splits them")
        ids = range(model.get_piece_size())
        if sum(map(model.is_byte, ids)) != 256:
            raise ValueError(f"{path} has no byte fallback")
        entries = {
            model.id_to_piece(i): -model.get_score(i)
            for i in ids
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        }
        self.ranks = {piece: rank for piece, rank in entries.items() if len(piece) > 1}
        self.singles = {piece for piece in entries if len(piece) == 1}
        joined = re.escape("".join(sorted(set("".join(self.ranks)) - {BLANK}))) or BLANK
        if any(BLANK in piece.lstrip(BLANK) for piece in self.ranks):
            joined += BLANK
            self.segments = re.compile(f"[{joined}]+|[^{joined}]+").findall
        else:
            self.segments = re.compile(f"{BLANK}*[{joined}]+|{BLANK}+|[^{joined}{BLANK}]+").findall

    def symbols(self, character: str) -> int:
        return 1 if character in self.singles else len(character.encode())

    def merged(self, segment: str) -> int:
        """Symbols that are left of a segment when no pair is an entry any more."""
        n = len(segment)
        ranks = self.ranks
        ends = list(range(1, n + 1))  # where the symbol that starts here ends; 0: merged into another
        before = list(range(-1, n))  # where the symbol before the one that starts here starts
        heap = [(rank, k, k + 2) for k in range(n - 1) if (rank := ranks.get(segment[k : k + 2])) is not None]
        heapify(heap)
        merges = 0
        while heap:
            _, left, end = heappop(heap)
            right = ends[left]
            if not right or right >= n or ends[right] != end:
                continue  # one of the two has been merged since
            ends[left], ends[right] = end, 0
            merges += 1
            if end < n:
                before[end] = left
                after = ends[end]
                if (rank := ranks.get(segment[left:after])) is not None:
                    heappush(heap, (rank, left, after))
            if left:
                first = before[left]
                if (rank := ranks.get(segment[first:end])) is not None:
                    heappush(heap, (rank, first, end))
        # A character without an entry began as its bytes; one that was merged gave them all up.
        spare = sum(self.symbols(c) - 1 for k, c in enumerate(segment) if ends[k] == k + 1)
        return n + spare - merges

    def __missing__(self, segment: str) -> int:
        found = self.merged(segment)
        if len(segment) <= KEPT_LENGTH:
            if len(self) >= KEPT_SEGMENTS:
                self.clear()
            self[segment] = found
        return found

    def count(self, text: str | None) -> int:
        """Tokens of a text."""
        if not text:
            return 0
        return sum(map(self.__getitem__, self.segments(BLANK + text.replace(" ", BLANK))))


@lru_cache(maxsize=4)
def merger(path: str) -> Merger:
    """The merger of a vocabulary file, loaded once in each worker."""
    return Merger(path)


def counted(docs: DataFrame, path: str = MODEL, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    settle(docs.sparkSession)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        tokens = np.array([merger(path).count(t) for t in texts], np.int64)
        sizes = np.array([len((t or "").encode()) for t in texts], np.int64)
        columns = [batch.column("doc_id"), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_batches(id_text(docs), work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

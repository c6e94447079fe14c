"""Token counts and alignment, against the tokenizers' own answers."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from pyspark.sql import functions as F

from newsloom.llm import alignment, token_counts

ODD = [
    "", " ", "a", "  a  b ", "<s> hi </s>", "▁x", "a▁", "▁▁ ▁a", "\x00a", "a\x00", "ﬁ ½ Å", "\t\n\r", "<0x41>", "é é", "　x", "😀",
    "<unk> <|endoftext|>", "﻿x", "​x\xa0y", "²", "².", "x².²", "   " * 17, "\n" * 50 + " " * 50, "1234567", "͸ ab", "a" * 5000,
]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=token_counts.MODEL)


@pytest.fixture(scope="module")
def merger():
    return token_counts.Merger(token_counts.MODEL)


@pytest.mark.parametrize("text", ODD)
def test_counts_of_odd_texts(model, merger, text):
    assert merger.count(text) == len(model.encode(text))


def test_counts_of_random_texts(model, merger):
    dice = random.Random(7)
    pieces = [model.id_to_piece(k).replace("▁", " ") for k in range(model.get_piece_size()) if not model.is_byte(k)]
    for _ in range(3000):
        text = "".join(dice.choice(pieces) if dice.random() < 0.8 else dice.choice(" ²\n▁éx1͸") for _ in range(dice.randint(1, 15)))
        assert merger.count(text) == len(model.encode(text)), text


def test_a_full_memory_of_segments_changes_nothing(merger, model, monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_SEGMENTS", 3)
    text = " ".join(f"word{k % 17} and" for k in range(200))
    assert merger.count(text) == len(model.encode(text)) and len(merger) <= 3


def test_a_long_segment_without_blanks(merger, model):
    text = "abcdefghij" * 30_000
    assert merger.count(text) == len(model.encode(text))


def test_counted_documents(tables, model):
    docs = tables("documents")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = token_counts.counted(docs, limit=500).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == {
        k: (len(t.encode()), n := len(model.encode(t)), n > 500) for k, t in texts.items()
    }


def test_counted_odd_documents(odd_docs, no_docs, model):
    rows = Counter(tuple(r) for r in token_counts.counted(odd_docs).collect())
    wanted = Counter()
    for r in odd_docs.collect():
        n = len(model.encode(r["text"] or ""))
        wanted[r["doc_id"], len((r["text"] or "").encode()), n, n > 4096] += 1
    assert rows == wanted
    assert token_counts.counted(no_docs).count() == 0


def plainly_aligned(docs):
    """The rows by looking at all pairs of tokens of every document."""
    both = alignment.vocabularies(alignment.BYTE_VOCABULARY, alignment.PIECE_VOCABULARY)
    a, b = both.a, both.b
    held, rows = Counter(), []

    def ranges(ids, sizes):
        ends = [sum(len(sizes[i]) for i in ids[: k + 1]) for k in range(len(ids))]
        return list(zip([0, *ends], ends, ids))

    for doc_id, text in docs:
        x, y = (a.tokenizer.encode(" " + text, add_special_tokens=False).ids, b.model.encode(text)) if text else ([], [])
        if b"".join(a.bytes[i] for i in x) != b"".join(b.bytes[i] for i in y) or not x or b"".join(a.bytes[i] for i in x) != b" " + text.encode():
            rows.append((doc_id, 0, 0, 0, [], ""))
            continue
        left, right = ranges(x, a.bytes), ranges(y, b.bytes)
        links = [(i, j) for p, q, i in left for r, s, j in right if p < s and r < q]
        cuts = sorted({q for _, q, _ in left} & {s for _, s, _ in right})
        groups = []
        for low, high in zip([0, *cuts], cuts):
            sides = [",".join(str(i) for _, q, i in side if low < q <= high) for side in (left, right)]
            groups.append("|".join(sides))
        held.update(set(links))
        rows.append((doc_id, len(x), len(y), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = defaultdict(int)
    for (i, _), n in held.items():
        top[i] = max(top[i], n)
    return Counter(
        (d, n, m, g, len(e), sum(held[p] == top[p[0]] for p in e), sum(held[p] for p in e), s) for d, n, m, g, e, s in rows
    )


def as_rows(df):
    columns = ("doc_id", *alignment.MEASURES, "n_best", "count_sum", "groups_sha256")
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_tokens_by_rank_are_those_of_the_file():
    a = alignment.ByteVocabulary(alignment.BYTE_VOCABULARY)
    assert a.ranked is not None
    dice = random.Random(5)
    texts = [f"a{c}b 1{c}2 {c}{c}  {c}\n{c}'s {c}1{c}! !{c}" for c in map(chr, range(0x3000))]
    for _ in range(2000):
        texts.append("".join(dice.choice(" \n\t'strevmdl019.,é中😀") for _ in range(dice.randint(1, 60))))
    ranked = a.tokens([*ODD, *texts, "x" * 100_000])
    a.ranked = None
    assert a.tokens([*ODD, *texts, "x" * 100_000]) == ranked


def test_alignment_of_odd_texts(make_docs, no_docs):
    rows = [(k, t[:300]) for k, t in enumerate(ODD)] + [(90, None), (3, "hello there"), (None, "hello there"), (92, "hello there"), (93, "hello")]
    wanted = plainly_aligned(rows)
    assert as_rows(alignment.aligned(make_docs(*rows))) == wanted
    assert as_rows(alignment.aligned(make_docs(*rows).repartition(3), block_bytes=20)) == wanted
    assert alignment.aligned(no_docs).count() == 0


def test_alignment_of_documents(tables):
    docs = tables("documents").where(F.length("text") < 2500).select("doc_id", "text").limit(40)
    rows = [tuple(r) for r in docs.collect()]
    copies = docs.union(docs.limit(5).withColumn("doc_id", F.col("doc_id") + 10**6))
    more = [tuple(r) for r in copies.collect()]
    assert as_rows(alignment.aligned(docs, block_bytes=10_000)) == plainly_aligned(rows)
    assert as_rows(alignment.aligned(copies)) == plainly_aligned(more)


def test_alignment_of_odd_documents(odd_docs, model):
    rows = alignment.aligned(odd_docs).collect()
    sizes = Counter((r["doc_id"], r["n_b"]) for r in rows)
    assert sizes == Counter((r["doc_id"], len(model.encode(r["text"])) if r["text"] else 0) for r in odd_docs.collect())


def test_one_hot_text(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same").otherwise(F.concat(F.lit("not "), "id")).alias("text"))
    rows = as_rows(alignment.aligned(docs, block_bytes=500))
    assert rows == plainly_aligned([tuple(r) for r in docs.collect()])

import random

import numpy as np

from newsloom.llm import substrings
from tests.llm import brute


def _found(docs):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in substrings.deduplicated(docs).collect()}


def test_cover_has_a_shift_for_every_two_residues():
    cover = set(substrings.COVER)
    for a in range(substrings.PERIOD):
        for b in range(substrings.PERIOD):
            shift = substrings.SHIFTS[a, b]
            assert 0 <= shift < substrings.PERIOD
            assert {(a + shift) % substrings.PERIOD, (b + shift) % substrings.PERIOD} <= cover


def test_equals_brute_force(make_docs):
    rng = random.Random(3)
    passages = ["".join(rng.choice("abc dé\n") for _ in range(n)) for n in (49, 50, 51, 90, 400)]
    docs = {}
    for k in range(40):
        parts = ["".join(rng.choice("uvwxyz") for _ in range(rng.randrange(60))) for _ in range(4)]
        docs[100 - k] = rng.choice(passages).join(parts)
    docs |= {1: "ab" * 200, 2: "ab" * 150, 3: "a" * 500, 4: "a" * 49, 5: None, 6: ""}
    assert _found(make_docs(*docs.items())) == brute.without_copies(docs)


def test_small_chunks_and_buckets_change_nothing(make_docs, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 300)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 500)
    text = "".join(chr(97 + k * k % 23) for k in range(2000))
    docs = {1: text, 2: text[100:900], 3: "zz" + text[500:1500] + "zz", 4: text[:120] * 3}
    pieces = [(i, 0, at, t.encode()[at : at + 300 + 49]) for i, t in docs.items() for at in range(0, len(t) - 49, 300)]
    spans = {i: [] for i in docs}
    payloads = {}
    for bucket, packed, settled in substrings.prepared(pieces, 3):
        if packed is not None:
            payloads.setdefault(bucket, []).append(substrings.pack([packed]))
        else:
            for i, _, a, b in zip(*settled, strict=True):
                spans[int(i)].append((int(a), int(b)))
    for packed in payloads.values():
        for i, _, a, b in zip(*substrings.sorted_bucket(packed), strict=True):
            spans[int(i)].append((int(a), int(b)))
    removed = {i: sum(b - a for a, b in substrings.merged(s)) for i, s in spans.items()}
    assert removed == {i: found[1] for i, found in brute.without_copies(docs).items()}


def test_fingerprint_collisions_are_told_apart(monkeypatch):
    monkeypatch.setattr(substrings, "mixed", lambda x: np.zeros_like(x))
    raw = b"a" * 60 + b"b" * 60
    at = np.r_[np.arange(0, 11), np.arange(60, 71)]
    places, classes = substrings.equal_classes(raw, at)
    by_class = {c: {raw[p : p + 50] for p in places[classes == c].tolist()} for c in set(classes.tolist())}
    assert all(len(strings) == 1 for strings in by_class.values()) and len(by_class) == 2


def test_odd_documents(odd_docs, no_docs):
    rows = substrings.deduplicated(odd_docs, keep_bytes=True).collect()
    assert len(rows) == odd_docs.count()
    of = {}
    for r in rows:
        of.setdefault(r["doc_id"], []).append(r)
    assert [r["n_removed"] for r in of[6]] == [0, 0]
    assert of[7][0]["kept"] == b" extra"[-len(of[7][0]["kept"]) :]
    assert of[None][0]["n_removed"] == 0 and of[1][0]["kept"] == b"" and of[8][0]["n_removed"] == 0
    assert substrings.deduplicated(no_docs).count() == 0


def test_packed_segments_come_back():
    ids, texts = np.array([5, 9, 2**62]), np.array([0, -3, 7])
    one = (ids, texts, np.array([0, 0, 2]), np.array([4, 90, 1]), np.array([50, 60, 51]), b"x" * 161)
    got = substrings.unpack(substrings.pack([one, one]))
    assert got[0].tolist() == [*ids, *ids] and got[1].tolist() == [*texts, *texts]
    assert got[2].tolist() == [0, 0, 2, 3, 3, 5] and got[4].tolist() == [50, 60, 51] * 2 and got[5] == b"x" * 322

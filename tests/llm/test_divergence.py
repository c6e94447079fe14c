"""Source audit: the transducer, and whole results against a plain version."""

import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def built(words):
    builder = divergence.Builder()
    for word in words:
        builder.add(word)
    row = builder.finish()
    return builder, divergence.Transducer({**row, "first": 0})


@settings(deadline=None, max_examples=150)
@given(st.sets(st.text("abcé", min_size=1, max_size=7), min_size=1, max_size=60))
def test_transducer_gives_ordinals_and_is_minimal(terms):
    words = sorted(t.encode() for t in terms)
    builder, found = built(words)
    assert list(found.terms()) == words
    asked = words + [w + b"a" for w in words] + [w[:-1] for w in words if len(w) > 1] + [b"z"]
    data = np.frombuffer(b"\0".join(asked) + b"\0", np.uint8)
    lengths = np.array([len(w) for w in asked])
    starts = np.cumsum(lengths + 1) - lengths - 1
    ordinal = {w: k for k, w in enumerate(words)}
    assert found.ordinals(data, starts, lengths).tolist() == [ordinal.get(w, -1) for w in asked]
    # Minimal: as many states as there are different sets of continuations.
    beginnings = {w[:k] for w in words for k in range(len(w) + 1)}
    continuations = {frozenset(w[len(b) :] for w in words if w.startswith(b)) for b in beginnings}
    assert len(builder.finals) == len(continuations)


def plain_audit(rows, min_docs, top):
    rows = [(lang or "", source or "", TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))) for text, lang, source in rows]
    held, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in rows:
        held[lang].update(set(terms))
        counts[lang, source].update(terms)
    found = set()
    for lang in held:
        kept = [t for t, n in held[lang].items() if n >= min_docs]
        groups = {s: c for (g, s), c in counts.items() if g == lang}

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, len(pairs)), ("term", terms, top)):
                order = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                found |= {(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(order[:limit])}
    return found


def rows_of(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def documents():
    words = "Alpha BETA gamma delta épée ÉPÉE naïve été ß xyz tap taps top tops".split()
    for k in range(260):
        text = " ".join(words[(k * j * j + j) % len(words)] for j in range(k % 23)) + ("\nalpha-beta, 3gamma_delta" if k % 2 else "")
        yield (text, ("en", "fr", None, "")[k % 4 if k % 9 else 0], (None, "s1", "s2", "", "s10")[k % 5 if k % 3 else 1])
    yield (None, "en", "silent")
    yield ("", "xx", "alone")
    yield ("q r s", "yy", "a")
    yield ("q r s", "yy", "b")


def test_audit_of_small_documents(make_docs, monkeypatch):
    rows = list(documents())
    docs = make_docs(*[(k, *r) for k, r in enumerate(rows)])
    wanted = plain_audit(rows, 30, 50)
    assert rows_of(divergence.audited(docs)) == wanted
    assert {r[2] for r in wanted} == {"pair", "term"}
    monkeypatch.setattr(divergence, "SHELF_BYTES", 40)
    monkeypatch.setattr(divergence, "CHUNK_BYTES", 100)
    assert rows_of(divergence.audited(docs.repartition(3), min_docs=9, top_terms=4, block_bytes=12)) == plain_audit(rows, 9, 4)


def test_tiles_of_sources_and_spans_of_terms(make_docs):
    rows = [(" ".join(f"w{chr(97 + (k * j) % 26)}{chr(97 + j % 5)}" for j in range(k % 40)), "en", f"s{k % 75}") for k in range(700)]
    docs = make_docs(*[(k, *r) for k, r in enumerate(rows)])
    spans, tiles = divergence.SPAN, divergence.TILE
    assert tiles < 75
    divergence.SPAN = 16
    try:
        assert rows_of(divergence.audited(docs, min_docs=5)) == plain_audit(rows, 5, 50)
    finally:
        divergence.SPAN = spans


def test_audit_of_odd_documents(odd_docs, no_docs):
    rows = [(r["text"], r["lang"], r["source"]) for r in odd_docs.collect()]
    assert rows_of(divergence.audited(odd_docs, min_docs=2)) == plain_audit(rows, 2, 50)
    assert divergence.audited(no_docs).count() == 0

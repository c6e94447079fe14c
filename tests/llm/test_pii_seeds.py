"""Base spans of every kind are seeds, whole tokens or not."""

import pytest

from newsloom.llm import pii


def _number(body: str) -> str:
    """The digits with the check digit that makes them a card number."""
    total = sum(int(d) if k % 2 else int(d) * 2 - 9 * (int(d) > 4) for k, d in enumerate(reversed(body)))
    return body + str(-total % 10)


def _card(k: int) -> str:
    digits = _number(f"411111{k:09d}")
    return " ".join(digits[i : i + 4] for i in range(0, 16, 4))


SEEDS = {
    "phone": ("tel: {}", lambda k: f"+1555{k:07d}", "5559990001"),
    "phone with blanks": ("tel: {}", lambda k: f"+1 (555) {k:03d}-{k:04d}", "5559990001"),
    "card with blanks": ("card: {}", _card, "4000999912345678"),
    "address in a token": ("write {}", lambda k: f"mailto:a{k}@b.c", "user77"),
}


@pytest.mark.parametrize("name", SEEDS)
def test_every_base_kind_opens_its_context(make_docs, name):
    text, value, unseen = SEEDS[name]
    docs = [(k, f"some words {text.format(value(k))} and more") for k in range(1, 41)]
    docs += [(100 + k, f"plain number {k} here") for k in range(40)]
    docs.append((200, f"some words {text.format(unseen)} and more"))
    found = {r["doc_id"]: [tuple(s)[1:] for s in r["spans"]] for r in pii.found(make_docs(*docs)).collect()}
    start = docs[-1][1].index(unseen)
    assert found[200] == [(start, start + len(unseen), pii.FOUND)]
    assert found[100] == []
    assert all(kind != pii.FOUND for k in range(1, 41) for _, _, kind in found[k])


def test_a_span_of_several_tokens_is_one_instance(make_docs):
    docs = [(None, "tel: +1 (555) 010-0001 or +1 (555) 010-0002, room 12")]
    placed = pii._placed(make_docs(*docs).select("doc_id", "text").selectExpr("*", "xxhash64(text) AS text_id"))
    rows = sorted((r["pattern"], r["seed"]) for r in pii.contexts(pii._with_base(placed)).collect())
    assert len(rows) == 3
    assert sum(seed for _, seed in rows) == 2

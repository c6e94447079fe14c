import numpy as np
import pytest

from newsloom.llm import near_dup
from newsloom.llm.shared import components
from newsloom.llm.sketch import sketch
from tests.llm import brute


@pytest.mark.parametrize(("size", "shared"), [(1, 1), (4, 3), (40, 30), (600, 450)])
def test_places_agree_as_often_as_sets_are_similar(size, shared):
    rng = np.random.default_rng(5)
    rates = []
    for _ in range(60):
        pool = rng.integers(0, 2**63, 2 * size - shared, dtype=np.uint64)
        a, b = sketch(pool[:size], 128), sketch(pool[size - shared :], 128)
        assert (a != np.uint64(2**64 - 1)).all()
        rates.append((a == b).mean())
    assert abs(np.mean(rates) - shared / (2 * size - shared)) < 0.04


def test_components_follow_long_paths(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 70), (100, 71), (5, 5)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    found = {r["node"]: r["component"] for r in rows}
    assert found == {**dict.fromkeys(range(61), 0), 70: 70, 71: 70, 100: 70}


def test_equals_brute_force_on_chains_and_groups(make_docs):
    rng = np.random.default_rng(2)
    docs, base = {}, [f"v{k}" for k in range(120)]
    for k in range(60):  # each a small step from the one before: a chain and its neighbours
        base = base.copy()
        base[int(rng.integers(0, 120))] = f"n{k}"
        if k % 7 == 0:
            at = int(rng.integers(0, 100))
            base[at : at + 20] = [f"m{k}x{j % 9}" for j in range(20)]
        docs[1000 - k] = " ".join(base)
    for k in range(20):  # around the limit
        docs[k] = " ".join([f"q{x}" for x in range(80)] + [f"r{k}{x}" for x in range(k)])
    want, sizes = brute.components(docs)
    rows = near_dup.near_duplicates(make_docs(*docs.items())).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == want
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == sizes


def test_odd_documents(odd_docs, no_docs):
    rows = near_dup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert found[1] == (0, 1, True) and found[2] == (0, 2, True) and found[3] == (0, 3, True)
    assert found[4] == (1, 4, True) and found[5] == (1, 4, False)
    assert found[6] == (56, 6, True) and found[7] == (57, 6, False)
    assert found[None] == (56, None, True)
    kept = near_dup.kept_documents(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 6, 8, 9, 10]
    assert near_dup.near_duplicates(no_docs).count() == 0
    assert near_dup.kept_documents(no_docs).count() == 0


def test_one_id_with_two_texts_is_one_document(make_docs):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    rows = near_dup.near_duplicates(make_docs((3, a), (2, b), (5, a), (5, b))).collect()
    assert {r["component_id"] for r in rows} == {2}

"""Quality rules, line dedup, decontamination, personal data."""

import hashlib
import math
import random

import pytest

from newsloom.llm import decontaminate, line_dedup, pii, quality
from tests.llm import brute


@pytest.fixture(scope="module")
def texts(tables):
    return {r["doc_id"]: r["text"] for r in tables("documents").collect()}


def test_base_counts_equal_brute_force(texts):
    for text in [*list(texts.values())[:120], "", None, "a a a a", "x y z x y z", "İ É # |\n\n#|\n# |", "\u00a0 \u2003"]:
        assert quality.measures(text)[:5] == brute.quality_base(text)


def test_binomial_tail_is_exact():
    want = sum(math.comb(40, k) * 0.1**k * 0.9 ** (40 - k) for k in range(3))
    assert abs(quality.binomial_tail(2, 40, 0.1) - want) < 1e-12
    assert quality.binomial_tail(40, 40, 0.1) == 1.0


def test_cutoffs_stop_at_the_first_that_fails():
    cuts = (900, 500, 200, 100)
    assert quality.certified(cuts, [0, 0, 300, 0], 2000, 0.005, 0.001) == 500
    assert quality.certified(cuts, [300, 0, 0, 0], 2000, 0.005, 0.001) is None
    assert quality.certified(cuts, [0, 0, 0, 0], 100, 0.005, 0.001) is None


def test_certified_rules_reject_junk_and_keep_good_documents(spark, make_docs):
    def clean(k):
        return " ".join(f"word{k}x{j}" for j in range(60))

    rows = [(k, clean(k) if k % 4 else clean(k).replace(" ", "### "), "en", "s") for k in range(8000)]
    rows += [(9000 + k, clean(k).replace(" ", "### "), "fr", "s") for k in range(20)]
    docs = make_docs(*rows)
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(8000)], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in quality.judged(docs, labels).collect()}
    assert all(found[k]["kept"] == (k % 4 > 0) for k in range(8000))
    assert all(found[9000 + k]["kept"] for k in range(20))  # no labels in this stratum, no certificate
    kept = quality.kept_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 6020


def test_quality_of_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(6, 1, 0), (6, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    rows = quality.judged(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    failed = {r["doc_id"]: r["base_failed"] for r in rows}
    assert failed[1] and failed[2] and failed[9] and not failed[6]
    assert quality.kept_documents(odd_docs, labels).columns == odd_docs.columns
    assert quality.judged(no_docs, labels).count() == 0
    assert quality.kept_documents(odd_docs, labels.limit(0)).count() == 4


def test_lines_equal_brute_force(make_docs):
    rng = random.Random(4)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (1, 1, 2, 3, 9, 10, 11, 14)] + ["", " "]
    docs = {k: "\n".join(rng.choice(pool) for _ in range(rng.randrange(9))) for k in range(60)}
    docs[60] = None
    rows = line_dedup.deduplicated(make_docs(*docs.items())).collect()
    assert {r["doc_id"]: r["text"] or "" for r in rows} == brute.lines_left(docs)


@pytest.mark.parametrize("min_lines", [2, 3, 5])
def test_runs_of_any_length(make_docs, min_lines):
    run = [f"l{k}" for k in range(6)]
    docs = make_docs((1, "\n".join(run)), (2, "\n".join(["x", *run[:4], "y"])), (3, "\n".join([*run[1:3], "z"])))
    rows = {r["doc_id"]: r for r in line_dedup.deduplicated(docs, min_lines=min_lines, min_words=9).collect()}
    assert rows[1]["n_removed"] == 0
    assert (rows[2]["n_removed"], rows[2]["n_runs"]) == ((4, 1) if min_lines <= 4 else (0, 0))
    assert rows[3]["n_removed"] == (2 if min_lines == 2 else 0)


def test_lines_of_odd_documents(odd_docs, no_docs):
    rows = line_dedup.deduplicated(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    of = {r["doc_id"]: r for r in rows}
    assert of[1]["text"] is None and of[2]["text"] == "" and of[None]["n_removed"] == 0
    assert of[10]["n_removed"] == 6 and of[10]["text"].count("end") == 1
    assert line_dedup.kept_documents(odd_docs).columns == odd_docs.columns
    assert line_dedup.deduplicated(no_docs).count() == 0


def test_items_equal_exact_containment(make_docs, spark):
    rng = random.Random(6)
    items = [(k, " ".join(f"i{k}w{j}" for j in range(n))) for k, n in enumerate((3, 5, 6, 12, 30, 31, 64, 200, 700))]
    docs = []
    for k in range(150):
        _, text = rng.choice(items)
        words = text.split()
        held = words[: max(1, int(len(words) * rng.choice((0.4, 0.7, 0.76, 0.8, 1.0))))]
        fill = [f"f{k}x{j}" for j in range(rng.choice((0, 3, 40, 500, 6000)))]
        cut = rng.randrange(len(fill) + 1)
        docs.append((k, " ".join(fill[:cut] + [w.upper() for w in held] + fill[cut:])))
    benchmark = spark.createDataFrame([*items, (50, None), (51, ""), (None, "a b c d e f")], "item_id long, text string")
    rows = decontaminate.contaminated(make_docs(*docs), benchmark).collect()
    want = {}
    for k, text in docs:
        held = brute.shingles(text)
        want[k] = [i for i, t in items if 100 * len(held & brute.shingles(t)) >= 75 * len(brute.shingles(t))]
    assert {r["doc_id"]: r["item_ids"] for r in rows} == want


def test_small_blocks_find_the_same(make_docs, spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", 30)
    items = [(k, " ".join(f"i{k}w{j}" for j in range(20))) for k in range(5)]
    docs = make_docs(*[(k, f"a b {text} c d") for k, text in items], (9, "none of it at all here"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert {r["doc_id"]: r["item_ids"] for r in decontaminate.contaminated(docs, benchmark).collect()} == {
        **{k: [k] for k, _ in items}, 9: []
    }
    assert [r["doc_id"] for r in decontaminate.clean_documents(docs, benchmark).collect()] == [9]


def test_items_in_odd_documents(spark, odd_docs, no_docs):
    benchmark = spark.createDataFrame([(1, "ONE two"), (2, None)], "item_id long, text string")
    rows = decontaminate.contaminated(odd_docs, benchmark).collect()
    assert sorted(r["doc_id"] for r in rows if r["contaminated"]) == [4, 5] and len(rows) == odd_docs.count()
    clean = decontaminate.clean_documents(odd_docs, benchmark)
    assert clean.columns == odd_docs.columns and clean.count() == odd_docs.count() - 2
    assert decontaminate.contaminated(no_docs, benchmark).count() == 0
    assert decontaminate.clean_documents(odd_docs, benchmark.limit(0)).count() == odd_docs.count()


def _personal(docs):
    return {r["doc_id"]: r for r in pii.digest(pii.found(docs)).collect()}


def test_personal_data_equals_brute_force(make_docs, texts):
    rng = random.Random(7)
    odd = ["a@b.c_d@e.f", "x@a..b y@c.d.", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.255", "+1 (234) 567-8901 +12", "4111 1111-1111 1111",
           "é\U0001f600 a.b+c@d-e.f-g 4111111111111111x", "+", "@", "+1((((", "9" * 40, "a" * 5000 + "@", "1.1." * 50]
    odd += ["".join(rng.choice("a1.@+- ()4é\n") for _ in range(200)) for _ in range(60)]
    docs = dict(enumerate(odd)) | {10_000 + k: t for k, t in texts.items()}
    found = _personal(make_docs(*docs.items()))
    for k, text in docs.items():
        want = brute.personal(text)
        assert found[k]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), text[:200]
        assert [s for s in found[k]["spans"].split(",") if s and not s.startswith("id:")] == want


def test_contexts_of_seeds_find_unseen_identifiers(make_docs):
    docs = [(k, f'some words token = "{k:040x}" and more') for k in range(40)]
    docs += [(100 + k, f"plain number {k} here") for k in range(40)]
    docs.append((200, 'now the token = "k3y-007", and room 12'))
    found = _personal(make_docs(*docs))
    start = docs[-1][1].index("k3y")
    assert found[200]["spans"] == f"id:{start}:{start + 7}"
    assert found[100]["spans"] == ""


def test_personal_data_of_odd_documents(odd_docs, no_docs):
    rows = pii.digest(pii.found(odd_docs)).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in rows)
    assert pii.found(no_docs).count() == 0

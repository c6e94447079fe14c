import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsloom.llm import mixing, queries
from tests.llm import brute

ORDER = ["quality_rules", "line_dedup", "near_dedup", "decontamination", "target_mix"]


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ORDER


def test_stages_keep_columns_and_take_odd_documents(spark, odd_docs, no_docs, small):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            rows = stage(spark, docs, small)
            assert rows.columns[: len(docs.columns)] == docs.columns, name
            assert name == "target_mix" or rows.columns == docs.columns
            assert rows.count() <= docs.count()


def _raked(tokens, rounds=200):
    """{cell: share} for tempered targets, from {cell: tokens}."""
    weights, targets = {c: float(n) for c, n in tokens.items()}, []
    for k, margin in enumerate(mixing.MARGINS):
        sums = {}
        for cell, n in tokens.items():
            sums[cell[k]] = sums.get(cell[k], 0) + n
        powers = {v: n ** mixing.TEMPER[margin] for v, n in sums.items() if n}
        targets.append({v: x / sum(powers.values()) for v, x in powers.items()})
    for _ in range(rounds):
        for k, target in enumerate(targets):
            have = {}
            for cell, w in weights.items():
                have[cell[k]] = have.get(cell[k], 0) + w
            weights = {c: w * target.get(c[k], 0) / have[c[k]] if have[c[k]] else 0.0 for c, w in weights.items()}
    return weights


def _chances(tokens, weights, budget):
    """{cell: chance}: the factor is found by halving."""
    rates = {c: weights[c] / n if n else 0.0 for c, n in tokens.items()}
    low, high = 0.0, 1e18
    for _ in range(300):
        factor = (low + high) / 2
        expected = sum(n * min(1.0, rates[c] * factor) for c, n in tokens.items())
        low, high = (factor, high) if expected < budget * sum(tokens.values()) else (low, factor)
    return {c: min(1.0, r * low) for c, r in rates.items()}


def test_run_equals_a_plain_pipeline(spark, small):
    rows = {r["doc_id"]: r.asDict() for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    items = [brute.shingles(r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    # Too few labels for any certificate here: only the base rules reject.
    base = {i: brute.quality_base(r["text"]) for i, r in rows.items()}
    passes = lambda b: b[0] >= 50 and 100 * b[4] <= 50 * b[0]
    texts = {i: rows[i]["text"] for i, b in base.items() if passes(b)}
    texts = {i: t for i, t in brute.lines_left(texts).items() if len(brute.WORD.findall(t)) >= 50}
    lowest, _ = brute.components({i: rows[i]["text"] for i in texts})
    texts = {i: t for i, t in texts.items() if lowest[i] == i and passes(brute.quality_base(t))}
    held = {i: brute.shingles(t) for i, t in texts.items()}
    texts = {i: t for i, t in texts.items() if not any(q and 100 * len(q & held[i]) >= 75 * len(q) for q in items)}

    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    marked = frame.select("doc_id", mixing.topic_of(F.col("text")).alias("topic"), F.xxhash64(F.lit(mixing.SEED), "doc_id").alias("h"))
    topics, draws = {}, {}
    for r in marked.collect():
        topics[r["doc_id"]], draws[r["doc_id"]] = r["topic"], (r["h"] & ((1 << 53) - 1)) / (1 << 53)
    cells = {i: (rows[i]["source"], rows[i]["lang"], topics[i]) for i in texts}
    tokens = {}
    for i, cell in cells.items():
        tokens[cell] = tokens.get(cell, 0) + len(brute.WORD.findall(texts[i]))
    chances = _chances(tokens, _raked(tokens), mixing.BUDGET)

    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, small).collect()}
    clear = {i for i in texts if abs(draws[i] - chances[cells[i]]) > 1e-3}  # raking ends within a tolerance
    assert {i for i in got if i in clear} == {i for i in clear if draws[i] < chances[cells[i]]}
    assert set(got) <= set(texts) and len(clear) > 0.9 * len(texts)
    for i, row in got.items():
        assert row["text"] == texts[i] and passes(brute.quality_base(row["text"]))
        assert abs(row["mix_chance"] - chances[cells[i]]) < 1e-3


def test_copies_that_lost_their_lines_go(spark, make_docs, tmp_path):
    """A near copy keeps a few words when its repeated lines are gone; nothing of it leaves the stages."""
    def prose(seed, lines):
        return [" ".join(f"w{(seed * 7919 + 31 * k + j * j) % 997}x{j}" for j in range(14)) for k in range(lines)]

    one, other = prose(1, 12), prose(2, 12)
    near = [*one[:11], one[11] + " and some more words"]
    longer = [*one, *prose(3, 2), *[" ".join(f"own{k}{j}" for j in range(30)) for k in range(2)]]
    docs = make_docs((1, "\n".join(one)), (2, "\n".join(one)), (3, "\n".join(near)), (4, "\n".join(other)), (5, "\n".join(longer)))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    left = corpus_pipeline.repeated_lines(spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in left.collect()} == {1, 4, 5}
    # The lines as they came make 5 a copy of 1 only if enough of them agree: 12 of 16 lines do not.
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, left, str(tmp_path)).collect()} == {1, 4, 5}
    # Judged on what lines are left nothing would link 1 and 3; as they came they are copies.
    cut_texts = docs.withColumn("text", F.when(F.col("doc_id") == 3, "and some more words").otherwise(F.col("text")))
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, cut_texts, str(tmp_path)).collect()} == {1, 4, 5}


def test_documents_that_only_repeated_lines_told_apart_are_copies(spark, make_docs, tmp_path):
    """The line stage has an effect on the near duplicates: its texts are compared, too."""
    def prose(seed, lines):
        return [" ".join(f"w{(seed * 7919 + 31 * k + j * j) % 997}x{j}" for j in range(14)) for k in range(lines)]

    article, menu, links = prose(1, 6), prose(2, 8), prose(3, 8)
    docs = make_docs(
        (1, "\n".join(menu)), (2, "\n".join(links)), (3, "\n".join([*menu, *article])),
        (4, "\n".join([*links, *(f"{line} w{k}y" if k == 5 else line for k, line in enumerate(article))])),
    )
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()} == {1, 2, 3, 4}
    # Without their menus and links, which others brought before, 3 and 4 are one article.
    cut_texts = docs.withColumn("text", F.substring_index("text", "\n", -6))
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, cut_texts, str(tmp_path)).collect()} == {1, 2, 3}


@pytest.mark.parametrize("name", ["line_dedup", "mixing", "pii", "url_rules"])
def test_native_operators_have_no_python_on_the_way(name):
    with open(os.path.join(os.path.dirname(queries.__file__), f"{name}.py")) as file:
        source = file.read()
    for word in ("udf", "pandas", "pyarrow", "numpy", "mapIn", "applyIn", ".rdd"):
        assert word not in source


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run_whole_and_equal_their_sql(spark, small, name):
    rows = queries.QUERIES[name](spark, small)
    table = "pages" if name.startswith("op10") else "documents"
    if not name.startswith("op13"):  # that one has rows of groups
        assert rows.count() == spark.read.parquet(f"{small}/{table}.parquet").count()
    if name in queries.ORACLES:
        with duckdb.connect() as db:
            for file in os.listdir(small):
                db.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{small}/{file}'")
            want = db.sql(queries.ORACLES[name]).df()
        columns = sorted(rows.columns)
        assert columns == sorted(want.columns)
        have = sorted(map(str, rows.toPandas()[columns].itertuples(index=False, name=None)))
        assert have == sorted(map(str, want[columns].itertuples(index=False, name=None)))

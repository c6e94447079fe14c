"""Columns whose names the operators use themselves, and empty tables beside documents."""

from pyspark.sql import functions as F

import corpus_pipeline
from newsloom.llm import mixing, quality

CLASHING = ["mix_topic", "mix_chance", "_mix_source", "_quality_kept", "_quality_n_words", "_gone", "component", "runs", "stratum"]


def clashing(docs):
    return docs.select("*", *[F.lit(f"own {name}").alias(name) for name in CLASHING])


def test_own_columns_stay(make_docs):
    prose = " ".join(f"w{k}" for k in range(60))
    docs = clashing(make_docs((1, prose, "en", "a"), (2, prose + " more", "en", "b")))
    drawn = mixing.sampled_documents(docs, budget=1.0)
    assert drawn.columns[: len(docs.columns)] == docs.columns
    rows = drawn.collect()
    assert len(rows) == 2 and all(r[name] == f"own {name}" for r in rows for name in CLASHING)
    assert len(drawn.columns) == len(docs.columns) + 4 and len(set(drawn.columns)) == len(drawn.columns)
    kept = quality.base_kept_documents(docs).collect()
    assert len(kept) == 2 and all(r[name] == f"own {name}" for r in kept for name in CLASHING)


def test_stages_with_clashing_names_and_empty_tables(spark, make_docs, no_docs, tmp_path):
    prose = [" ".join(f"w{k * 100 + j}" for j in range(80)) for k in range(4)]
    docs = clashing(make_docs(*[(k, t, "en", "a") for k, t in enumerate(prose)]))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, docs, str(tmp_path))
        assert rows.columns == docs.columns and rows.count() == 4, name
    empty = tmp_path / "empty"
    for table in ("labels", "benchmark"):
        spark.read.parquet(str(tmp_path / f"{table}.parquet")).write.parquet(str(empty / f"{table}.parquet"))
    no_docs.write.parquet(str(empty / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0

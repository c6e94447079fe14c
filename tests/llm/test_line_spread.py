"""Short lines that many documents hold."""

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from newsloom.llm import line_dedup, queries
from tests.llm import brute


def spread_docs():
    """60 documents share a short line, 49 another; one document repeats a third."""
    docs = [(k, f"own line {k}\nAll rights reserved.\nmore of {k}\n\nlast") for k in range(60)]
    docs += [(1000 + k, f"other line {k}\nThanks.\nlast of {k}") for k in range(49)]
    docs += [(2000, "\n".join(x for k in range(55) for x in (f"verse {k}", "la la la"))), (2001, None), (2002, "")]
    return docs


def test_short_lines_equal_sql_and_the_plain_version(spark, tmp_path):
    docs = spread_docs()
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.QUERIES["op7_line_dedup"](spark, str(tmp_path)).toPandas()
    assert rows.n_removed.sum() == 59 + 59  # both lines that 60 documents hold
    with duckdb.connect() as db:
        documents = pd.DataFrame(docs, columns=["doc_id", "text"])
        db.register("documents", documents)
        want = db.sql(queries.ORACLES["op7_line_dedup"]).df()
    columns = sorted(rows.columns)
    assert sorted(map(str, rows[columns].itertuples(index=False, name=None))) == sorted(map(str, want[columns].itertuples(index=False, name=None)))
    left = line_dedup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r["doc_id"]: r["text"] or "" for r in left.select("doc_id", F.col("text")).collect()} == brute.lines_left(dict(docs))


def test_short_lines_of_many_documents_go(make_docs):
    limit = line_dedup.MIN_DOCS
    docs = [(k, f"own line {k}\nAll rights reserved.\nmore of {k}") for k in range(limit)]
    docs += [(1000 + k, f"other line {k}\nThanks.\nlast of {k}") for k in range(limit - 1)]
    docs += [(2000, "\n".join(x for k in range(limit + 5) for x in (f"verse {k}", "la la la")))]
    rows = {r["doc_id"]: r for r in line_dedup.deduplicated(make_docs(*docs)).collect()}
    assert rows[0]["n_removed"] == 0 and rows[0]["text"] == docs[0][1]
    assert all(rows[k]["text"] == f"own line {k}\nmore of {k}" for k in range(1, limit))
    assert all(rows[1000 + k]["n_removed"] == 0 for k in range(limit - 1))  # one document short
    assert rows[2000]["n_removed"] == 0  # many copies, one document

"""Changes in parts: nothing is done twice. Pages: only the ranges they lie in are read."""

import pytest
from pyspark.sql import functions as F

from newsloom.operators import quality as Q
from newsloom.plans import parts as P


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(800).select("id", (F.col("id") * 2).alias("v")).repartition(8).write.parquet(path)
    return spark.read.schema("id long, v long").parquet(path)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_an_ended_run_goes_on_with_the_rest(spark, table, tmp_path):
    out, seen = str(tmp_path / "out"), []

    def change(part):
        seen.append(len(part.inputFiles()))
        if len(seen) == 5:
            raise RuntimeError("ended")
        return part.withColumn("v", F.col("v") + 1)

    with pytest.raises(RuntimeError):
        P.change_in_parts(table, out, change, lot_bytes=1)
    assert P.read_parts(spark, out).count() < 800 and len(P.pending_files(table, out)[0]) == 4
    seen.clear()
    assert P.change_in_parts(table, out, lambda part: change(part), lot_bytes=1) == 4
    assert seen == [1, 1, 1, 1]
    assert rows(P.read_parts(spark, out)) == [(k, 2 * k + 1) for k in range(800)]
    assert P.change_in_parts(table, out, change) == 0 and len(seen) == 4


def test_only_changed_and_new_files_are_done_again(spark, table, tmp_path):
    out = str(tmp_path / "out")
    assert P.change_in_parts(table, out, lambda part: part, max_lots=1) == 1
    (tmp_path / "table" / sorted(p.name for p in (tmp_path / "table").glob("part-*.parquet"))[0]).unlink()
    spark.range(5000, 5010).select("id", F.col("id").alias("v")).coalesce(1).write.mode("append").parquet(str(tmp_path / "table"))
    grown = spark.read.schema("id long, v long").parquet(str(tmp_path / "table"))
    files = []
    P.change_in_parts(grown, out, lambda part: files.extend(part.inputFiles()) or part)
    assert len(files) == 1
    assert rows(P.read_parts(spark, out)) == rows(grown)


def test_lots_have_a_size():
    files = [("a", "a", 5), ("b", "b", 5), ("c", "c", 20), ("d", "d", 1)]
    assert P._lots(files, 10) == [["a", "b"], ["c"], ["d"]] and P._lots([], 10) == []


@pytest.fixture
def keyed(spark, tmp_path):
    path = str(tmp_path / "keyed")
    value = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") * 37 % 1000).cast("int")
    spark.range(3000).select("id", value.alias("v"), F.repeat(F.lit("x"), 50).alias("wide")).repartitionByRange(6, "v").write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("skip, n", [(0, 10), (100, 50), (999, 300), (2990, 50), (3000, 10), (1500, 0)])
def test_pages(keyed, skip, n):
    for order, first, key in (
        (["v", "id"], None, lambda r: (r.v is not None, r.v or 0, r.id)),
        ([F.desc("v"), F.col("id")], "v", lambda r: (r.v is None, -(r.v or 0), r.id)),
        ([F.desc("v"), F.col("id")], None, lambda r: (r.v is None, -(r.v or 0), r.id)),
    ):
        page = Q.page_rows(keyed, skip, n, *order, first=first)
        want = sorted(keyed.collect(), key=key)[skip : skip + n]
        assert sorted(r.id for r in page.collect()) == sorted(r.id for r in want)


def test_a_page_reads_only_its_ranges(spark, keyed, monkeypatch):
    stored = Q.order_histogram(keyed, "v", ranges=50).cache()
    assert stored.agg(F.sum("n")).first()[0] == 3000
    seen, plain = [], Q.numbered
    monkeypatch.setattr(Q, "numbered", lambda df, *order: seen.append(df) or plain(df, *order))
    page = Q.page_rows(keyed, 2000, 20, "v", "id", histogram=stored)
    assert page.count() == 20 and seen[0].count() < 300
    assert "PushedFilters: [IsNotNull(v), GreaterThanOrEqual(v" in seen[0]._jdf.queryExecution().executedPlan().toString()
